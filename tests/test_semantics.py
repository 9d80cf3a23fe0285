"""Golden micro-tests of the engine's semantic decisions, on literal rows."""

import random

import pytest
from pyspark.sql import functions as F

from sectora.functions.text import sanitize_name
from sectora.functions.types import warehouse_type
from sectora.operators import definitions as dfn
from sectora.operators import sections as sec
from sectora.operators import tasks as tk
from sectora.operators.joins import skew_join
from sectora.operators.predicates import Filter, UnsupportedOperator, predicate, report_filter
from sectora.operators.predicates import UnsupportedOperator
from sectora.plans.report_plan import DefinitionError, plan_report, render_sql
from sectora.sinks.tables import NameCollision, sanitize_columns
from sectora.sources.eav import load_eav


def test_text_comparison_is_lexicographic(spark):
    df = spark.createDataFrame([("10",), ("9",)], "v string")
    assert [r.v for r in df.where(predicate(F.col("v"), "<", "9")).collect()] == ["10"]


def test_in_drops_blanks_and_keeps_quotes(spark):
    df = spark.createDataFrame([("O'Brien",), ("a",), ("",)], "v string")
    got = {r.v for r in df.where(predicate(F.col("v"), " in ", " a, ,O'Brien,, ")).collect()}
    assert got == {"a", "O'Brien"}
    assert predicate(F.col("v"), "IN", " , ,") is None


def test_contains_is_case_insensitive_and_keeps_wildcards(spark):
    df = spark.createDataFrame([("NATION_1",), ("nationX1",), ("a\\b",), (None,)], "v string")
    assert {r.v for r in df.where(predicate(F.col("v"), "contains", "ion_1")).collect()} == {"NATION_1", "nationX1"}
    assert [r.v for r in df.where(predicate(F.col("v"), "CONTAINS", "a\\b")).collect()] == ["a\\b"]


def test_unknown_operator_raises():
    with pytest.raises(UnsupportedOperator):
        predicate(F.col("v"), "BETWEEN", "a")


def test_report_filter_skips_absent_sections_and_null_values():
    cols = {(1, 11): "attr_11"}
    _pred, ignored = report_filter(
        [Filter(1, 11, "=", "x"), Filter(2, 21, "BETWEEN", "y"), Filter(1, 11, "=", None)], cols
    )
    assert [(f.section_id, f.value) for f in ignored] == [(2, "y"), (1, None)]


def _eav(spark, values):
    raw = {
        "provider_profile": spark.createDataFrame(
            [(1, 1, 100, 7, False), (2, 1, 200, 7, None), (3, 1, 300, 7, True), (4, 2, 100, 7, False)],
            "id long, section_id long, provider_id long, org_id long, is_deleted boolean"),
        "section": spark.createDataFrame([(1, "A", None, None), (2, "B", False, True)],
                                         "id long, name string, is_deleted boolean, is_active boolean"),
        "attribute": spark.createDataFrame(
            [(11, "x", 1, 7, "text"), (12, "y", 1, 7, "text"), (21, "z", 2, 7, "text"), (13, "n", 1, None, "text")],
            "id long, name string, section_id long, org_id long, type string"),
        "attribute_option": spark.createDataFrame([(11, "b"), (11, "a"), (11, "a")], "attribute_id long, value string"),
        "attribute_value": spark.createDataFrame(values, "provider_profile_id long, attribute_id long, value string"),
    }
    return load_eav(raw)


def test_min_value_wins_and_foreign_attributes_drop(spark):
    eav = _eav(spark, [(1, 11, "b"), (1, 11, "a"), (1, 12, None), (1, 21, "foreign"), (1, 13, "no org"),
                       (2, 12, "y2"), (3, 11, "deleted record"), (None, 11, "no record")])
    got = {r.record_id: dict(r.attrs) for r in sec.section_records(eav).collect()}
    assert got == {1: {"11": "a"}, 2: {"12": "y2"}, 4: {}}


def test_map_projection_equals_pivot(spark):
    rng = random.Random(7)
    vals = [(rng.choice([1, 2, 4]), rng.choice([11, 12, 21]), rng.choice(["a", "b", "c", None])) for _ in range(300)]
    eav = _eav(spark, vals)
    m = sec.wide_section(sec.section_records(eav), 7, 1, [11, 12])
    p = sec.wide_section_by_pivot(eav, 7, 1, [11, 12])
    assert m.exceptAll(p).count() == 0 and p.exceptAll(m).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(k, i) for i in range(60) for k in ([1] * 3 + [2, 3])], "k long, l long")
    right = spark.createDataFrame([(k, j) for j in range(40) for k in ([1, 1, 2] + ([4] if j < 5 else []))], "k long, r long")
    left = left.withColumn("l", F.monotonically_increasing_id())
    right = right.withColumn("r", F.monotonically_increasing_id())
    plain = left.join(right, "k", how)
    split = skew_join(left, right, "k", how, rows_per_task=10, left_tiebreak=["l"], right_tiebreak=["r"])
    assert split.count() == plain.count()
    assert split.exceptAll(plain.select(*split.columns)).count() == 0


def test_plan_report_orders_sections_and_dedupes():
    plan = plan_report(5, 7, [(2, 21), (1, 12), (1, 11), (1, 12)], [(2, 21, " contains ", "x")], [(1, 11, "DESC", 2)])
    assert plan.sections == ((1, (11, 12)), (2, (21,)))
    assert plan.columns == ["provider_id", "attr_11", "attr_12", "attr_21"]
    assert render_sql(plan) == (
        "WITH s1 AS (SELECT provider_id, attr_11 AS s1_a11, attr_12 AS s1_a12 FROM org_7_section_1), "
        "s2 AS (SELECT provider_id, attr_21 AS s2_a21 FROM org_7_section_2) "
        "SELECT provider_id, s1_a11 AS attr_11, s1_a12 AS attr_12, s2_a21 AS attr_21 FROM s1 LEFT JOIN s2 USING (provider_id) "
        "WHERE s2_a21 ILIKE '%x%'"
    )
    with pytest.raises(UnsupportedOperator):
        render_sql(plan_report(5, 7, [(1, 11)], [(1, 11, "BETWEEN", "1")]))
    with pytest.raises(DefinitionError):
        plan_report(5, 7, [])


def test_sanitize_names():
    assert sanitize_name(" 123 ") == "attr_123"
    assert sanitize_name("abc-def") == "abc_def"
    assert sanitize_name("") == "col"
    assert sanitize_name("Never Filled") == "never_filled"


def test_sanitize_collisions_raise(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, `a_b` int")
    with pytest.raises(NameCollision):
        sanitize_columns(df)


def test_warehouse_types():
    assert warehouse_type("bigint") == "BIGINT"
    assert warehouse_type("decimal(18,2)") == "DECIMAL(18,2)"
    assert warehouse_type("array<string>") == "VARCHAR(65535)"


def test_tasks_golden(spark):
    """Three open and three completed tasks, one completed of each type: rate 50."""
    rows = [
        ("a1", 1, "document", "pending", "Send the harbour permit", "The quay office waits for it."),
        ("b1", 1, "profile", "in_progress", "Describe the vessel", "Length, draught and home harbour."),
        ("c1", 1, "signature", "pending", "Sign the berth contract", "Two pages."),
        ("a2", 1, "document", "completed", "Sent the crew list", "Received on Monday."),
        ("b2", 1, "profile", "completed", "Described the owner", "Entered at the harbour desk."),
        ("c2", 1, "signature", "completed", "Signed the pilot form", "Filed."),
    ]
    df = spark.createDataFrame(rows, "id string, provider_id long, type string, status string, title string, description string")
    k = tk.task_kpis(df).collect()[0]
    assert (k.pending, k.completed, k.completion_rate) == (3, 3, 50)
    assert (k.completed_documents, k.completed_profiles, k.completed_signatures) == (1, 1, 1)
    assert {r.id for r in tk.search_tasks(tk.open_tasks(df), "HARBOUR").collect()} == {"a1", "b1"}
    assert {r.id for r in tk.search_tasks(df, "harbour", "profile").collect()} == {"b1", "b2"}


def test_js_round_halves_up(spark):
    df = spark.createDataFrame([(12.5,), (12.49,), (0.5,)], "x double")
    assert [r.r for r in df.select(tk.js_round(F.col("x")).alias("r")).collect()] == [13, 12, 1]


def test_first_error_follows_source_order(spark):
    errs = spark.createDataFrame(
        [(1, 7, 3, 0, 3, 0, "Invalid filter operator: X"), (1, 7, 2, 1, 1, 0, "Invalid sectionId"),
         (1, 7, 2, 0, 2, 1, "Invalid attributeId")],
        "request_id long, org_id long, stage int, pos int, step int, attr_pos int, message string")
    assert dfn.first_error(errs).collect()[0].message == "Invalid attributeId"


def test_section_records_plan_stays_in_the_jvm(spark):
    import contextlib
    import io

    eav = _eav(spark, [(1, 11, "a")])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        sec.section_records(eav).explain("formatted")
    plan = buf.getvalue()
    assert "Exchange" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _records(spark, rows):
    return spark.createDataFrame(rows, "org_id long, section_id long, section_name string, record_id long, provider_id long, attrs map<string,string>")


def test_columns_keep_their_section_and_hidden_sort_keys(spark):
    from sectora.operators.reports import build_report, read_report

    records = _records(spark, [
        (7, 1, "a", 1, 100, {"11": "x", "12": "3"}), (7, 1, "a", 2, 101, {"11": "y", "12": "1"}), (7, 1, "a", 3, 102, {"11": "z", "12": "2"}),
        (7, 2, "b", 4, 100, {"11": "q", "21": "u"}), (7, 2, "b", 5, 101, {"11": "p", "21": "v"}),
    ])
    # a filter on section 2's attribute 11, though section 1 shows its own
    plan = plan_report(5, 7, [(1, 11), (2, 21)], [(2, 11, "=", "q")])
    assert [tuple(r) for r in build_report(records, plan).collect()] == [(100, "x", "u")]
    # an attribute that the report doesn't show orders it
    plan = plan_report(5, 7, [(1, 11)], [], [(1, 12, "asc", 1)])
    built = build_report(records, plan, keep_sort_keys=True)
    assert [tuple(r) for r in read_report(built, plan.sorts, 2).collect()] == [(101, "y"), (102, "z")]
    with pytest.raises(DefinitionError):
        build_report(records, plan_report(5, 7, [(1, 11), (2, 11)]))


def test_split_left_join_doesnt_shuffle_the_left_side_by_the_bare_key(spark):
    left, right = spark.range(100).selectExpr("id % 3 k", "id l"), spark.range(100).selectExpr("id % 3 k", "id r")
    hot = spark.createDataFrame([(0, 34, 34)], "k long, n_left long, n_right long")
    plan = skew_join(left, right, "k", "left", hot=hot, rows_per_task=10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "LeftAnti" not in plan
    assert skew_join(left, right, "k", "left", hot=hot, rows_per_task=10).count() == left.join(right, "k", "left").count()


def test_overwrite_switches_and_writes_nested_columns_as_text(spark, tmp_path):
    from sectora.sinks.tables import write_table

    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, ["a"])], "`A b` long, x array<string>"), path)
    write_table(spark.createDataFrame([(2, ["b", "c"])], "`A b` long, x array<string>"), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, '["b","c"]')]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from sectora.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d)))


def test_rebuild_reports_a_definitions_own_fault_only(spark, tmp_path, monkeypatch):
    from sectora.operators import reports as rep

    records = _records(spark, [(7, 1, "a", 1, 100, {"11": "x"})])
    names = {
        "report_section_attributes": ([(5, 7, 1, 11), (6, 7, 1, 11)], "report_id long, org_id long, section_id long, attribute_id long"),
        "report_filters": ([(6, 7, 1, 11, "BETWEEN", "1")], "report_id long, org_id long, section_id long, attribute_id long, operator string, value string"),
        "report_sorts": ([], "report_id long, org_id long, section_id long, attribute_id long, direction string, sort_order int"),
    }
    defs = {n: spark.createDataFrame(*x) for n, x in names.items()}
    out = rep.rebuild(spark, records, defs, str(tmp_path), [(7, 5), (7, 6)]).collect()
    assert [(r.report_id, r.status) for r in out] == [(5, "completed"), (6, "failed")] and "BETWEEN" in out[1].error
    monkeypatch.setattr(rep, "materialize", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        rep.rebuild(spark, records, defs, str(tmp_path), [(7, 5)])


def test_a_request_with_numbers_and_text_ids(spark):
    """Ids sent as numbers or as text count alike; lists in filter values are joined; nulls are not left out."""
    body = """{"name": "Berths", "config": [{"sectionId": 4, "attributeIds": [41, "42"]}, {"sectionId": "5", "attributeIds": ["51"]}],
        "filters": [{"sectionId": "4", "attributeId": 41, "operator": "in", "value": ["a", "b"]}, {"sectionId": 4, "attributeId": "42", "operator": "=", "value": "[x"}],
        "sorts": [{"sectionId": 5, "attributeId": 51, "direction": "DESC", "sortOrder": "2"}]}"""
    bad = '{"name": "x", "config": [{"sectionId": "4", "attributeIds": [null]}], "sorts": [{"sectionId": 4, "attributeId": 41, "direction": null, "sortOrder": "z"}]}'
    requests = spark.createDataFrame([(1, 7, None, body), (2, 7, None, bad), (3, 7, None, '{"name": "x", "config": [1]}')], "request_id long, org_id long, report_id long, body string")
    catalog = spark.createDataFrame([(7, 4, 41), (7, 4, 42), (7, 5, 51)], "org_id long, section_id long, attribute_id long")
    errors = dfn.validate_definitions(requests, catalog)
    assert {(r.request_id, r.message) for r in errors.collect()} == {
        (3, "sectionId is required in each config item"), (2, "Invalid attributeId None for sectionId 4 and org_id 7"),
        (2, "Invalid sort direction: none"), (2, "Invalid sort order: z"),
    }
    filters = dfn.flatten_filters(dfn.parse_requests(requests)).where("request_id = 1").orderBy("pos").collect()
    assert [(r.section_id, r.attribute_id, r.operator, r.value) for r in filters] == [(4, 41, "in", "a,b"), (4, 42, "=", "[x")]
