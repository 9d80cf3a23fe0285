"""Attribute columns, run log, versioned tables, typed and wide sinks, joins without broadcasts: behaviour and plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from sectora.operators import definitions as dfn
from sectora.operators import reports as rep
from sectora.operators import runs as run_log
from sectora.operators import sections as sec
from sectora.operators.joins import lookup_join, skew_join
from sectora.operators.records import section_context
from sectora.plans.report_plan import plan_report, render_sql
from sectora.sinks import tables, versions, wide
from sectora.sources import fixtures
from sectora.streaming import start_rebuild_stream
from tests.test_semantics import _eav, _records

NOW = dt.datetime(2026, 6, 1)
VALUES = [(1, 11, "a"), (1, 12, "b"), (2, 12, "c"), (1, 21, "foreign"), (2, 11, "A"), (2, 99, "unknown"), (None, 11, "x")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def as_set(df):
    return {(*r[:5], tuple(sorted(r.attrs.items()))) for r in df.collect()}


@pytest.mark.parametrize("slots", [0, 1, 64])
def test_store_holds_what_the_maps_hold(spark, tmp_path, slots):
    eav = _eav(spark, VALUES)
    store = sec.SectionStore.write(eav, str(tmp_path / "s"), slots)
    assert as_set(store.as_maps()) == as_set(sec.section_records(eav))
    again = sec.SectionStore.read(spark, str(tmp_path / "s"))
    plan = plan_report(5, 7, [(1, 11), (1, 12)], [(1, 12, ">=", "b")])
    want = [(100, "a", "b"), (200, "A", "c")]
    assert sorted(tuple(r) for r in rep.build_report(again, plan).collect()) == want
    assert sorted(tuple(r) for r in rep.build_report(sec.section_records(eav), plan).collect()) == want


def test_a_report_reads_its_own_columns_and_filters_in_the_scan(spark, tmp_path, monkeypatch):
    store = sec.SectionStore.write(_eav(spark, VALUES), str(tmp_path / "s"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = formatted(rep.build_report(store, plan_report(5, 7, [(1, 11)], [(1, 12, "=", "c")])))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    place = {r.attribute_id: r.place for r in store.slots.where("org_id = 7 and section_id = 1").collect()}
    assert set(schema.split(",")) <= {"record_id:bigint", "provider_id:bigint", f"v{place[11]}:string", f"v{place[12]}:string"} and "map" not in schema
    assert f"EqualTo(v{place[12]},c)" in re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "PartitionFilters" in text


def test_filters_of_joined_sections_act_before_the_join(spark):
    records = _records(spark, [
        (7, 1, "a", 1, 100, {"11": "x"}), (7, 1, "a", 2, 101, {"11": "y"}), (7, 2, "b", 4, 100, {"21": "u"}), (7, 2, "b", 5, 100, {"21": "v"}),
    ])
    built = rep.build_report(records, plan_report(5, 7, [(1, 11), (2, 21)], [(2, 21, "=", "u")]))
    sections = [line for line in built._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line and "_bl" in line]
    assert [tuple(r) for r in built.collect()] == [(100, "x", "u")] and len(sections) == 1 and "Join Inner" in sections[0]
    blank = rep.build_report(records, plan_report(5, 7, [(1, 11), (2, 21)], [(2, 21, "IN", " , ")]))
    assert sorted(tuple(map(str, r)) for r in blank.collect()) == [("100", "x", "u"), ("100", "x", "v"), ("101", "y", "None")]


def test_null_providers_are_spread(spark):
    left = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("l"))
    right = spark.range(5).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew_join(left, right, "k", "left", left_tiebreak=["l"], right_tiebreak=["r"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 1000 and len(sizes) >= 6 and max(sizes) < 300
        assert skew_join(left, right, "k", "inner").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_a_large_dimension_equals_a_plain_join(spark, no_broadcast, how):
    facts = spark.range(400).select(F.when(F.col("id") % 5 > 0, F.least(F.col("id") % 7, F.lit(2))).alias("k"), F.col("id").alias("f"))
    dimension = spark.createDataFrame([(0, "a"), (2, "c"), (None, "n")], "k long, d string")
    got = lookup_join(facts, dimension, ["k"], how, tiebreak=["f"], rows_per_task=20)
    assert sorted(map(str, got.collect())) == sorted(map(str, facts.join(dimension, ["k"], how).collect()))


def test_records_are_not_exchanged_by_a_bare_dimension_key(spark, no_broadcast):
    eav = _eav(spark, VALUES)
    for df in (section_context(eav), sec.section_records(eav)):
        text = df._jdf.queryExecution().optimizedPlan().toString() + plan_of(df)
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))
        joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", text)
        assert all("_salt" in j for j in joins if "section_id" in j) and any("_salt" in k for k in keys)
    assert {r.record_id for r in section_context(eav).collect()} == {1, 2, 4}


def test_ties_break_by_record_and_the_sort_carries_keys_only(spark, tmp_path):
    rows = [(7, 1, "a", i, 100 + i % 3, {"11": "same", "12": f"long text {i}" * 50, "13": str(i % 2)}) for i in range(40)]
    plan = plan_report(5, 7, [(1, 11), (1, 12)], [], [(1, 13, "desc", 1)])
    rep.build_report(_records(spark, rows), plan, keep_sort_keys=True).repartition(5).write.parquet(str(tmp_path / "r"))
    snapshot = spark.read.parquet(str(tmp_path / "r"))
    got = rep.read_report(snapshot, plan.sorts, 5)
    assert got.columns == ["provider_id", "attr_11", "attr_12"]
    assert [r.attr_12 for r in got.collect()] == [f"long text {i}" * 50 for i in (1, 3, 5, 7, 9)]
    text = formatted(rep.top_addresses(snapshot, plan.sorts, 5))
    assert "attr_12" not in text and "TakeOrdered" in text
    with pytest.raises(ValueError):
        rep.read_report(snapshot, (), 0)


def definitions(spark, kinds=((5, "="), (6, "="), (8, "BETWEEN"))):
    ids = [k for k, _ in kinds]
    tables_of = {
        "reports": ([(k, 7, f"R{k}", "d", "created", NOW, NOW, None) for k in ids] + [(9, 7, "R9", "d", "created", NOW, NOW, None)],
                    "report_id long, org_id long, name string, description string, status string, created_at timestamp_ntz, updated_at timestamp_ntz, last_run_date timestamp_ntz"),
        "report_section_attributes": ([(k, 7, 1, 11) for k in ids], "report_id long, org_id long, section_id long, attribute_id long"),
        "report_filters": ([(k, 7, 1, 11, op, "x") for k, op in kinds], "report_id long, org_id long, section_id long, attribute_id long, operator string, value string"),
        "report_sorts": ([], "report_id long, org_id long, section_id long, attribute_id long, direction string, sort_order int"),
    }
    return {n: spark.createDataFrame(*x) for n, x in tables_of.items()}


RECORDS = [(7, 1, "a", 1, 100, {"11": "x"}), (7, 1, "a", 2, 101, {"11": "y"})]


def test_build_status_read_and_expire(spark, tmp_path):
    defs, base, records = definitions(spark), str(tmp_path), _records(spark, RECORDS)
    clock = iter([NOW + dt.timedelta(hours=h) for h in range(1, 1000)])
    out = rep.rebuild(spark, records, defs, base, clock=lambda: next(clock))
    assert {(r.report_id, r.status) for r in out.collect()} == {(5, "completed"), (6, "completed"), (8, "failed"), (9, "failed")}
    log = f"{base}/runs"
    shown = {r.report_id: r for r in run_log.states(defs["reports"], run_log.read(spark, log)).collect()}
    assert (shown[5].status, shown[8].status, shown[9].status) == ("completed", "failed", "failed")
    assert shown[5].last_run_date > NOW and shown[8].last_run_date is None and shown[5].updated_at > NOW
    # nothing is pending, so a second run builds nothing
    assert run_log.pending(defs["reports"], run_log.read(spark, log)).isEmpty()
    assert rep.rebuild(spark, records, defs, base).isEmpty()
    page = rep.open_report(spark, base, defs, 7, 5, 10)
    assert (page.name, page.count, [tuple(r) for r in page.rows.collect()]) == ("R5", 1, [(100, "x")]) and page.last_run_date == shown[5].last_run_date
    assert "/org_7/report_5/run=" in page.snapshot
    for missing in ((7, 8), (7, 99), (8, 5)):
        with pytest.raises(LookupError):
            rep.open_report(spark, base, defs, *missing)
    # an edit makes the report pending again, and its new run is the one that is read
    edited = defs | {"reports": defs["reports"].withColumn("updated_at", F.when(F.col("report_id") == 5, F.lit(NOW + dt.timedelta(days=90))).otherwise(F.col("updated_at")).cast("timestamp_ntz"))}
    assert [r.report_id for r in run_log.pending(edited["reports"], run_log.read(spark, log)).collect()] == [5]
    later = _records(spark, [(7, 1, "a", 3, 103, {"11": "x"})])
    rep.rebuild(spark, later, edited, base, clock=lambda: NOW + dt.timedelta(days=91))
    assert [tuple(r) for r in rep.open_report(spark, base, edited, 7, 5).rows.collect()] == [(103, "x")]
    assert run_log.expire(spark, log) == 1 and run_log.expire(spark, log) == 0
    assert [tuple(r) for r in rep.open_report(spark, base, edited, 7, 5).rows.collect()] == [(103, "x")]
    assert not versions.Files(spark).exists(page.snapshot)


def test_a_killed_run_resumes(spark, tmp_path, monkeypatch):
    defs, base, records = definitions(spark, ((5, "="), (6, "="))), str(tmp_path), _records(spark, RECORDS)
    monkeypatch.setattr(rep, "LOGGED", 1)
    write, built = rep.materialize, []

    def dying(df, where, report_id, *more):
        if report_id == 6:
            raise KeyboardInterrupt
        built.append(report_id)
        return write(df, where, report_id, *more)

    monkeypatch.setattr(rep, "materialize", dying)
    with pytest.raises(KeyboardInterrupt):
        rep.rebuild(spark, records, defs, base)
    states = {r.report_id: r.status for r in run_log.states(defs["reports"], run_log.read(spark, f"{base}/runs")).collect()}
    assert states == {5: "completed", 6: "running", 9: "running"}
    monkeypatch.setattr(rep, "materialize", lambda df, where, report_id, *more: built.append(report_id) or write(df, where, report_id, *more))
    out = rep.rebuild(spark, records, defs, base)
    assert {(r.report_id, r.status) for r in out.collect()} == {(6, "completed"), (9, "failed")} and built == [5, 6]


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("run=*"))


def test_a_replayed_batch_and_a_repeated_event_build_nothing(spark, tmp_path):
    defs, records = definitions(spark, ((5, "="), (8, "BETWEEN"))), _records(spark, RECORDS)
    event = '{"orgId": 7, "reportId": %d, "savedAt": "2026-06-01T00:00:0%d"}\n'
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.json").write_text(event % (5, 1) + event % (8, 1) + event % (5, 1))

    def drain(checkpoint="c"):
        q = start_rebuild_stream(spark, str(tmp_path / "events"), str(tmp_path / checkpoint), str(tmp_path / "out"), lambda: records, lambda: defs, str(tmp_path / "reports"))
        q.awaitTermination()
        return {(r.report_id, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect()}, folders(tmp_path / "reports"), run_log.read(spark, str(tmp_path / "reports/runs")).count()

    first = drain()
    assert first[0] == {(5, "completed"), (8, "failed")} and len(first[1]) == 1
    # the checkpoint is lost: the batch is delivered again under its number
    assert drain("other") == first
    # the same event in a later batch is known; a new save of the report isn't
    (tmp_path / "events" / "b.json").write_text(event % (5, 1))
    assert drain()[1:] == first[1:]
    (tmp_path / "events" / "c.json").write_text(event % (5, 2))
    assert len(drain()[1]) == 2


def test_a_commit_is_whole_and_only_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "defs")
    state = definitions(spark)
    state["report_sections"] = state["report_section_attributes"].drop("attribute_id").distinct()
    first = versions.commit(spark, base, versions.current(spark, base), {n: versions.stage(df, base, n) for n, df in state.items()})
    catalog = spark.createDataFrame([(7, 1, 11)], "org_id long, section_id long, attribute_id long")
    body = '{"name": "New", "config": [{"sectionId": "1", "attributeIds": [11]}]}'
    requests = spark.createDataFrame([(1, 7, None, body), (2, 7, 5, body), (3, 7, None, "{}")], "request_id long, org_id long, report_id long, body string")
    stage, staged = versions.stage, []

    def failing(df, where, name):
        if len(staged) == 3:
            raise OSError("disk")
        staged.append(name)
        return stage(df, where, name)

    monkeypatch.setattr(dfn.versions, "stage", failing)
    with pytest.raises(OSError):
        dfn.save_definitions(spark, base, requests, catalog, F.lit(NOW))
    assert versions.current(spark, base) == first and versions.read(spark, base)["reports"].count() == 4
    monkeypatch.setattr(dfn.versions, "stage", stage)
    after, errors = dfn.save_definitions(spark, base, requests, catalog, F.lit(NOW))
    assert after.number == 2 and [(r.request_id, r.message) for r in errors.collect()] == [(3, "name is required")]
    saved = versions.read(spark, base)
    assert saved["reports"].count() == 5 and saved["reports"].where("report_id = 5").first().name == "New"
    with pytest.raises(versions.Conflict):
        versions.commit(spark, base, first, {})
    assert set(versions.expire(spark, base, 1)) == set(first.paths.values()) and versions.read(spark, base)["reports"].count() == 5


def test_ids_collide_and_are_hashed_again(spark):
    requests = spark.createDataFrame([(i, 7, None if i else 3, "") for i in range(12)], "request_id long, org_id long, report_id long, body string")
    reports = spark.createDataFrame([(k,) for k in (1, 2, 3)], "report_id long")
    ids = [r.report_id for r in dfn.allocate_ids(requests, reports, F.lit(NOW), bits=4).collect()]  # 15 ids, 3 of them stored
    assert len(ids) == 11 == len(set(ids)) and set(ids) <= set(range(4, 16))
    assert dfn.allocate_ids(requests.limit(0), reports, F.lit(NOW)).collect() == []
    one, two = (sorted(map(tuple, dfn.allocate_ids(requests, reports, F.lit(NOW)).collect())) for _ in range(2))
    assert one == two and all(k[2] > 0 for k in one)


def test_validation_exchanges_its_items_once(spark, no_broadcast):
    catalog = spark.createDataFrame([(7, 1, 11)], "org_id long, section_id long, attribute_id long")
    requests = spark.createDataFrame([(1, 7, None, "{}")], "request_id long, org_id long, report_id long, body string")
    text = plan_of(dfn.validate_definitions(requests, catalog))
    assert text.count("SortMergeJoin") == 1 and text.count("Exchange hashpartitioning(org_id") + text.count("Exchange hashpartitioning(cast(org_id") <= 3


def test_typed_table(spark, tmp_path):
    base = str(tmp_path / "t")
    done = tables.replace_table(spark.createDataFrame([(1, "2.5", ["a"])], "`A b` long, x string, y array<string>"), base, [("a_b", "INTEGER"), ("x", "DECIMAL(4,2)"), ("y", "VARCHAR(20)")], table="typed_t")
    assert spark.table("typed_t").dtypes == [("a_b", "int"), ("x", "decimal(4,2)"), ("y", "string")] and done.version == 1
    bad = spark.createDataFrame([(2**40, "x", "é" * 8), (5, "1", "ok"), (None, None, None)], "a_b long, x string, y string")
    columns = [("a_b", "INTEGER"), ("x", "DECIMAL(4,2)"), ("y", "VARCHAR(15)")]
    with pytest.raises(tables.TypeViolation) as err:
        tables.replace_table(bad, base, columns)
    assert err.value.rejected == 1 and tables.read_table(spark, base).count() == 1
    rejects = spark.read.parquet(err.value.path).first()
    assert {(v["column"], v.reason) for v in rejects._violations} == {("a_b", "is no INTEGER"), ("x", "is no DECIMAL(4,2)"), ("y", "longer than 15 bytes")}
    done = tables.replace_table(bad, base, columns, table="typed_t", on_violation="report")
    assert (done.rejected, done.version) == (1, 2) and sorted(str(r.a_b) for r in spark.table("typed_t").collect()) == ["5", "None"]
    spark.sql("DROP TABLE typed_t")


def test_wide_export_has_a_schema_for_each_section(spark, tmp_path):
    eav = _eav(spark, VALUES)
    base = str(tmp_path / "w")
    more = spark.createDataFrame([(7, 5, "none", 50, 1, {}), (8, 1, "A", 60, 2, {"11": "q", "99": "z"}), (8, 1, "A", 61, 2, {"99": None})], sec.section_records(eav).schema)
    lists = sec.section_attributes(eav).unionByName(spark.createDataFrame([(8, 1, [98, 99])], "org_id long, section_id long, attribute_ids array<long>"))
    files = wide.export_wide(sec.section_records(eav).unionByName(more).repartition(4), lists, base)
    context = ["record_id", "org_id", "section_id", "section_name"]
    assert wide.read_wide(spark, base, 7, 1).columns == [*context, "11", "12"] and wide.read_wide(spark, base, 7, 5).columns == context
    assert sorted(tuple(r) for r in wide.read_wide(spark, base, 7, 1).collect()) == [(1, 7, 1, "A", "a", "b"), (2, 7, 1, "A", "A", "c")]
    assert sorted(tuple(r) for r in wide.read_wide(spark, base, 8, 1).collect()) == [(60, 8, 1, "A", None, "z"), (61, 8, 1, "A", None, None)]
    assert files.agg(F.sum("n_rows")).first()[0] == 6 == wide.read_all(spark, base).count()
    wide.export_wide(sec.section_records(eav), lists, base)
    assert wide.read_all(spark, base).count() == 3


def test_query_texts_are_those_of_single_reports(spark):
    defs = definitions(spark, ((5, " contains "), (6, "!="), (8, "BETWEEN"), (10, "in")))
    defs["report_section_attributes"] = defs["report_section_attributes"].unionByName(spark.createDataFrame([(5, 7, 2, 21)], defs["report_section_attributes"].schema))
    defs["reports"] = defs["reports"].unionByName(defs["reports"].limit(0))
    got = {r.report_id: r.query for r in rep.query_texts(defs).collect()}
    assert got[5] == render_sql(plan_report(5, 7, [(1, 11), (2, 21)], [(1, 11, "contains", "x")]))
    assert got[6] == render_sql(plan_report(6, 7, [(1, 11)], [(1, 11, "!=", "x")])) and got[10] == render_sql(plan_report(10, 7, [(1, 11)], [(1, 11, "IN", "x")]))
    assert got[8] == "-- Unsupported operator: BETWEEN" and got[9] == "-- No config found for reportId 9"


def test_hot_counts_are_those_of_the_rows_that_pass_the_filters(spark):
    rows = [(7, 1, "a", i, 100, {"11": "x" if i == 0 else "y"}) for i in range(30)] + [(7, 2, "b", 100 + i, 100, {"21": str(i)}) for i in range(20)]
    records = _records(spark, [*rows, (7, 1, "a", 200, 101, {"11": "x"})])
    hot = sec.hot_providers(records, 10)
    passing = records.where("section_id = 1 and attrs['11'] = 'x'")
    assert [r.counts for r in rep.filtered_counts(hot, {1: passing}).collect()] == [{1: 1, 2: 20}]
    assert [r.counts for r in rep.filtered_counts(hot, {1: passing.where("false")}).collect()] == [{1: 0, 2: 20}]
    assert rep.filtered_counts(hot, {}) is hot
    for filters, expected in (([(1, 11, "=", "x")], 21), ([(2, 21, "=", "3")], 30), ([(1, 11, "=", "z")], 0), ([], 601)):
        for table in (hot, None):
            plan = plan_report(5, 7, [(1, 11), (2, 21)], filters)
            assert rep.build_report(records, plan, hot=table, rows_per_task=10).count() == expected


def test_requests_are_dealt_out_and_parsed_in_columns(spark, tmp_path):
    """Bodies are made and checked in as many tasks as there are requests for, not as files of orders; no generator parses them again."""
    for name, rows, schema in [
        ("region", [(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        ("nation", [(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        ("customer", [(1, 0, 1.0, "A"), (2, 1, 2.0, "B")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        ("orders", [(k, k % 2 + 1, "F", 1.0, "1-URGENT") for k in range(400)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
    ]:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    requests = fixtures.requests(spark, str(tmp_path))
    assert "hashpartitioning(request_id" in plan_of(requests)
    catalog = spark.createDataFrame([(0, 1, 101), (1, 1, 1101)], "org_id long, section_id long, attribute_id long")
    errors = dfn.validate_definitions(requests, catalog)
    generators = [line for line in errors._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode(" in line]
    assert generators and not any("from_json(" in line or "get_json_object(" in line for line in generators)
    assert requests.count() == 440 and dfn.first_error(errors).count() == requests.where("report_id is null").count() - 20 - 2
