"""Report build, ordering, snapshots, reads and listings.

A report joins the sections of a definition on ``provider_id``: the first section drives,
the others are LEFT joined (a provider with k records in one section and m in another gives
k·m rows, as in the source system). A filter on a right-hand section therefore removes its
null-extended rows, which lets the optimizer turn that join into an inner join.
"""

from __future__ import annotations

import datetime as dt
import functools
import itertools
import operator
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sectora.operators.joins import skew_join
from sectora.operators import runs as run_log
from sectora.functions.text import normalise_operator as normalise_operator_column
from sectora.operators.predicates import OPERATORS, UnsupportedOperator, predicate, predicate_column, report_filter
from sectora.operators.records import for_org, for_section
from sectora.operators.sections import SectionStore, hot_providers
from sectora.plans.report_plan import DefinitionError, ReportPlan, Sort

DEFAULT_LIMIT = 100
#: Of a rebuild: reports planned at a time, built at a time, and built before their outcomes are logged.
PAGE, BUILDERS, LOGGED = 200, 4, 16


def section_frame(records: DataFrame, plan: ReportPlan, section_id: int, columns: dict[int, Column]) -> DataFrame:
    """One section of a report: provider, a record tag and attributes named by section and id."""
    return for_section(records, plan.org_id, section_id).select(
        "provider_id", F.col("record_id").alias(f"_record_{section_id}"), *[c.alias(f"s{section_id}_a{a}") for a, c in columns.items()]
    )


def build_report(
    records: DataFrame | SectionStore,
    plan: ReportPlan,
    *,
    hot: DataFrame | None = None,
    rows_per_task: int = 2_000_000,
    keep_sort_keys: bool = False,
) -> DataFrame:
    """Definition → joined, filtered, projected DataFrame (lazy).

    ``records`` is a ``SectionStore``, where a report's attributes are Parquet columns and its filters reach the scan, or a
    ``section_records`` table of maps. Each section is filtered before it is joined; a section with filters is joined inner, as
    its filters would drop the rows that a left join extends with nulls. ``hot`` is the snapshot's ``hot_providers`` table; without
    it the counts are part of the plan. Columns keep
    their section until the final projection, so the same attribute id in two sections is never confused; selecting
    it twice is refused. With ``keep_sort_keys`` the row's address (``_record_<section>``) and the sort attributes that the report
    doesn't show (``_sort_<section>_<id>``) stay, which ``read_report`` uses and drops.
    """
    if not plan.sections:
        raise DefinitionError(f"No config found for reportId {plan.report_id}")
    if len(set(plan.columns)) < len(plan.columns):
        raise DefinitionError(f"reportId {plan.report_id} selects an attribute in several sections")
    shown = [(s, a) for s, attrs in plan.sections for a in attrs]
    order = [s for s, _ in plan.sections]
    applied = [f for f in plan.filters if f not in ignored_filters(plan)]
    tests = [(f.section_id, f.attribute_id) for f in applied]
    sorts = [(s.section_id, s.attribute_id) for s in plan.sorts if s.section_id in order]
    hidden = [k for k in dict.fromkeys(sorts) if keep_sort_keys and k not in shown]
    needed = {s: list(dict.fromkeys(a for t, a in [*shown, *tests, *hidden] if t == s)) for s in order}
    names = {(s, a): f"s{s}_a{a}" for s, attrs in needed.items() for a in attrs}
    if isinstance(records, SectionStore):
        columns, records = records.columns(plan.org_id, names), records.records
    else:
        columns = {(s, a): F.try_element_at("attrs", F.lit(str(a))) for s, a in names}

    def frame(section_id: int) -> tuple[DataFrame, bool]:
        """A section's rows that pass its own filters, and whether it has any."""
        own = [f for f in applied if f.section_id == section_id]
        pred, _ = report_filter(own, names)
        df = section_frame(records, plan, section_id, {a: columns[section_id, a] for a in needed[section_id]})
        limits = any(predicate(F.lit(None), f.operator, f.value) is not None for f in own)
        return (df.where(pred) if limits else df), limits

    frames = {s: frame(s) for s in order}
    result, before = frames[order[0]][0], [order[0]]
    if len(order) > 1:
        hot = for_org(provider_counts(records, plan.org_id, order, rows_per_task) if hot is None else hot, plan.org_id)
        hot = filtered_counts(hot, {s: df for s, (df, limits) in frames.items() if limits})
    for section_id in order[1:]:
        right, limits = frames[section_id]
        result = skew_join(
            result, right, "provider_id", "inner" if limits else "left", hot=join_counts(hot, before, section_id),
            rows_per_task=rows_per_task, left_tiebreak=[f"_record_{s}" for s in before], right_tiebreak=[f"_record_{section_id}"],
        )
        before.append(section_id)
    out = ["provider_id", *[F.col(names[k]).alias(f"attr_{k[1]}") for k in shown]]
    if keep_sort_keys:
        out += [F.col(names[k]).alias(f"_sort_{k[0]}_{k[1]}") for k in hidden] + [f"_record_{s}" for s in order]
    return result.select(*out)


def provider_counts(records: DataFrame, org_id: int, sections: Sequence[int], rows_per_task: int) -> DataFrame:
    """``hot_providers`` of some sections of one org, as part of a plan."""
    own = for_org(records, org_id).where(F.col("section_id").isin(list(sections)) & F.col("provider_id").isNotNull())
    per = own.groupBy("org_id", "provider_id").agg(*[F.count(F.when(F.col("section_id") == s, 1)).alias(f"n{s}") for s in sections])
    product = F.lit(1.0)
    for s in sections:
        product = product * F.greatest(F.col(f"n{s}"), F.lit(1))
    counts = F.create_map(*[x for s in sections for x in (F.lit(s).cast("long"), F.col(f"n{s}"))])
    return per.where(product > rows_per_task).select("org_id", "provider_id", counts.alias("counts"))


def filtered_counts(hot: DataFrame, filtered: dict[int, DataFrame]) -> DataFrame:
    """``hot`` with the counts of ``filtered`` sections taken from their rows that pass, so that a selective report isn't
    split as if it had no filters. Of those sections only the hot providers' rows are counted, from key and filter columns."""
    if not filtered:
        return hot
    keys = hot.select("provider_id")
    tagged = [df.select("provider_id", F.lit(s).cast("long").alias("_section")) for s, df in filtered.items()]
    passing = functools.reduce(DataFrame.unionByName, tagged).join(keys, "provider_id", "left_semi")
    per = passing.groupBy("provider_id").agg(*[F.count_if(F.col("_section") == s).alias(f"_n{s}") for s in filtered])
    ids = [F.lit(s).cast("long") for s in filtered]
    other = F.map_filter("counts", lambda k, _: ~k.isin(*filtered))
    now = F.create_map(*[x for k, s in zip(ids, filtered, strict=True) for x in (k, F.coalesce(f"_n{s}", F.lit(0)))])
    return hot.join(per, "provider_id", "left").select("provider_id", F.map_concat(other, now).alias("counts"))


def join_counts(hot: DataFrame, before: Sequence[int], section_id: int) -> DataFrame:
    """``provider_id, n_left, n_right`` of the join of ``section_id`` to the joined sections ``before``."""
    def n(s: int) -> Column:
        return F.coalesce(F.try_element_at("counts", F.lit(s).cast("long")), F.lit(0))

    left = n(before[0]).cast("double")
    for s in before[1:]:
        left = left * F.greatest(n(s), F.lit(1))
    return hot.select("provider_id", left.alias("n_left"), n(section_id).alias("n_right"))


def ignored_filters(plan: ReportPlan) -> list:
    """Filters a build skips: their section is not in the report, or their value is null."""
    sections = {s for s, _ in plan.sections}
    return [f for f in plan.filters if f.section_id not in sections or f.value is None]


def sort_columns(sorts: Sequence[Sort], available: Sequence[str]) -> list[Column]:
    """ASC puts nulls last and DESC puts them first (the warehouse's convention). A key that the report doesn't show is
    its hidden ``_sort_`` column, if the report was built with it."""
    cols = []
    for s in sorted(sorts, key=lambda x: (x.sort_order, x.section_id, x.attribute_id)):
        for name in (f"attr_{s.attribute_id}", f"_sort_{s.section_id}_{s.attribute_id}"):
            if name in available:
                cols.append(F.col(name).desc_nulls_first() if s.direction.lower() == "desc" else F.col(name).asc_nulls_last())
                break
    return cols


def order_report(df: DataFrame, sorts: Sequence[Sort], total: bool = True) -> DataFrame:
    """Apply stored sorts; with ``total`` the row's address (the records it is made of) breaks ties, or every column where the
    report carries no address, so that ``limit`` returns the same rows on every run."""
    keys = sort_columns(sorts, df.columns)
    if total:
        keys += [F.col(c).asc_nulls_last() for c in address(df) or df.columns]
    return df.orderBy(*keys) if keys else df


def address(df: DataFrame) -> list[str]:
    """The columns that tell a report's rows apart: the record of each section."""
    return [c for c in df.columns if c.startswith("_record_")]


def visible(df: DataFrame) -> DataFrame:
    """Without hidden sort keys and addresses."""
    return df.drop(*[c for c in df.columns if c.startswith(("_sort_", "_record_"))])


def read_report(snapshot: DataFrame, sorts: Sequence[Sort] = (), limit: int = DEFAULT_LIMIT) -> DataFrame:
    """First ``limit`` rows of a report in its sort order, in two phases.

    The first finds the addresses of those rows: a top-k over the sort keys and addresses alone, so neither the scan nor the
    sort carries the report's other columns. The second reads the rows of these at most ``limit`` records of the first section, by a
    filter that reaches the scan, and orders them the same way. A snapshot without addresses is sorted whole.
    """
    if int(limit) <= 0:
        raise ValueError("limit must be greater than 0")
    rows, at = snapshot, address(snapshot)
    if at:
        first = sorted({r[0] for r in top_addresses(snapshot, sorts, limit).collect()})
        rows = snapshot.where(F.col(at[0]).isin(first)) if first else snapshot.limit(0)
    return visible(order_report(rows, sorts).limit(int(limit)))


def top_addresses(snapshot: DataFrame, sorts: Sequence[Sort], limit: int) -> DataFrame:
    """Addresses of the first ``limit`` rows in sort order."""
    at = address(snapshot)
    keys = [c for s in sorts for c in (f"attr_{s.attribute_id}", f"_sort_{s.section_id}_{s.attribute_id}") if c in snapshot.columns]
    return order_report(snapshot.select(*dict.fromkeys([*keys, *at])), sorts).limit(int(limit)).select(*at)


@dataclass(frozen=True)
class ReportPage:
    """What a user gets for a report: its metadata, the number of rows read and the rows."""

    report_id: int
    name: str
    description: str | None
    last_run_date: dt.datetime | None
    snapshot: str
    count: int
    rows: DataFrame


def open_report(
    spark: SparkSession, base_path: str, definitions: dict[str, DataFrame], org_id: int, report_id: int, limit: int = DEFAULT_LIMIT
) -> ReportPage:
    """The newest completed snapshot of a tenant's report, looked up in the run log: metadata, count and rows.

    ``LookupError`` if the tenant has no such report, or if no run of it is complete.
    """
    from sectora.plans.report_plan import plan_from_tables

    if int(limit) <= 0:
        raise ValueError("limit must be greater than 0")
    runs = run_log.read(spark, f"{base_path}/runs")
    found = report_metadata(run_log.states(for_org(definitions["reports"], org_id), runs), org_id, report_id).collect()
    if not found:
        raise LookupError(f"Report not found for reportId={report_id}")
    path = run_log.snapshot_of(runs, org_id, report_id)
    if path is None:
        raise LookupError(f"reportId={report_id} has no completed run")
    plan = plan_from_tables(definitions, report_id, org_id)
    rows = read_report(spark.read.parquet(path), plan.sorts, limit)
    r = found[0]
    return ReportPage(r.report_id, r.name, r.description, r.last_run_date, path, rows.count(), rows)


def result_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def list_reports(reports: DataFrame, org_id: int, by: str = "updated_at") -> DataFrame:
    """A tenant's reports, newest first (ties by report id, descending)."""
    cols = ["report_id", "name", "description", "created_at", "updated_at", "status"]
    if by == "updated_at":
        cols.append("last_run_date")
    elif by != "created_at":
        raise ValueError("by must be updated_at or created_at")
    return for_org(reports, org_id).select(*cols).orderBy(F.col(by).desc_nulls_first(), F.col("report_id").desc())


def report_metadata(reports: DataFrame, org_id: int, report_id: int) -> DataFrame:
    return (
        for_org(reports, org_id)
        .where(F.col("report_id") == F.lit(int(report_id)))
        .select("report_id", "name", "description", "last_run_date")
        .limit(1)
    )


def report_table_name(report_id: int) -> str:
    return f"report_{int(report_id)}"


def materialize(df: DataFrame, base_path: str, report_id: int, run_id: str | None = None, org_id: int | None = None) -> str:
    """Write a report snapshot to its run's folder and return it.

    Each run writes ``<base>/[org_<org>/]report_<id>/run=<run id>``; readers follow the path in the run
    log, so a failed or partial write never replaces the last good snapshot. A run that is tried again replaces its own folder.
    """
    tenant = "" if org_id is None else f"/org_{int(org_id)}"
    path = f"{base_path.rstrip('/')}{tenant}/{report_table_name(report_id)}/run={run_id or uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def rebuild(
    spark: SparkSession,
    records: DataFrame | SectionStore,
    definitions: dict[str, DataFrame],
    base_path: str,
    report_ids: Sequence[tuple[int, int]] | None = None,
    *,
    run_id: str | None = None,
    clock: Callable[[], dt.datetime] = dt.datetime.now,
    **build_options,
) -> DataFrame:
    """Build every pending report (or the given ``(org_id, report_id)`` pairs) and log each run under ``<base>/runs``.

    ``records`` should be a written store or snapshot shared by all builds. A definition that can't be
    built doesn't stop the others, a failure of the cluster or of storage does. The log gets a ``running`` row before a report is built
    and its outcome a few reports at a time, so a driver that dies repeats those few: reports left ``running`` are pending. A
    report that this ``run_id`` has completed or failed before is not built again, so a replayed run adds nothing. Returns
    the outcomes of the run: ``report_id, org_id, status, snapshot_path, error``.
    """
    from sectora.plans.report_plan import plans_from_tables

    base_path, log = base_path.rstrip("/"), f"{base_path.rstrip('/')}/runs"
    run = run_id or uuid.uuid4().hex
    runs = run_log.read(spark, log)
    saved = definitions.get("reports")
    if report_ids is None:
        todo = run_log.pending(saved, runs).select("org_id", "report_id")
    else:
        todo = spark.createDataFrame([(int(o), int(r)) for o, r in report_ids], "org_id long, report_id long").distinct()
    told = runs.where((F.col("run_id") == run) & F.col("state").isin("completed", "failed")).select("org_id", "report_id")
    todo = todo.join(told, ["org_id", "report_id"], "left_anti")
    todo = todo.withColumn("updated_at", F.lit(None).cast("timestamp_ntz")) if saved is None else todo.join(
        saved.select("org_id", "report_id", "updated_at"), ["org_id", "report_id"], "left"
    )
    # written once: the log changes while the list is read
    todo = todo.orderBy("report_id", "org_id").checkpoint()
    counts = provider_hot(records, build_options.get("rows_per_task", 2_000_000)) if not todo.isEmpty() else None

    def build(key: tuple[int, int], plan: ReportPlan | DefinitionError) -> tuple[str, str | None, str | None]:
        org_id, report_id = key
        try:
            if isinstance(plan, DefinitionError):
                raise plan
            frame = build_report(records, plan, hot=counts, keep_sort_keys=True, **build_options)
        except (DefinitionError, UnsupportedOperator, AnalysisException) as exc:  # the definition's fault
            return "failed", None, str(exc) or type(exc).__name__
        return "completed", materialize(frame, base_path, report_id, run, org_id), None

    keys = ((int(r.org_id), int(r.report_id), r.updated_at) for r in todo.toLocalIterator())
    # pages bound what the driver holds; all pages are built
    while page := list(itertools.islice(keys, PAGE)):
        plans = plans_from_tables(definitions, [k[:2] for k in page])
        run_log.append(spark, log, [(o, r, run, "running", u, clock(), None, None) for o, r, u in page])
        for at in range(0, len(page), LOGGED):
            some = page[at : at + LOGGED]
            with ThreadPoolExecutor(BUILDERS) as pool:
                outcomes = list(pool.map(lambda k, plans=plans: build(k[:2], plans[k[:2]]), some))
            run_log.append(spark, log, [(o, r, run, state, u, clock(), path, error) for (o, r, u), (state, path, error) in zip(some, outcomes, strict=True)])
    ended = run_log.read(spark, log).where((F.col("run_id") == run) & F.col("state").isin("completed", "failed"))
    return ended.select("report_id", "org_id", F.col("state").alias("status"), F.col("path").alias("snapshot_path"), "error")


def provider_hot(records: DataFrame | SectionStore, rows_per_task: int) -> DataFrame:
    return hot_providers(records.records if isinstance(records, SectionStore) else records, rows_per_task)


def report_attribute_order(attrs: DataFrame) -> DataFrame:
    """Attributes of each report with their position in numeric (section, attribute) order."""
    from pyspark.sql import Window

    w = Window.partitionBy("report_id", "org_id").orderBy("section_id", "attribute_id")
    return attrs.select("report_id", "org_id", "section_id", "attribute_id",
                        F.row_number().over(w).cast("int").alias("position"))


def report_section_groups(attrs: DataFrame) -> DataFrame:
    """Per report and section: alias ``s<section>``, whether it drives the joins (smallest id)
    and its distinct attribute ids in order."""
    per = attrs.groupBy("report_id", "org_id", "section_id").agg(
        F.array_sort(F.collect_set("attribute_id")).alias("attribute_ids")
    )
    first = attrs.groupBy("report_id", "org_id").agg(F.min("section_id").alias("_first"))
    return per.join(first, ["report_id", "org_id"]).select(
        "report_id", "org_id", "section_id",
        F.concat(F.lit("s"), F.col("section_id").cast("string")).alias("alias"),
        (F.col("section_id") == F.col("_first")).alias("is_driver"),
        "attribute_ids",
    )


def query_texts(definitions: dict[str, DataFrame]) -> DataFrame:
    """``report_id, org_id, query``: the SQL text of every report, or why it has none; one job for all reports.

    The text is that of ``plans.render_sql``: a CTE for each section, outer joins by provider, the build's predicates in the order of
    section, attribute, operator and value.
    """
    key = ["report_id", "org_id"]
    attrs = definitions["report_section_attributes"].select(*key, "section_id", "attribute_id").distinct()
    own = attrs.select(*key, "section_id").distinct()
    tests = definitions["report_filters"].where("value is not null").join(own, [*key, "section_id"], "left_semi")
    name = F.concat(F.lit("s"), F.col("section_id"), F.lit("_a"), F.col("attribute_id"))
    tests = tests.withColumn("text", predicate_column(name, F.col("operator"), F.col("value")))
    first = F.struct("section_id", "attribute_id", "operator", "value")
    wrong = tests.withColumn("op", normalise_operator_column("operator")).where(~F.col("op").isin(*OPERATORS))
    wrong = wrong.groupBy(*key).agg(F.min_by(F.concat(F.lit("-- Unsupported operator: "), "op"), first).alias("wrong"))
    where = tests.where("text is not null").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(first.alias("at"), "text"))).alias("tests"))
    where = where.select(*key, F.array_join(F.transform("tests", lambda t: t["text"]), " AND ").alias("tests"))
    # what a section's CTE selects: shown attributes first, then those that are only tested
    columns = attrs.withColumn("rank", F.lit(0)).unionByName(tests.select(*key, "section_id", "attribute_id").withColumn("rank", F.lit(1)))
    columns = columns.groupBy(*key, "section_id", "attribute_id").agg(F.min("rank").alias("rank"))
    inner = F.concat(F.lit(", attr_"), F.col("attribute_id"), F.lit(" AS "), name)
    shown = F.when(F.col("rank") == 0, F.concat(F.lit(", "), name, F.lit(" AS attr_"), F.col("attribute_id")))
    per = columns.groupBy(*key, "section_id").agg(F.array_sort(F.collect_list(F.struct("rank", "attribute_id", inner.alias("inner"), shown.alias("shown")))).alias("c"))
    cte = F.concat(
        F.lit("s"), F.col("section_id"), F.lit(" AS (SELECT provider_id"), F.array_join(F.transform("c", lambda x: x["inner"]), ""),
        F.lit(" FROM org_"), F.col("org_id"), F.lit("_section_"), F.col("section_id"), F.lit(")"),
    )
    per = per.select(*key, "section_id", cte.alias("cte"), F.array_join(F.transform("c", lambda x: x["shown"]), "").alias("shown"))
    whole = per.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("section_id", "cte", "shown"))).alias("s"))
    joins = F.transform("s", lambda x, i: F.when(i == 0, F.concat(F.lit("s"), x["section_id"])).otherwise(F.concat(F.lit(" LEFT JOIN s"), x["section_id"], F.lit(" USING (provider_id)"))))
    text = F.concat(
        F.lit("WITH "), F.array_join(F.transform("s", lambda x: x["cte"]), ", "), F.lit(" SELECT provider_id"), F.array_join(F.transform("s", lambda x: x["shown"]), ""),
        F.lit(" FROM "), F.array_join(joins, ""), F.coalesce(F.concat(F.lit(" WHERE "), "tests"), F.lit("")),
    )
    every = definitions["reports"].select(*key).join(whole, key, "left").join(where, key, "left").join(wrong, key, "left")
    none = F.concat(F.lit("-- No config found for reportId "), F.col("report_id"))
    return every.select(*key, F.when(F.col("s").isNull(), none).otherwise(F.coalesce("wrong", text)).alias("query"))
