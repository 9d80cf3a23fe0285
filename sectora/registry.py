"""Named queries over the driver's tables, each with its DuckDB oracle.

Every query derives the EAV (and definition) tables from the driver's tables. Records and values grow with customers and
orders, definitions with customers, requests with orders, tasks with events; the attribute table has a fixed number of rows for each
region. Queries that build reports one by one build those of the regions, over records that grow. ``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is SQL
that DuckDB runs on the same Parquet files. Nested results (arrays, maps, structs) are
compared as JSON text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.oracle import wide_cte, with_fixture
from sectora.operators import catalog as cat
from sectora.operators import records as rec
from sectora.operators import sections as sec
from sectora.operators.definitions import load_definitions
from sectora.operators.reports import build_report
from sectora.plans.report_plan import plan_from_tables
from sectora.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def eav(spark: SparkSession, sf: str):
    return fixtures.fixture_eav(spark, sf)


def section_records(spark: SparkSession, sf: str) -> DataFrame:
    return sec.section_records(eav(spark, sf))


def definitions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Reports of all customers and regions."""
    return load_definitions(fixtures.definition_sources(spark, sf))


def region_definitions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Reports of the regions: those that are built."""
    return load_definitions(fixtures.definition_sources(spark, sf, growing=False))


def store(spark: SparkSession, sf: str) -> sec.SectionStore:
    return sec.SectionStore.write(eav(spark, sf))


def report(spark: SparkSession, sf: str, report_id: int, org_id: int, *, filters: bool = True, **opts) -> DataFrame:
    plan = plan_from_tables(region_definitions(spark, sf), report_id, org_id)
    if not filters:
        plan = type(plan)(plan.report_id, plan.org_id, plan.sections, (), plan.sorts)
    records = store(spark, sf)
    return build_report(records, plan, hot=sec.hot_providers(records.records, opts.get("rows_per_task", 2_000_000)), **opts)


def wide(spark: SparkSession, sf: str, org: int, section: int) -> DataFrame:
    e = eav(spark, sf)
    ids = [1000 * org + b for b, _, s, _ in fixtures.ATTRIBUTE_TEMPLATES if s == section]
    return sec.wide_section(sec.section_records(e, org, section), org, section, ids)


def ids_of(org: int, section: int) -> list[int]:
    return [1000 * org + b for b, _, s, _ in fixtures.ATTRIBUTE_TEMPLATES if s == section]


# ---------------------------------------------------------------------------
# Report build (flagship)
# ---------------------------------------------------------------------------

REPORT_101_SQL = with_fixture(
    """
SELECT s1.provider_id, s1.attr_1101, s1.attr_1102, s1.attr_1103, s2.attr_1201, s2.attr_1203
FROM s1 LEFT JOIN s2 ON s1.provider_id = s2.provider_id
WHERE s1.attr_1103 ILIKE '%ation_1%' AND s2.attr_1201 <> 'P'
""",
    wide_cte("s1", 1, 1, [1101, 1102, 1103]) + ",\n" + wide_cte("s2", 1, 2, [1201, 1203]),
)


@register("build_report", REPORT_101_SQL)
def q_build_report(spark, sf):
    """Report 101 of org 1: two sections, a CONTAINS filter and a != filter on the joined section."""
    return report(spark, sf, 101, 1)


@register("build_report_unfiltered", with_fixture(
    """
SELECT s1.provider_id, s1.attr_1101, s1.attr_1102, s1.attr_1103, s2.attr_1201, s2.attr_1203
FROM s1 LEFT JOIN s2 ON s1.provider_id = s2.provider_id
""",
    wide_cte("s1", 1, 1, [1101, 1102, 1103]) + ",\n" + wide_cte("s2", 1, 2, [1201, 1203]),
))
def q_build_report_unfiltered(spark, sf):
    return report(spark, sf, 101, 1, filters=False)


@register("join_report_sections", with_fixture(
    """
SELECT s1.provider_id, s1.attr_3101, s1.attr_3102, s1.attr_3103, s2.attr_3201, s2.attr_3203
FROM s1 LEFT JOIN s2 ON s1.provider_id = s2.provider_id
""",
    wide_cte("s1", 3, 1, [3101, 3102, 3103]) + ",\n" + wide_cte("s2", 3, 2, [3201, 3203]),
))
def q_join_report_sections(spark, sf):
    """Left join of two sections on provider (fan-out kept), hot providers split into buckets."""
    return report(spark, sf, 301, 3, filters=False, rows_per_task=5)


@register("build_report_ignored_filters", with_fixture(
    "SELECT s1.provider_id, s1.attr_2101, s1.attr_2103 FROM s1 WHERE s1.attr_2102 > '5000'",
    wide_cte("s1", 2, 1, [2101, 2102, 2103]),
))
def q_build_report_ignored_filters(spark, sf):
    """Report 203: a filter on an absent section and one with a null value are skipped; the
    text comparison on an unselected attribute applies."""
    return report(spark, sf, 203, 2)


@register("build_report_in_list", with_fixture(
    "SELECT s1.provider_id, s1.attr_4101, s1.attr_4102 FROM s1 WHERE s1.attr_4101 IN ('BUILDING', 'MACHINERY', 'O''Brien')",
    wide_cte("s1", 4, 1, [4101, 4102]),
))
def q_build_report_in_list(spark, sf):
    """Report 404: IN with blanks, padding and a quote in the value list."""
    return report(spark, sf, 404, 4)


@register("build_report_single_section", with_fixture(
    "SELECT s2.provider_id, s2.attr_201, s2.attr_202, s2.attr_203 FROM s2",
    wide_cte("s2", 0, 2, [201, 202, 203]),
))
def q_build_report_single_section(spark, sf):
    """Report 2 of org 0: one section with attributes; the listed section without attributes is not joined."""
    return report(spark, sf, 2, 0)


# ---------------------------------------------------------------------------
# Scans, projections, filters
# ---------------------------------------------------------------------------


@register("project_rename", with_fixture("SELECT * FROM records"))
def q_project_rename(spark, sf):
    return eav(spark, sf).records


@register("filter_not_null_keys", with_fixture("SELECT * FROM vals"))
def q_filter_not_null_keys(spark, sf):
    return eav(spark, sf).values


@register("filter_active_records", with_fixture("SELECT * FROM active_records"))
def q_filter_active_records(spark, sf):
    return rec.active_records(eav(spark, sf).records)


@register("filter_active_sections", with_fixture(
    """
SELECT s.section_id, s.section_name, count(r.record_id) AS n_records
FROM active_sections s LEFT JOIN active_records r ON r.section_id = s.section_id
GROUP BY s.section_id, s.section_name
"""))
def q_filter_active_sections(spark, sf):
    e = eav(spark, sf)
    counts = rec.active_records(e.records).groupBy("section_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        rec.active_sections(e.sections).join(counts, "section_id", "left")
        .select("section_id", "section_name", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_records"))
    )


@register("filter_tenant", with_fixture("SELECT * FROM ctx WHERE org_id = 2"))
def q_filter_tenant(spark, sf):
    return rec.for_org(rec.section_context(eav(spark, sf)), 2)


@register("filter_section", with_fixture("SELECT * FROM ctx WHERE org_id = 3 AND section_id = 2"))
def q_filter_section(spark, sf):
    return rec.for_section(rec.section_context(eav(spark, sf)), 3, 2)


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------


@register("join_records_sections", with_fixture("SELECT * FROM ctx"))
def q_join_records_sections(spark, sf):
    return rec.section_context(eav(spark, sf))


@register("join_values_context", with_fixture("SELECT * FROM vctx"))
def q_join_values_context(spark, sf):
    return rec.values_with_context(eav(spark, sf))


CATALOG_CTE = """
opts AS (
  SELECT attribute_id, string_agg(attribute_option_value, ',' ORDER BY attribute_option_value) AS attribute_options
  FROM options GROUP BY attribute_id
),
catalog AS (
  SELECT a.attribute_id, a.section_id, a.attribute_name, s.section_name, a.org_id, a.attribute_type, o.attribute_options
  FROM attributes a JOIN active_sections s ON a.section_id = s.section_id
  LEFT JOIN opts o ON o.attribute_id = a.attribute_id
)
"""


@register("join_attribute_section", with_fixture("SELECT * FROM catalog", CATALOG_CTE))
def q_join_attribute_section(spark, sf):
    return cat.options_as_text(cat.attribute_catalog(eav(spark, sf)))


@register("join_records_pivot", with_fixture("SELECT * FROM w", wide_cte("w", 1, 1, ids_of(1, 1))))
def q_join_records_pivot(spark, sf):
    """Reference-shaped plan for one section: explicit pivot, then left join from its records."""
    return sec.wide_section_by_pivot(eav(spark, sf), 1, 1, ids_of(1, 1))


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------


@register("agg_attribute_options", with_fixture("SELECT * FROM opts", CATALOG_CTE))
def q_agg_attribute_options(spark, sf):
    return cat.options_as_text(cat.attribute_options(eav(spark, sf).options))


@register("pivot_first", with_fixture("SELECT * FROM w", wide_cte("w", 1, 2, ids_of(1, 2))))
def q_pivot_first(spark, sf):
    return sec.wide_section_by_pivot(eav(spark, sf), 1, 2, ids_of(1, 2))


ATTRS_JSON_SQL = with_fixture("""
SELECT c.org_id, c.section_id, c.section_name, c.record_id, c.provider_id,
       coalesce('{' || string_agg('"' || CAST(kv.attribute_id AS VARCHAR) || '":"' || kv.value || '"', ','
                                  ORDER BY CAST(kv.attribute_id AS VARCHAR)) || '}', '{}') AS attrs_json,
       count(kv.attribute_id) AS n_attrs
FROM ctx c LEFT JOIN kv ON kv.record_id = c.record_id
GROUP BY c.org_id, c.section_id, c.section_name, c.record_id, c.provider_id
""")


@register("attrs_map", ATTRS_JSON_SQL)
def q_attrs_map(spark, sf):
    """One attribute map per active record, all orgs and sections in one pass."""
    out = sec.records_as_json(section_records(spark, sf))
    return out.withColumn("n_attrs", F.col("n_attrs").cast("long"))


@register("wide_section", with_fixture("SELECT * FROM w", wide_cte("w", 2, 1, ids_of(2, 1))))
def q_wide_section(spark, sf):
    """Wide table of (org 2, section 1) projected from the maps; the never-filled attribute is a null column."""
    e = eav(spark, sf)
    ids = [r["attribute_id"] for r in
           rec.for_section(sec.defined_attributes(e), 2, 1).select("attribute_id").orderBy("attribute_id").collect()]
    return sec.wide_section(sec.section_records(e, 2, 1), 2, 1, ids)


@register("wide_section_empty", with_fixture(
    "SELECT record_id, provider_id FROM ctx WHERE org_id = 1 AND section_id = 5"))
def q_wide_section_empty(spark, sf):
    """A section without attributes keeps only the record and provider ids."""
    return sec.wide_section(sec.section_records(eav(spark, sf), 1, 5), 1, 5, [])


@register("distinct_org_sections", with_fixture("SELECT DISTINCT org_id, section_id, section_name FROM ctx"))
def q_distinct_org_sections(spark, sf):
    return rec.org_sections(rec.section_context(eav(spark, sf)))


@register("distinct_section_attributes", with_fixture("""
SELECT org_id, section_id, to_json(list(attribute_id ORDER BY attribute_id)) AS attribute_ids_json
FROM defined GROUP BY org_id, section_id
"""))
def q_distinct_section_attributes(spark, sf):
    return sec.section_attributes(eav(spark, sf)).select(
        "org_id", "section_id", F.to_json("attribute_ids").alias("attribute_ids_json")
    )


@register("agg_row_counts", with_fixture("""
SELECT 'records' AS metric, count(*) AS n FROM ctx
UNION ALL SELECT 'values', count(*) FROM vctx
UNION ALL SELECT 'attributes', count(*) FROM attributes
"""))
def q_agg_row_counts(spark, sf):
    return rec.pipeline_counts(eav(spark, sf))


NEST_CATALOG_SQL = with_fixture("""
SELECT org_id, section_id, section_name,
       to_json(list({'attributeId': attribute_id, 'name': attribute_name, 'attributeType': attribute_type,
                     'attributeOptions': attribute_options} ORDER BY attribute_id)) AS attributes_json
FROM catalog WHERE section_id IS NOT NULL
GROUP BY org_id, section_id, section_name
""", CATALOG_CTE)


@register("nest_catalog", NEST_CATALOG_SQL)
def q_nest_catalog(spark, sf):
    docs = cat.catalog_documents(cat.options_as_text(cat.attribute_catalog(eav(spark, sf))))
    return docs.select("org_id", "section_id", "section_name",
                       F.to_json("attributes", {"ignoreNullFields": "false"}).alias("attributes_json"))


@register("order_catalog", with_fixture("""
SELECT section_id, section_name, attribute_id, attribute_name, attribute_type, attribute_options
FROM catalog WHERE org_id = 1 ORDER BY section_id, attribute_id
""", CATALOG_CTE))
def q_order_catalog(spark, sf):
    return cat.ordered_catalog(cat.options_as_text(cat.attribute_catalog(eav(spark, sf))), 1)


# ---------------------------------------------------------------------------
# Definition management
# ---------------------------------------------------------------------------

from sectora.oracle import requests_cte, validation_ctes  # noqa: E402
from sectora.operators import definitions as dfn  # noqa: E402
from sectora.operators import runs as run_log  # noqa: E402
from sectora.session import scratch_path  # noqa: E402
from sectora.sinks import versions  # noqa: E402

NOW = "2026-06-01 12:00:00"


def now_col():
    return F.to_timestamp_ntz(F.lit(NOW))


def requests(spark, sf):
    return fixtures.requests(spark, sf)


def catalog(spark, sf):
    return cat.options_as_text(cat.attribute_catalog(eav(spark, sf)))


def errors(spark, sf):
    return dfn.validate_definitions(requests(spark, sf), cat.catalog_keys_table(eav(spark, sf)),
                                    definitions(spark, sf)["reports"])


REQ = requests_cte()
VAL = CATALOG_CTE.strip() + ",\n" + REQ + ",\n" + validation_ctes().strip()
REGION_VAL = CATALOG_CTE.strip() + ",\n" + requests_cte(growing=False) + ",\n" + validation_ctes().strip()


@register("fn_json_parse", with_fixture("""
SELECT request_id, org_id, json_extract_string(body, '$.name') AS name,
       json_extract_string(body, '$.description') AS description,
       CASE WHEN json_type(body, '$.config') = 'ARRAY' THEN CAST(json_array_length(body, '$.config') AS INTEGER) END AS n_config
FROM req
""", REQ))
def q_fn_json_parse(spark, sf):
    p = dfn.parse_requests(requests(spark, sf))
    return p.select("request_id", "org_id", F.col("doc.name").alias("name"), F.col("doc.description").alias("description"),
                    F.when(F.col("doc.config").isNotNull(), F.size("doc.config")).alias("n_config"))


@register("flatten_sections", with_fixture("""
SELECT request_id, org_id, CAST(pos AS INTEGER) AS pos, TRY_CAST(json_extract_string(item, '$.sectionId') AS BIGINT) AS section_id
FROM cfg
""", VAL))
def q_flatten_sections(spark, sf):
    return dfn.flatten_sections(dfn.parse_requests(requests(spark, sf)))


@register("flatten_attributes", with_fixture("""
SELECT request_id, org_id, CAST(pos AS INTEGER) AS pos, CAST(attr_pos AS INTEGER) AS attr_pos,
       TRY_CAST(json_extract_string(item, '$.sectionId') AS BIGINT) AS section_id,
       TRY_CAST(json_extract_string(item, '$.attributeIds[' || attr_pos || ']') AS BIGINT) AS attribute_id
FROM (SELECT request_id, org_id, pos, item,
             unnest(range(CAST(coalesce(json_array_length(item, '$.attributeIds'), 0) AS BIGINT))) AS attr_pos FROM cfg)
""", VAL))
def q_flatten_attributes(spark, sf):
    return dfn.flatten_attributes(dfn.parse_requests(requests(spark, sf)))


@register("flatten_filters", with_fixture("""
SELECT request_id, org_id, CAST(pos AS INTEGER) AS pos,
       TRY_CAST(json_extract_string(item, '$.sectionId') AS BIGINT) AS section_id,
       TRY_CAST(json_extract_string(item, '$.attributeId') AS BIGINT) AS attribute_id,
       trim(json_extract_string(item, '$.operator')) AS operator,
       coalesce(json_extract_string(item, '$.value'), '') AS value
FROM filt
""", VAL))
def q_flatten_filters(spark, sf):
    return dfn.flatten_filters(dfn.parse_requests(requests(spark, sf)))


@register("flatten_sorts", with_fixture("""
SELECT request_id, org_id, CAST(pos AS INTEGER) AS pos,
       TRY_CAST(json_extract_string(item, '$.sectionId') AS BIGINT) AS section_id,
       TRY_CAST(json_extract_string(item, '$.attributeId') AS BIGINT) AS attribute_id,
       lower(coalesce(json_extract_string(item, '$.direction'), 'asc')) AS direction,
       coalesce(TRY_CAST(json_extract_string(item, '$.sortOrder') AS INTEGER), 1) AS sort_order
FROM srt
""", VAL))
def q_flatten_sorts(spark, sf):
    return dfn.flatten_sorts(dfn.parse_requests(requests(spark, sf)))


def _stage(stage: int):
    def q(spark, sf):
        return errors(spark, sf).where(F.col("stage") == stage).select("request_id", "org_id", "pos", "message")
    return q


def _stage_sql(stage: int) -> str:
    return with_fixture(f"SELECT request_id, org_id, CAST(pos AS INTEGER) AS pos, message FROM errors WHERE stage = {stage}", VAL)


register("validate_request_shape", _stage_sql(0))(_stage(0))
register("anti_invalid_config", _stage_sql(2))(_stage(2))
register("validate_filters", _stage_sql(3))(_stage(3))
register("validate_sorts", _stage_sql(4))(_stage(4))


@register("semi_report_exists", with_fixture("""
SELECT q.request_id, q.org_id, q.report_id FROM req q
WHERE EXISTS (SELECT 1 FROM reports p WHERE p.report_id = q.report_id AND p.org_id = q.org_id)
""", REQ))
def q_semi_report_exists(spark, sf):
    return dfn.existing_targets(requests(spark, sf), definitions(spark, sf)["reports"])


@register("first_error", with_fixture("""
SELECT request_id, org_id, arg_min(message, (stage, pos, step, attr_pos)) AS message FROM errors GROUP BY request_id, org_id
""", VAL))
def q_first_error(spark, sf):
    return dfn.first_error(errors(spark, sf))


_UPSERT = f""",
valid AS (
  SELECT q.*, coalesce(q.report_id, 1000000000000 + q.request_id) AS target_id FROM req q
  WHERE NOT EXISTS (SELECT 1 FROM errors e WHERE e.request_id = q.request_id)
),
latest AS (SELECT target_id, org_id, max(request_id) AS request_id FROM valid GROUP BY target_id, org_id),
v AS (SELECT valid.* FROM valid JOIN latest USING (target_id, org_id, request_id)),
upserted AS (
  SELECT v.target_id AS report_id, v.org_id, json_extract_string(v.body, '$.name') AS name,
         coalesce(json_extract_string(v.body, '$.description'), '') AS description, 'created' AS status,
         coalesce(p.created_at, TIMESTAMP '{NOW}') AS created_at, TIMESTAMP '{NOW}' AS updated_at, p.last_run_date
  FROM v LEFT JOIN reports p ON p.report_id = v.target_id AND p.org_id = v.org_id
),
new_reports AS (
  SELECT * FROM reports p WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.target_id = p.report_id AND v.org_id = p.org_id)
  UNION ALL SELECT * FROM upserted
),
new_attrs AS (
  SELECT * FROM rattr p WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.target_id = p.report_id AND v.org_id = p.org_id)
  UNION ALL SELECT v.target_id, a.org_id, TRY_CAST(a.sid AS BIGINT), TRY_CAST(a.aid AS BIGINT)
  FROM cfg_attrs a JOIN v ON v.request_id = a.request_id
)
"""
UPSERT_CTES = VAL + _UPSERT
REGION_UPSERT_CTES = REGION_VAL + _UPSERT


#: Ids of new reports in the queries; the oracle can't compute the hashes of ``allocate_ids``.
def new_id():
    return F.lit(1_000_000_000_000) + F.col("request_id")


def upserted(spark, sf, growing: bool = True):
    """The stored definition tables, a batch of requests saved to them in one commit, and the tables read back."""
    base = scratch_path(spark, "definitions")
    stored = definitions(spark, sf) if growing else region_definitions(spark, sf)
    versions.commit(spark, base, versions.current(spark, base), {n: versions.stage(df, base, n) for n, df in stored.items()})
    dfn.save_definitions(spark, base, fixtures.requests(spark, sf, growing), cat.catalog_keys_table(eav(spark, sf)), now_col(), new_id())
    return versions.read(spark, base)


@register("upsert_definition", with_fixture("SELECT * FROM new_reports", UPSERT_CTES))
def q_upsert_definition(spark, sf):
    """Valid creates and edits applied to the reports snapshot (edits keep created_at)."""
    return upserted(spark, sf)["reports"]


@register("upsert_definition_attributes", with_fixture("SELECT * FROM new_attrs", UPSERT_CTES))
def q_upsert_definition_attributes(spark, sf):
    """Child rows of edited reports are replaced, those of other reports kept."""
    return upserted(spark, sf)["report_section_attributes"]


@register("join_definition_config", with_fixture("""
SELECT s.report_id, s.org_id, s.section_id, a.attribute_id
FROM rsec s LEFT JOIN rattr a ON s.report_id = a.report_id AND s.org_id = a.org_id AND s.section_id = a.section_id
"""))
def q_join_definition_config(spark, sf):
    return dfn.definition_config(definitions(spark, sf))


CONFIG_JSON_CTE = """
cfg_sec AS (
  SELECT s.report_id, s.org_id, s.section_id,
         coalesce(list(CAST(a.attribute_id AS VARCHAR) ORDER BY a.attribute_id) FILTER (WHERE a.attribute_id IS NOT NULL), []) AS ids
  FROM rsec s LEFT JOIN rattr a ON s.report_id = a.report_id AND s.org_id = a.org_id AND s.section_id = a.section_id
  GROUP BY s.report_id, s.org_id, s.section_id
),
cfg_doc AS (
  SELECT report_id, org_id,
         to_json(list({'sectionId': CAST(section_id AS VARCHAR), 'attributeIds': ids} ORDER BY section_id)) AS config_json
  FROM cfg_sec GROUP BY report_id, org_id
),
filt_doc AS (
  SELECT report_id, org_id,
         to_json(list({'sectionId': CAST(section_id AS VARCHAR), 'attributeId': CAST(attribute_id AS VARCHAR),
                       'operator': operator, 'value': value}
                      ORDER BY CAST(section_id AS VARCHAR), CAST(attribute_id AS VARCHAR), operator, value)) AS filters_json
  FROM rfilt GROUP BY report_id, org_id
),
sort_doc AS (
  SELECT report_id, org_id,
         to_json(list({'sectionId': CAST(section_id AS VARCHAR), 'attributeId': CAST(attribute_id AS VARCHAR),
                       'direction': direction, 'sortOrder': sort_order}
                      ORDER BY sort_order, CAST(section_id AS VARCHAR), CAST(attribute_id AS VARCHAR))) AS sorts_json
  FROM rsort GROUP BY report_id, org_id
)
"""

JSON_OPTS = {"ignoreNullFields": "false"}


@register("nest_definition_config", with_fixture("SELECT * FROM cfg_doc", CONFIG_JSON_CTE))
def q_nest_definition_config(spark, sf):
    return dfn.nest_config(definitions(spark, sf)).select("report_id", "org_id", F.to_json("config").alias("config_json"))


@register("nest_definition_filters", with_fixture("SELECT * FROM filt_doc", CONFIG_JSON_CTE))
def q_nest_definition_filters(spark, sf):
    return dfn.nest_filters(definitions(spark, sf)).select(
        "report_id", "org_id", F.to_json("filters", JSON_OPTS).alias("filters_json"))


@register("nest_definition_sorts", with_fixture("SELECT * FROM sort_doc", CONFIG_JSON_CTE))
def q_nest_definition_sorts(spark, sf):
    return dfn.nest_sorts(definitions(spark, sf)).select(
        "report_id", "org_id", F.to_json("sorts", JSON_OPTS).alias("sorts_json"))


@register("get_definition", with_fixture("""
SELECT p.report_id, p.org_id, p.name, p.description, p.status, p.created_at, p.updated_at,
       coalesce(c.config_json, '[]') AS config_json, coalesce(f.filters_json, '[]') AS filters_json,
       coalesce(s.sorts_json, '[]') AS sorts_json
FROM reports p
LEFT JOIN cfg_doc c ON c.report_id = p.report_id AND c.org_id = p.org_id
LEFT JOIN filt_doc f ON f.report_id = p.report_id AND f.org_id = p.org_id
LEFT JOIN sort_doc s ON s.report_id = p.report_id AND s.org_id = p.org_id
""", CONFIG_JSON_CTE))
def q_get_definition(spark, sf):
    d = dfn.get_definition(definitions(spark, sf))
    return d.select(
        "report_id", "org_id", "name", "description", "status", "created_at", "updated_at",
        F.to_json("config").alias("config_json"), F.to_json("filters", JSON_OPTS).alias("filters_json"),
        F.to_json("sorts", JSON_OPTS).alias("sorts_json"),
    )


@register("pending_reports", with_fixture("SELECT * FROM reports WHERE status = 'created'"))
def q_pending_reports(spark, sf):
    return dfn.pending_reports(definitions(spark, sf)["reports"])


def runs_of(reports: DataFrame) -> DataFrame:
    """A stand-in run log: a run of each report by its kind (completed, completed, left running, completed before it was edited, failed)."""
    kind = F.col("report_id") % 100
    second = F.when(kind == 5, "failed").when(kind != 3, "completed")
    row = reports.select(
        "org_id", "report_id", F.lit("r1").alias("run_id"), F.explode(F.array(F.lit("running"), second)).alias("state"),
        F.when(kind == 4, F.col("updated_at") - F.expr("interval 1 day")).otherwise(F.col("updated_at")).alias("defined_at"),
        now_col().alias("at"), F.lit("p").alias("path"), F.lit(None).cast("string").alias("error"),
    )
    return row.where("state is not null")


@register("report_status", with_fixture(f"""
SELECT report_id, org_id, name, description,
       CASE report_id % 100 WHEN 3 THEN 'running' WHEN 5 THEN 'failed' WHEN 4 THEN status ELSE 'completed' END AS status, created_at,
       CASE WHEN report_id % 100 = 4 THEN updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at,
       CASE WHEN report_id % 100 IN (1, 2, 4) THEN greatest(last_run_date, TIMESTAMP '{NOW}') ELSE last_run_date END AS last_run_date
FROM reports
"""))
def q_report_status(spark, sf):
    """Status, time and last run of every report, folded from a log of runs; a run of an older definition moves no status."""
    reports = definitions(spark, sf)["reports"]
    return run_log.states(reports, runs_of(reports))


@register("pending_after_runs", with_fixture("SELECT * FROM reports WHERE report_id % 100 = 3"))
def q_pending_after_runs(spark, sf):
    """What a rebuild would take up by the same log: reports that a run left unfinished; edited report 4 isn't marked for a build."""
    reports = definitions(spark, sf)["reports"]
    return run_log.pending(reports, runs_of(reports))


# ---------------------------------------------------------------------------
# Predicates, one per operator, on wide section tables
# ---------------------------------------------------------------------------

from sectora.operators.predicates import Filter, predicate, report_filter  # noqa: E402
from sectora.oracle import TASKS_CTE  # noqa: E402

PRED_CASES = {
    # name: (section, attribute of org 0, operator, value, SQL condition)
    "pred_eq": (1, 101, "=", "BUILDING", "value = 'BUILDING'"),
    "pred_ne": (2, 201, "!=", "F", "value <> 'F'"),
    "pred_gt": (1, 102, ">", "5000", "value > '5000'"),
    "pred_lt": (2, 203, "<", "150000", "value < '150000'"),
    "pred_ge": (1, 102, ">=", "5000.00", "value >= '5000.00'"),
    "pred_le": (1, 102, "<=", "1000", "value <= '1000'"),
    "pred_contains": (1, 103, " contains ", "n_2", "value ILIKE '%n_2%'"),
    "pred_like": (2, 202, "LIKE", "%URGENT", "value LIKE '%URGENT'"),
    "pred_in": (1, 101, "IN", " BUILDING, ,MACHINERY,,O'Brien ", "value IN ('BUILDING', 'MACHINERY', 'O''Brien')"),
}


def attribute_values(spark, sf, section, *bases):
    """``org_id, record_id, provider_id`` and the value of each attribute, by its id in org 0, of all tenants' records of a section."""
    records = section_records(spark, sf).where(F.col("section_id") == section)
    return records.select("org_id", "record_id", "provider_id", *[
        F.try_element_at("attrs", fixtures.attr_id(b).cast("string")).alias(f"value_{b}") for b in bases])


def tenants_cte(section: int, *bases: int) -> str:
    columns = "".join(f", min(CASE WHEN kv.attribute_id = {b} + c.org_id * 1000 THEN kv.value END) AS value_{b}" for b in bases)
    return f"""w AS (SELECT c.org_id, c.record_id, c.provider_id{columns} FROM ctx c LEFT JOIN kv ON kv.record_id = c.record_id
  WHERE c.section_id = {section} GROUP BY c.org_id, c.record_id, c.provider_id)"""


def _pred_query(section, attribute, operator, value):
    def q(spark, sf):
        df = attribute_values(spark, sf, section, attribute).withColumnRenamed(f"value_{attribute}", "value")
        return df.where(predicate(F.col("value"), operator, value))
    return q


for _name, (_s, _a, _op, _v, _cond) in PRED_CASES.items():
    register(_name, with_fixture(f"SELECT org_id, record_id, provider_id, value_{_a} AS value FROM w WHERE {_cond.replace('value', f'value_{_a}')}", tenants_cte(_s, _a)))(
        _pred_query(_s, _a, _op, _v))


@register("pred_conjunction", with_fixture(
    "SELECT * FROM w WHERE value_201 <> 'F' AND value_202 ILIKE '%high%'", tenants_cte(2, 201, 202, 203)))
def q_pred_conjunction(spark, sf):
    """AND of the applicable filters; a filter on another section and one with a null value are skipped."""
    df = attribute_values(spark, sf, 2, 201, 202, 203)
    pred, _ignored = report_filter(
        [Filter(2, 201, "!=", "F"), Filter(2, 202, "Contains", " high "), Filter(1, 101, "=", "X"), Filter(2, 203, "=", None)],
        {(2, a): f"value_{a}" for a in (201, 202, 203)},
    )
    return df.where(pred)


# ---------------------------------------------------------------------------
# Reads, listings, ordering
# ---------------------------------------------------------------------------

from sectora.operators import reports as rep  # noqa: E402

ORDER_101 = "attr_1102 DESC NULLS FIRST, attr_1203 ASC NULLS LAST, r1 ASC NULLS LAST, r2 ASC NULLS LAST"
COLUMNS_101 = "provider_id, attr_1101, attr_1102, attr_1103, attr_1201, attr_1203"


def _base_101(outer: str) -> str:
    """Report 101 with the records that its rows are made of, as ``base``, and ``outer``."""
    core = REPORT_101_SQL.replace("SELECT s1.provider_id", "SELECT s1.record_id AS r1, s2.record_id AS r2, s1.provider_id")
    head, _, tail = core.rpartition("\nSELECT")
    return f"{head},\nbase AS (SELECT{tail})\n{outer}"


def built_101(spark, sf):
    """Report 101 built through the run log; the base folder, the definitions and the plan."""
    defs, base = region_definitions(spark, sf), scratch_path(spark, "reports")
    rep.rebuild(spark, store(spark, sf), defs, base, [(1, 101)], clock=lambda: dt.datetime.fromisoformat(NOW))
    return base, defs, plan_from_tables(defs, 101, 1)


def materialized_101(spark, sf):
    base, _, plan = built_101(spark, sf)
    return spark.read.parquet(run_log.snapshot_of(run_log.read(spark, f"{base}/runs"), 1, 101)), plan


@register("materialize_report", REPORT_101_SQL)
def q_materialize_report(spark, sf):
    return rep.visible(materialized_101(spark, sf)[0])


@register("read_report", _base_101(f"""SELECT 'Report 1 ' || r_name AS report_name, TIMESTAMP '{NOW}' AS last_run_date, (SELECT least(count(*), 100) FROM base) AS count, base.* EXCLUDE (r1, r2)
FROM base, regions WHERE regions.org_id = 1 ORDER BY {ORDER_101} LIMIT 100"""))
def q_read_report(spark, sf):
    """One read by tenant, report and limit: the run log names the snapshot; metadata, count and the first 100 rows in sort order."""
    base, defs, _ = built_101(spark, sf)
    page = rep.open_report(spark, base, defs, 1, 101, 100)
    facts = [F.lit(page.name).alias("report_name"), F.lit(page.last_run_date).cast("timestamp_ntz").alias("last_run_date"), F.lit(page.count).cast("long").alias("count")]
    return page.rows.select(*facts, "*")


@register("apply_report_sorts", _base_101(f"SELECT {COLUMNS_101} FROM base ORDER BY {ORDER_101}"))
def q_apply_report_sorts(spark, sf):
    snap, plan = materialized_101(spark, sf)
    return rep.visible(rep.order_report(snap, plan.sorts))


@register("result_count", _base_101(f"SELECT count(*) AS count FROM (SELECT * FROM base ORDER BY {ORDER_101} LIMIT 100)"))
def q_result_count(spark, sf):
    snap, plan = materialized_101(spark, sf)
    return rep.result_count(rep.read_report(snap, plan.sorts, 100))


@register("report_metadata", with_fixture(
    "SELECT report_id, name, description, last_run_date FROM reports WHERE org_id = 1 AND report_id = 101 LIMIT 1"))
def q_report_metadata(spark, sf):
    return rep.report_metadata(definitions(spark, sf)["reports"], 1, 101)


@register("list_reports", with_fixture("""
SELECT report_id, name, description, created_at, updated_at, status, last_run_date FROM reports
WHERE org_id = 1 ORDER BY updated_at DESC NULLS FIRST, report_id DESC
"""))
def q_list_reports(spark, sf):
    return rep.list_reports(definitions(spark, sf)["reports"], 1)


@register("list_reports_by_created", with_fixture("""
SELECT report_id, name, description, created_at, updated_at, status FROM reports
WHERE org_id = 1 ORDER BY created_at DESC NULLS FIRST, report_id DESC
"""))
def q_list_reports_by_created(spark, sf):
    return rep.list_reports(definitions(spark, sf)["reports"], 1, by="created_at")


@register("order_report_attributes", with_fixture("""
SELECT report_id, org_id, section_id, attribute_id,
       CAST(row_number() OVER (PARTITION BY report_id, org_id ORDER BY section_id, attribute_id) AS INTEGER) AS position
FROM rattr
"""))
def q_order_report_attributes(spark, sf):
    return rep.report_attribute_order(definitions(spark, sf)["report_section_attributes"])


@register("report_section_grouping", with_fixture("""
SELECT report_id, org_id, section_id, 's' || CAST(section_id AS VARCHAR) AS alias,
       section_id = min(section_id) OVER (PARTITION BY report_id, org_id) AS is_driver,
       attribute_ids_json
FROM (SELECT report_id, org_id, section_id, to_json(list(DISTINCT attribute_id ORDER BY attribute_id)) AS attribute_ids_json
      FROM rattr GROUP BY report_id, org_id, section_id)
"""))
def q_report_section_grouping(spark, sf):
    g = rep.report_section_groups(definitions(spark, sf)["report_section_attributes"])
    return g.select("report_id", "org_id", "section_id", "alias", "is_driver",
                    F.to_json("attribute_ids").alias("attribute_ids_json"))


QUERY_TEXT_SQL = with_fixture("""
SELECT p.report_id, p.org_id,
  CASE WHEN c.ctes IS NULL THEN '-- No config found for reportId ' || p.report_id
       WHEN w.op IS NOT NULL THEN '-- Unsupported operator: ' || w.op
       ELSE 'WITH ' || c.ctes || ' SELECT provider_id' || c.shown || ' FROM ' || c.joins || coalesce(' WHERE ' || t.tests, '') END AS query
FROM reports p
LEFT JOIN (SELECT report_id, org_id, string_agg(cte, ', ' ORDER BY section_id) AS ctes, string_agg(shown, '' ORDER BY section_id) AS shown,
                  string_agg(j, '' ORDER BY section_id) AS joins FROM ctes GROUP BY report_id, org_id) c USING (report_id, org_id)
LEFT JOIN (SELECT report_id, org_id, string_agg(test, ' AND ' ORDER BY section_id, attribute_id, operator, value) AS tests FROM tests WHERE test IS NOT NULL GROUP BY report_id, org_id) t USING (report_id, org_id)
LEFT JOIN (SELECT report_id, org_id, arg_min(op, (section_id, attribute_id, operator, value)) AS op FROM tests
           WHERE op NOT IN ('=', '!=', '<>', '>', '<', '>=', '<=', 'CONTAINS', 'LIKE', 'IN') GROUP BY report_id, org_id) w USING (report_id, org_id)
""", """
tests AS (
  SELECT f.*, upper(trim(operator)) AS op, 's' || section_id || '_a' || attribute_id || ' ' || CASE upper(trim(operator))
      WHEN 'IN' THEN 'IN (' || array_to_string(list_transform(list_filter(list_transform(string_split(value, ','), lambda x: trim(x)), lambda x: x <> ''),
                                                              lambda x: chr(39) || replace(x, chr(39), chr(39) || chr(39)) || chr(39)), ', ') || ')'
      WHEN 'CONTAINS' THEN 'ILIKE ' || chr(39) || '%' || replace(trim(value), chr(39), chr(39) || chr(39)) || '%' || chr(39)
      ELSE CASE upper(trim(operator)) WHEN '!=' THEN '<>' ELSE upper(trim(operator)) END || ' ' || chr(39) || replace(trim(value), chr(39), chr(39) || chr(39)) || chr(39) END AS test
  FROM rfilt f WHERE value IS NOT NULL AND EXISTS (SELECT 1 FROM rattr a WHERE a.report_id = f.report_id AND a.org_id = f.org_id AND a.section_id = f.section_id)
),
picked AS (
  SELECT report_id, org_id, section_id, attribute_id, min(k) AS k FROM (
    SELECT report_id, org_id, section_id, attribute_id, 0 AS k FROM rattr UNION ALL SELECT report_id, org_id, section_id, attribute_id, 1 FROM tests)
  GROUP BY report_id, org_id, section_id, attribute_id
),
ctes AS (
  SELECT report_id, org_id, section_id, 's' || section_id || ' AS (SELECT provider_id'
      || string_agg(', attr_' || attribute_id || ' AS s' || section_id || '_a' || attribute_id, '' ORDER BY k, attribute_id)
      || ' FROM org_' || org_id || '_section_' || section_id || ')' AS cte,
    coalesce(string_agg(', s' || section_id || '_a' || attribute_id || ' AS attr_' || attribute_id, '' ORDER BY attribute_id) FILTER (k = 0), '') AS shown,
    CASE WHEN section_id = min(section_id) OVER (PARTITION BY report_id, org_id) THEN 's' || section_id ELSE ' LEFT JOIN s' || section_id || ' USING (provider_id)' END AS j
  FROM picked GROUP BY report_id, org_id, section_id
)
""")


@register("report_query_text", QUERY_TEXT_SQL)
def q_report_query_text(spark, sf):
    """Generated SQL text of every report of every tenant, or why it has none, in one job."""
    return rep.query_texts(definitions(spark, sf))


REBUILT_SQL = """
CASE WHEN NOT EXISTS (SELECT 1 FROM rattr a WHERE a.report_id = p.report_id AND a.org_id = p.org_id)
              OR EXISTS (SELECT 1 FROM rfilt f WHERE f.report_id = p.report_id AND f.org_id = p.org_id AND f.value IS NOT NULL
                           AND upper(trim(f.operator)) NOT IN ('=', '!=', '<>', '>', '<', '>=', '<=', 'CONTAINS', 'LIKE', 'IN')
                           AND f.section_id IN (SELECT a.section_id FROM rattr a WHERE a.report_id = p.report_id AND a.org_id = p.org_id))
            THEN 'failed' ELSE 'completed' END"""


@register("rebuild_all_pending", with_fixture(f"""
SELECT p.report_id, p.org_id, CASE WHEN p.status = 'created' THEN {REBUILT_SQL} ELSE p.status END AS status,
       CASE WHEN p.status = 'created' AND {REBUILT_SQL} = 'completed' THEN TIMESTAMP '{NOW}' ELSE p.last_run_date END AS last_run_date
FROM reports p
""", growing=False))
def q_rebuild_all_pending(spark, sf):
    """Every pending report of the regions built from one shared store, a failing definition not stopping the rest; then the
    status of all reports. A second rebuild finds nothing to do."""
    defs, base, clock = region_definitions(spark, sf), scratch_path(spark, "reports"), lambda: dt.datetime.fromisoformat(NOW)
    records = store(spark, sf)
    rep.rebuild(spark, records, defs, base, clock=clock)
    assert rep.rebuild(spark, records, defs, base, clock=clock).isEmpty()
    runs = run_log.read(spark, f"{base}/runs")
    return run_log.states(defs["reports"], runs).select("report_id", "org_id", "status", "last_run_date")


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------

from sectora.functions import text as fx  # noqa: E402
from sectora.operators import tasks as tk  # noqa: E402


@register("fn_cast_string", with_fixture("""
SELECT record_id, CAST(record_id AS VARCHAR) AS record_text, CAST(record_is_deleted AS VARCHAR) AS deleted_text FROM records
"""))
def q_fn_cast_string(spark, sf):
    r = eav(spark, sf).records
    return r.select("record_id", F.col("record_id").cast("string").alias("record_text"),
                    F.col("record_is_deleted").cast("string").alias("deleted_text"))


@register("fn_trim_upper", with_fixture("""
SELECT report_id, org_id, section_id, attribute_id, upper(trim(operator)) AS operator_norm FROM rfilt
"""))
def q_fn_trim_upper(spark, sf):
    f = definitions(spark, sf)["report_filters"]
    return f.select("report_id", "org_id", "section_id", "attribute_id", fx.normalise_operator(F.col("operator")).alias("operator_norm"))


@register("fn_split_csv", with_fixture("""
SELECT report_id, org_id, section_id, attribute_id,
       to_json(list_filter(list_transform(string_split(value, ','), lambda x: trim(x)), lambda x: x <> '')) AS items_json
FROM rfilt WHERE value IS NOT NULL
"""))
def q_fn_split_csv(spark, sf):
    f = definitions(spark, sf)["report_filters"].where(F.col("value").isNotNull())
    return f.select("report_id", "org_id", "section_id", "attribute_id", F.to_json(fx.split_csv(F.col("value"))).alias("items_json"))


@register("fn_concat_ws", with_fixture("""
SELECT org_id, section_id, string_agg(attribute_name, ',' ORDER BY attribute_name) AS attribute_names
FROM catalog GROUP BY org_id, section_id
""", CATALOG_CTE))
def q_fn_concat_ws(spark, sf):
    c = catalog(spark, sf)
    return c.groupBy("org_id", "section_id").agg(fx.csv_of_sorted(F.collect_list("attribute_name")).alias("attribute_names"))


@register("fn_regex_name", with_fixture("""
SELECT attribute_id, org_id,
       lower(CASE WHEN regexp_matches(substr(n, 1, 1), '^[0-9]$') THEN 'attr_' || n ELSE n END) AS column_name
FROM (SELECT attribute_id, org_id,
             CASE WHEN regexp_replace(trim(attribute_name), '[^A-Za-z0-9_]', '_', 'g') = '' THEN 'col'
                  ELSE regexp_replace(trim(attribute_name), '[^A-Za-z0-9_]', '_', 'g') END AS n
      FROM catalog)
""", CATALOG_CTE))
def q_fn_regex_name(spark, sf):
    c = catalog(spark, sf)
    return c.select("attribute_id", "org_id", fx.sanitize_name_col(F.col("attribute_name")).alias("column_name"))


@register("fn_table_name", with_fixture("""
SELECT DISTINCT org_id, section_id, 'org_' || CAST(org_id AS VARCHAR) || '_section_' || CAST(section_id AS VARCHAR) AS table_name
FROM ctx
"""))
def q_fn_table_name(spark, sf):
    s = rec.org_sections(rec.section_context(eav(spark, sf)))
    return s.select("org_id", "section_id", fx.section_table_name(F.col("org_id"), F.col("section_id")).alias("table_name"))


@register("fn_now", with_fixture(f"SELECT report_id, org_id, TIMESTAMP '{NOW}' AS checked_at FROM reports"))
def q_fn_now(spark, sf):
    return definitions(spark, sf)["reports"].select("report_id", "org_id", now_col().alias("checked_at"))


@register("fn_report_id", with_fixture("""
SELECT request_id, org_id, true AS is_positive, true AS is_unique, true AS is_new, true AS is_stable FROM req WHERE report_id IS NULL
""", REQ))
def q_fn_report_id(spark, sf):
    """Ids of new reports: positive, unique, unlike all stored ids, and the same when allocated again."""
    reqs, reports = requests(spark, sf), definitions(spark, sf)["reports"]
    ids, again = (dfn.allocate_ids(reqs, reports, now_col()) for _ in range(2))
    shared = ids.groupBy("report_id").agg(F.count("*").alias("n"))
    stored = reports.select("report_id", F.lit(True).alias("stored")).distinct()
    out = ids.join(again.withColumnRenamed("report_id", "second"), ["request_id", "org_id"], "left").join(shared, "report_id").join(stored, "report_id", "left")
    return out.select("request_id", "org_id", (F.col("report_id") > 0).alias("is_positive"), (F.col("n") == 1).alias("is_unique"),
                      F.col("stored").isNull().alias("is_new"), F.col("report_id").eqNullSafe(F.col("second")).alias("is_stable"))


def tasks(spark, sf):
    return fixtures.tasks(spark, sf)


@register("fn_coalesce_display", with_fixture("""
SELECT id, coalesce(nullif(documentName, ''), nullif(formName, ''), nullif(sectionName, '')) AS display_name FROM tasks
""", TASKS_CTE))
def q_fn_coalesce_display(spark, sf):
    return tk.display_columns(tasks(spark, sf)).select("id", "display_name")


@register("fn_label_map", with_fixture("""
SELECT id,
  CASE type WHEN 'document' THEN 'Document Upload' WHEN 'profile' THEN 'Profile Information' WHEN 'signature' THEN 'PDF Signature' END AS type_label,
  CASE status WHEN 'pending' THEN 'Pending' WHEN 'in_progress' THEN 'In Progress' WHEN 'completed' THEN 'Completed' END AS status_label,
  CASE type WHEN 'document' THEN 'Upload Document' WHEN 'profile' THEN 'Complete Section' WHEN 'signature' THEN 'Open Form' ELSE 'Open' END AS action
FROM tasks
""", TASKS_CTE))
def q_fn_label_map(spark, sf):
    return tk.display_columns(tasks(spark, sf)).select("id", "type_label", "status_label", "action")


@register("fn_array_head", with_fixture("""
SELECT id, to_json(list_transform(coalesce(fields, [])[1:3], lambda f: {'label': f.label, 'value': coalesce(nullif(f.value, ''), '—')})) AS preview_json
FROM tasks
""", TASKS_CTE))
def q_fn_array_head(spark, sf):
    return tk.field_preview(tasks(spark, sf)).select("id", F.to_json("preview").alias("preview_json"))


# ---------------------------------------------------------------------------
# Task analytics
# ---------------------------------------------------------------------------


@register("tasks_split", with_fixture("""
SELECT id, provider_id, type, status, CASE WHEN status = 'completed' THEN 'completed' ELSE 'open' END AS bucket FROM tasks
""", TASKS_CTE))
def q_tasks_split(spark, sf):
    return tk.split_tasks(tasks(spark, sf)).select("id", "provider_id", "type", "status", "bucket")


@register("tasks_search", with_fixture("""
SELECT id, title, description, type, status FROM tasks
WHERE contains(lower(coalesce(title, '')), 'ur') OR contains(lower(coalesce(description, '')), 'ur')
""", TASKS_CTE))
def q_tasks_search(spark, sf):
    return tk.search_tasks(tasks(spark, sf), "UR").select("id", "title", "description", "type", "status")


@register("tasks_search_typed", with_fixture("""
SELECT id, title, description, type, status FROM tasks
WHERE (contains(lower(coalesce(title, '')), '": 4') OR contains(lower(coalesce(description, '')), '": 4')) AND type = 'signature'
""", TASKS_CTE))
def q_tasks_search_typed(spark, sf):
    """Literal search (quotes and digits are not patterns) restricted to one task type."""
    return tk.search_tasks(tasks(spark, sf), '": 4', "signature").select("id", "title", "description", "type", "status")


@register("tasks_kpi", with_fixture("""
SELECT provider_id, count(*) AS total, count(*) FILTER (WHERE status <> 'completed') AS pending,
       count(*) FILTER (WHERE status = 'completed') AS completed,
       count(*) FILTER (WHERE status = 'completed' AND type = 'document') AS completed_documents,
       count(*) FILTER (WHERE status = 'completed' AND type = 'profile') AS completed_profiles,
       count(*) FILTER (WHERE status = 'completed' AND type = 'signature') AS completed_signatures,
       CAST(floor(100.0 * count(*) FILTER (WHERE status = 'completed') / count(*) + 0.5) AS BIGINT) AS completion_rate
FROM tasks GROUP BY provider_id
""", TASKS_CTE))
def q_tasks_kpi(spark, sf):
    return tk.task_kpis(tasks(spark, sf))


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

from sectora.sinks import tables as sink  # noqa: E402
from sectora.sinks import wide as wide_sink  # noqa: E402
from sectora.sources.files import read_parquet  # noqa: E402


@register("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_scan_parquet(spark, sf):
    return read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"])


@register("sink_table_overwrite", with_fixture("SELECT * FROM catalog", CATALOG_CTE))
def q_sink_table_overwrite(spark, sf):
    """A typed table replaced twice, each time by one commit; readers follow the newest."""
    c = catalog(spark, sf)
    path = scratch_path(spark, "attribute_section")
    sink.replace_table(c.union(c), path)
    sink.replace_table(c, path)
    return sink.read_table(spark, path)


@register("sink_table_append", with_fixture("""
SELECT CAST(attribute_id AS VARCHAR) AS attribute_id, CAST(section_id AS VARCHAR) AS section_id, attribute_name, section_name,
       CAST(org_id AS VARCHAR) AS org_id, attribute_type, attribute_options FROM catalog
UNION ALL
SELECT CAST(attribute_id AS VARCHAR), CAST(section_id AS VARCHAR), attribute_name, section_name,
       CAST(org_id AS VARCHAR), attribute_type, attribute_options FROM catalog
""", CATALOG_CTE))
def q_sink_table_append(spark, sf):
    c = catalog(spark, sf)
    path = scratch_path(spark, "attribute_section")
    sink.write_table(c, path, "append")
    sink.write_table(c, path, "append")
    return spark.read.parquet(path)


@register("sink_skip_empty", with_fixture("SELECT * FROM catalog", CATALOG_CTE))
def q_sink_skip_empty(spark, sf):
    c = catalog(spark, sf)
    path = scratch_path(spark, "attribute_section")
    sink.write_table(c, path, "overwrite")
    wrote = sink.write_table(c.where(F.lit(False)), path, "overwrite", skip_empty=True)
    assert not wrote
    return spark.read.parquet(path)


ALL_IDS = [b + 1000 * o for o in range(5) for b, _, s, _ in fixtures.ATTRIBUTE_TEMPLATES if s in (1, 2)]


@register("sink_parquet_sections", with_fixture("SELECT c.record_id, c.org_id, c.section_id, c.section_name" + "".join(
    f', min(CASE WHEN kv.attribute_id = {a} THEN kv.value END) AS "{a}"' for a in ALL_IDS) + """
FROM ctx c LEFT JOIN kv ON kv.record_id = c.record_id GROUP BY c.record_id, c.org_id, c.section_id, c.section_name"""))
def q_sink_parquet_sections(spark, sf):
    """Export every section to a folder with columns of its own, then read all of them back under the union of their columns."""
    e, base = eav(spark, sf), scratch_path(spark, "sections")
    wide_sink.export_wide(sec.section_records(e), sec.section_attributes(e), base)
    back = wide_sink.read_all(spark, base)
    return back.select("record_id", "org_id", "section_id", "section_name", *[f"`{a}`" for a in ALL_IDS])


@register("sink_name_sanitize", with_fixture("""
SELECT record_id, provider_id, attr_1101 AS segment, attr_1102 AS balance, attr_1103 AS nation, attr_1104 AS never_filled FROM w
""", wide_cte("w", 1, 1, ids_of(1, 1))))
def q_sink_name_sanitize(spark, sf):
    names = {1000 + b: n for b, n, s, _ in fixtures.ATTRIBUTE_TEMPLATES if s == 1}
    df = wide(spark, sf, 1, 1)
    renamed = df.toDF(*[("Record ID" if c == "record_id" else names.get(int(c[5:]), c) if c.startswith("attr_") else c)
                        for c in df.columns])
    return sink.sanitize_columns(renamed)


@register("sink_type_map", with_fixture("""
SELECT 'record_id' AS column_name, 'INTEGER' AS warehouse_type, 'int' AS stored_type, count(*) FILTER (record_id <= 2147483647) AS n_values,
       count(*) FILTER (record_id > 2147483647) AS n_rejected FROM vals
UNION ALL SELECT 'attribute_id', 'BIGINT', 'bigint', count(*) FILTER (record_id <= 2147483647 AND strlen(coalesce(value, '')) <= 12), 0 FROM vals WHERE record_id <= 2147483647
UNION ALL SELECT 'value', 'VARCHAR(12)', 'string', count(value) FILTER (record_id <= 2147483647 AND strlen(value) <= 12), count(*) FILTER (strlen(value) > 12) FROM vals
""".replace("count(*) FILTER (record_id <= 2147483647) AS n_values", "count(*) FILTER (record_id <= 2147483647 AND strlen(coalesce(value, '')) <= 12) AS n_values")))
def q_sink_type_map(spark, sf):
    """All values written to a typed target: the type map applied as casts, with overflowing ids and texts of too many bytes reported."""
    path = scratch_path(spark, "typed_values")
    columns = [("record_id", "INTEGER"), ("attribute_id", "BIGINT"), ("value", "VARCHAR(12)")]
    done = sink.replace_table(eav(spark, sf).values, path, columns, on_violation="report")
    table = sink.read_table(spark, path)
    rejects = spark.read.parquet(done.rejects).select(F.explode("_violations").alias("v")) if done.rejects else None
    counts = table.agg(*[F.count(c).alias(c) for c, _ in columns]).unpivot([], [c for c, _ in columns], "column_name", "n_values")
    types = F.create_map(*[F.lit(x) for c, t in columns for x in (c, t)])
    stored = F.create_map(*[F.lit(x) for c, t in table.dtypes for x in (c, t)])
    bad = spark.range(0).select(F.lit("").alias("column_name"), F.col("id").alias("n_rejected")) if rejects is None else rejects.groupBy(
        F.col("v.column").alias("column_name")).agg(F.count("*").alias("n_rejected"))
    return counts.join(bad, "column_name", "left").select(
        "column_name", types[F.col("column_name")].alias("warehouse_type"), stored[F.col("column_name")].alias("stored_type"), "n_values",
        F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected"))


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

from sectora.streaming import change_events, start_rebuild_stream  # noqa: E402


@register("stream_rebuild", with_fixture(f"""
SELECT target_id AS report_id, org_id, 'completed' AS status FROM v
UNION ALL SELECT p.report_id, p.org_id, {REBUILT_SQL} FROM reports p WHERE p.status = 'created' AND NOT EXISTS (
  SELECT 1 FROM v WHERE v.target_id = p.report_id AND v.org_id = p.org_id)
""", REGION_UPSERT_CTES, growing=False))
def q_stream_rebuild(spark, sf):
    """Saved definitions and those still pending emit change events, each twice; the stream rebuilds each report once, and one of
    every region fails by its definition."""
    state = {n: df for n, df in upserted(spark, sf, growing=False).items()}
    base = scratch_path(spark, "stream")
    events = change_events(state["reports"].where("status = 'created'"), F.col("updated_at"))
    events.union(events).write.json(f"{base}/events")  # duplicates on purpose
    records = store(spark, sf)
    q = start_rebuild_stream(
        spark, f"{base}/events", f"{base}/checkpoint", f"{base}/outcomes",
        records=lambda: records, definitions=lambda: state, snapshots_path=f"{base}/reports",
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/outcomes").select("report_id", "org_id", "status")
