"""Test fixtures derived from the driver's TPC-H-like tables.

The reference reads EAV tables from an operational database. For tests and benchmarks we
derive equivalent tables from ``region``, ``nation``, ``customer``, ``orders`` and
``events`` so that every query's work grows with the input. The DuckDB oracle
(``sectora.oracle``) builds the same tables with the same expressions.

Rules (org = the customer's region, provider = the customer):

* sections: 1 Profile (kept), 2 Orders (flags null, kept), 3 Archived (inactive, dropped),
  4 Removed (deleted, dropped), 5 Empty (kept, no attributes).
* records: one per customer in sections 1, 3, 4, 5 (``id = section * 1e9 + custkey``) and one
  per order in section 2 (``id = 2e9 + orderkey``, provider = the order's customer).
  Deleted when ``key % 11 = 0``, deleted flag null when ``key % 7 = 0``.
* attributes: per org ``id = base + 1000 * org`` for the bases below, plus one row with a
  null section and one with a null org.
* values: customer and order fields as text, with a null balance when ``custkey % 17 = 0``,
  a second segment value when ``custkey % 13 = 0``, a value of a foreign attribute when
  ``custkey % 19 = 0`` and rows with null keys when ``custkey % 23 = 0`` / ``% 29 = 0``.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectora.sources.eav import Eav, load_eav

SECTION_STRIDE = 1_000_000_000
ORG_STRIDE = 1000

# Fixed values of the fixture: sections (id, name, is_deleted, is_active).
SECTION_ROWS = [
    (1, "Profile", False, True),
    (2, "Orders", None, None),
    (3, "Archived", False, False),
    (4, "Removed", True, True),
    (5, "Empty", False, True),
]

# Fixed values of the fixture: attribute templates (base id, name, section, type).
ATTRIBUTE_TEMPLATES = [
    (101, "segment", 1, "select"),
    (102, "balance", 1, "number"),
    (103, "nation", 1, "text"),
    (104, "never filled", 1, "text"),
    (201, "status", 2, "select"),
    (202, "priority", 2, "text"),
    (203, "total", 2, "number"),
    (301, "archived note", 3, "text"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def attr_id(base: int, org: Column | str = "org_id") -> Column:
    """Attribute id of template ``base`` in an org."""
    org_col = F.col(org) if isinstance(org, str) else org
    return (F.lit(base).cast("long") + org_col.cast("long") * F.lit(ORG_STRIDE)).cast("long")


def expand(df: DataFrame, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """Repeat every row of ``df`` once per literal row (a generator, not a join)."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return df.select("*", F.explode(F.array(*structs)).alias("_t")).select(
        *[c for c in df.columns], *[F.col(f"_t.{f.name}").alias(f.name) for f in schema.fields]
    )


def deleted_flag(key: Column) -> Column:
    return (
        F.when(key % 11 == 0, F.lit(True))
        .when(key % 7 == 0, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )


def money_text(c: Column) -> Column:
    """Doubles are rendered through decimal(18,2) so Spark and DuckDB give the same text."""
    return c.cast("decimal(18,2)").cast("string")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            "c_custkey", "c_acctbal", "c_mktsegment", "n_name",
            F.col("n_regionkey").cast("long").alias("org_id"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = customers(spark, sf_dir).select("c_custkey", "org_id")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .drop("c_custkey")
    )


def eav_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five EAV source tables with the source systems' column names."""
    cust = customers(spark, sf_dir)
    ords = orders(spark, sf_dir)
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("org_id"))

    row = T.StructType.fromDDL("id long, name string, is_deleted boolean, is_active boolean")
    section = expand(spark.range(1).withColumnRenamed("id", "_one"), SECTION_ROWS, row).drop("_one")

    sect = T.StructType([T.StructField("section_id", T.LongType())])
    cust_records = expand(cust, [(1,), (3,), (4,), (5,)], sect).select(
        (F.col("section_id") * F.lit(SECTION_STRIDE) + F.col("c_custkey")).alias("id"),
        "section_id",
        F.col("c_custkey").alias("provider_id"),
        "org_id",
        deleted_flag(F.col("c_custkey")).alias("is_deleted"),
    )
    order_records = ords.select(
        (F.lit(2 * SECTION_STRIDE).cast("long") + F.col("o_orderkey")).alias("id"),
        F.lit(2).cast("long").alias("section_id"),
        F.col("o_custkey").alias("provider_id"),
        "org_id",
        deleted_flag(F.col("o_orderkey")).alias("is_deleted"),
    )
    provider_profile = cust_records.unionByName(order_records)

    tmpl = T.StructType([
        T.StructField("base", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("section_id", T.LongType()),
        T.StructField("type", T.StringType()),
    ])
    per_org = expand(region, ATTRIBUTE_TEMPLATES, tmpl).select(
        (F.col("base") + F.col("org_id") * F.lit(ORG_STRIDE)).alias("id"),
        "name", "section_id", "org_id", "type",
    )
    odd = region.where(F.col("org_id") == 0)
    attribute = per_org.unionByName(
        odd.select(
            F.lit(9001).cast("long").alias("id"), F.lit("orphan").alias("name"),
            F.lit(None).cast("long").alias("section_id"), F.col("org_id"), F.lit("text").alias("type"),
        )
    ).unionByName(
        odd.select(
            F.lit(9002).cast("long").alias("id"), F.lit("no org").alias("name"),
            F.lit(1).cast("long").alias("section_id"), F.lit(None).cast("long").alias("org_id"),
            F.lit("text").alias("type"),
        )
    )

    attribute_option = (
        cust.select(attr_id(101).alias("attribute_id"), F.col("c_mktsegment").alias("value")).distinct()
        .unionByName(ords.select(attr_id(201).alias("attribute_id"), F.col("o_orderstatus").alias("value")).distinct())
        .unionByName(  # one duplicate option per org
            cust.groupBy("org_id").agg(F.min("c_mktsegment").alias("value"))
            .select(attr_id(101).alias("attribute_id"), "value")
        )
        .unionByName(region.select(attr_id(102).alias("attribute_id"), F.lit(None).cast("string").alias("value")))
        .unionByName(odd.select(F.lit(None).cast("long").alias("attribute_id"), F.lit("ORPHAN OPTION").alias("value")))
    )

    rec1 = F.lit(SECTION_STRIDE).cast("long") + F.col("c_custkey")
    rec2 = F.lit(2 * SECTION_STRIDE).cast("long") + F.col("o_orderkey")
    rec3 = F.lit(3 * SECTION_STRIDE).cast("long") + F.col("c_custkey")

    def v(df: DataFrame, rec: Column | None, attr: Column | None, value: Column) -> DataFrame:
        return df.select(
            (rec if rec is not None else F.lit(None)).cast("long").alias("provider_profile_id"),
            (attr if attr is not None else F.lit(None)).cast("long").alias("attribute_id"),
            value.cast("string").alias("value"),
        )

    key = F.col("c_custkey")
    parts = [
        v(cust, rec1, attr_id(101), F.col("c_mktsegment")),
        v(cust, rec1, attr_id(102), F.when(key % 17 == 0, F.lit(None)).otherwise(money_text(F.col("c_acctbal")))),
        v(cust, rec1, attr_id(103), F.col("n_name")),
        v(cust.where(key % 13 == 0), rec1, attr_id(101), F.concat(F.lit("ZZ_"), F.col("c_mktsegment"))),
        v(cust.where(key % 19 == 0), rec1, attr_id(201), F.lit("FOREIGN")),
        v(cust.where(key % 23 == 0), None, attr_id(101), F.lit("NO RECORD")),
        v(cust.where(key % 29 == 0), rec1, None, F.lit("NO ATTRIBUTE")),
        v(cust, rec3, attr_id(301), F.concat(F.lit("archived "), F.col("c_mktsegment"))),
        v(ords, rec2, attr_id(201), F.col("o_orderstatus")),
        v(ords, rec2, attr_id(202), F.col("o_orderpriority")),
        v(ords, rec2, attr_id(203), money_text(F.col("o_totalprice"))),
    ]
    attribute_value = parts[0]
    for p in parts[1:]:
        attribute_value = attribute_value.unionByName(p)

    return {
        "provider_profile": provider_profile,
        "section": section,
        "attribute": attribute,
        "attribute_option": attribute_option,
        "attribute_value": attribute_value,
    }


def fixture_eav(spark: SparkSession, sf_dir: str) -> Eav:
    return load_eav(eav_sources(spark, sf_dir))


# ---------------------------------------------------------------------------
# Report definitions: five per org, and one per customer (of the kind ``custkey % 5 + 1``), so that their number grows.
#  1 two sections, a filter on each, two sorts
#  2 one section (+ a section without attributes), one sort
#  3 a filter on a section absent from the report, a null value, a text '>' compare
#  4 IN with blanks and a quote
#  5 unsupported operator (its build must fail)
# ---------------------------------------------------------------------------

# Fixed values of the fixture: (k, section, attribute base) of report k.
REPORT_ATTRIBUTE_ROWS = [
    (1, 1, 101), (1, 1, 102), (1, 1, 103), (1, 2, 201), (1, 2, 203),
    (2, 2, 201), (2, 2, 202), (2, 2, 203),
    (3, 1, 101), (3, 1, 103),
    (4, 1, 101), (4, 1, 102),
    (5, 1, 103),
]
# Fixed values of the fixture: (k, section) of report k.
REPORT_SECTION_ROWS = [(1, 1), (1, 2), (2, 2), (2, 5), (3, 1), (4, 1), (5, 1)]
# Fixed values of the fixture: (k, section, attribute base, operator, value).
REPORT_FILTER_ROWS = [
    (1, 1, 103, "CONTAINS", "ation_1"),
    (1, 2, 201, "!=", "P"),
    (3, 2, 201, "=", "F"),
    (3, 1, 101, "=", None),
    (3, 1, 102, " > ", "5000"),
    (4, 1, 101, "in", " BUILDING, ,MACHINERY,,O'Brien "),
    (5, 1, 103, "BETWEEN", "a"),
]
# Fixed values of the fixture: (k, section, attribute base, direction, sort order).
REPORT_SORT_ROWS = [
    (1, 1, 102, "desc", 1),
    (1, 2, 203, "asc", 2),
    (2, 2, 202, "asc", 1),
    (4, 1, 101, "desc", 1),
]
REPORT_STATUS = {1: "completed", 2: "created", 3: "created", 4: "completed", 5: "created"}
BASE_TIME = "2026-01-01 00:00:00"


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("org_id"), F.col("r_name")
    )


def owners(spark: SparkSession, sf_dir: str, growing: bool = True) -> DataFrame:
    """Who owns reports: ``owner, org_id, r_name, only``. A region owns one of every kind, a customer the kind ``only``."""
    regions = _regions(spark, sf_dir)
    own = regions.select(F.col("org_id").alias("owner"), "org_id", "r_name", F.lit(None).cast("long").alias("only"))
    if not growing:
        return own
    cust = customers(spark, sf_dir).select("c_custkey", "org_id").join(regions, "org_id")
    return own.unionByName(cust.select((F.col("c_custkey") + 1000).alias("owner"), "org_id", "r_name", (F.col("c_custkey") % 5 + 1).alias("only")))


def definition_sources(spark: SparkSession, sf_dir: str, growing: bool = True) -> dict[str, DataFrame]:
    """The five definition tables as stored (org and some ids as text): five reports per org, and with ``growing`` one per customer."""
    owned = owners(spark, sf_dir, growing)

    def per_owner(rows, schema) -> DataFrame:
        return expand(owned, rows, schema).where(F.col("only").isNull() | (F.col("only") == F.col("k")))

    rid = (F.col("owner") * 100 + F.col("k")).cast("long")
    hours = (F.col("owner") % 1000 * 100 + F.col("k")).cast("int")
    base_ts = F.to_timestamp_ntz(F.lit(BASE_TIME))

    kt = T.StructType([T.StructField("k", T.LongType()), T.StructField("status", T.StringType())])
    reports = per_owner(sorted(REPORT_STATUS.items()), kt).select(
        rid.alias("report_id"),
        F.col("org_id").cast("string").alias("org_id"),
        F.concat(F.lit("Report "), F.col("k").cast("string"), F.lit(" "), F.col("r_name")).alias("name"),
        F.concat(F.lit("definition "), F.col("k").cast("string")).alias("description"),
        "status",
        (base_ts + F.make_dt_interval(F.lit(0), hours)).alias("created_at"),
        (base_ts + F.make_dt_interval(F.lit(60) + F.col("k") % 3)).alias("updated_at"),
        F.when(F.col("status") == "completed", base_ts + F.make_dt_interval(F.lit(1), hours))
        .alias("last_run_date"),
    )

    st = T.StructType([T.StructField("k", T.LongType()), T.StructField("sid", T.LongType())])
    report_sections = per_owner(REPORT_SECTION_ROWS, st).select(
        rid.alias("report_id"), F.col("org_id").cast("string").alias("org_id"),
        F.col("sid").cast("int").alias("section_id"),
    )
    at = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("base", T.LongType()),
    ])
    report_attrs = per_owner(REPORT_ATTRIBUTE_ROWS, at).select(
        rid.alias("report_id"), F.col("org_id").cast("string").alias("org_id"),
        F.col("sid").cast("int").alias("section_id"),
        (F.col("base") + F.col("org_id") * ORG_STRIDE).cast("int").alias("attribute_id"),
    )
    ft = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("base", T.LongType()),
        T.StructField("op", T.StringType()), T.StructField("val", T.StringType()),
    ])
    report_filters = per_owner(REPORT_FILTER_ROWS, ft).select(
        rid.alias("report_id"), F.col("org_id").cast("string").alias("org_id"),
        F.col("sid").cast("string").alias("section_id"),
        (F.col("base") + F.col("org_id") * ORG_STRIDE).cast("string").alias("attribute_id"),
        F.col("op").alias("operator"), F.col("val").alias("value"),
    )
    sot = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("base", T.LongType()),
        T.StructField("dir", T.StringType()), T.StructField("so", T.IntegerType()),
    ])
    report_sorts = per_owner(REPORT_SORT_ROWS, sot).select(
        rid.alias("report_id"), F.col("org_id").cast("string").alias("org_id"),
        F.col("sid").cast("string").alias("section_id"),
        (F.col("base") + F.col("org_id") * ORG_STRIDE).cast("string").alias("attribute_id"),
        F.col("dir").alias("direction"), F.col("so").alias("sort_order"),
    )
    return {
        "reports": reports,
        "report_sections": report_sections,
        "report_section_attributes": report_attrs,
        "report_filters": report_filters,
        "report_sorts": report_sorts,
    }


# Fixed values of the fixture: request bodies (j, target, template): one valid create, one
# valid edit of the org's report 2, one edit of another org's report and one per violation.
# %1$s is the org's region name, %2$d..%5$d the org's attribute ids of bases 101, 102, 201, 203.
REQUEST_TEMPLATES = [
    (1, None, '{"name":"Quarterly %1$s","description":"by segment","config":[{"sectionId":"1","attributeIds":[%2$d,%3$d]},{"sectionId":2,"attributeIds":["%4$d"]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":" in ","value":"BUILDING,MACHINERY"}],"sorts":[{"sectionId":"2","attributeId":"%4$d"}]}'),
    (2, None, '{"description":"no name","config":[{"sectionId":"1","attributeIds":[%2$d]}]}'),
    (3, None, '{"name":"Bad config %1$s","config":{"sectionId":"1"}}'),
    (4, None, '{"name":"Archived %1$s","config":[{"sectionId":"3","attributeIds":[]}]}'),
    (5, None, '{"name":"Foreign %1$s","config":[{"sectionId":"1","attributeIds":[%4$d]}]}'),
    (6, None, '{"name":"Between %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":"%2$d","operator":"BETWEEN","value":"a"}]}'),
    (7, None, '{"name":"Upward %1$s","config":[{"sectionId":"2","attributeIds":[%5$d]}],"sorts":[{"sectionId":"2","attributeId":%5$d,"direction":"UP"}]}'),
    (8, None, '{"name":"Partial %1$s","config":[{"sectionId":"2","attributeIds":[%5$d]}],"filters":[{"sectionId":"2","attributeId":%5$d,"value":"1"}]}'),
    (9, "own", '{"name":"Edited %1$s","config":[{"sectionId":"2","attributeIds":[%5$d,%4$d]}],"filters":[{"sectionId":"2","attributeId":"%4$d","operator":"<>","value":"F"}],"sorts":[{"sectionId":"2","attributeId":"%5$d","direction":"DESC","sortOrder":"2"},{"sectionId":"2","attributeId":"%4$d","sortOrder":1}]}'),
    (10, "other", '{"name":"Not mine %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}]}'),
    (11, None, '{"name":"Loose %1$s","config":[{"attributeIds":[%2$d]}],"filters":"none","sorts":[{"sectionId":"1"}]}'),
    (12, None, '{"name":"Null config %1$s","config":null}'),
    (13, None, '{"name":"Text config %1$s","config":"[abc"}'),
    (14, None, '{"name":"Empty filters %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":{},"sorts":""}'),
    (15, None, '{"name":"Null operator %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":null,"value":"x"}]}'),
    (16, None, '{"name":"Null direction %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"sorts":[{"sectionId":"1","attributeId":%2$d,"direction":null}]}'),
    (17, None, '{"name":"Odd order %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"sorts":[{"sectionId":"1","attributeId":%2$d,"sortOrder":"abc"}]}'),
    (18, None, '{"name":"Null ids %1$s","config":[{"sectionId":null,"attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":null,"operator":"=","value":"x"}]}'),
    (19, None, '{"name":"Padded id %1$s","config":[{"sectionId":"01","attributeIds":[%2$d]}]}'),
    (20, None, '{"name":"Bracket %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":"CONTAINS","value":"[draft"}]}'),
]


def requests(spark: SparkSession, sf_dir: str, growing: bool = True) -> DataFrame:
    """Definition requests ``(request_id, org_id, report_id, body)``; ``report_id`` null = create.

    Each region sends every template once; with ``growing`` each order sends the template ``orderkey % 20 + 1``, which
    edits its customer's report where the template edits its own.
    """
    regions = _regions(spark, sf_dir)
    rt = T.StructType([
        T.StructField("j", T.LongType()), T.StructField("target", T.StringType()), T.StructField("tmpl", T.StringType()),
    ])
    rows = expand(regions, REQUEST_TEMPLATES, rt).select(
        "org_id", "r_name", "j", "target", (F.col("org_id") * 100 + F.col("j")).alias("request_id"), (F.col("org_id") * 100 + 2).alias("own"))
    if growing:
        sent = orders(spark, sf_dir).join(regions, "org_id").withColumn("j", F.col("o_orderkey") % 20 + 1)
        target = functools.reduce(lambda c, t: c.when(F.col("j") == t[0], F.lit(t[1])), REQUEST_TEMPLATES[1:], F.when(F.col("j") == 1, F.lit(None).cast("string")))
        rows = rows.unionByName(sent.select(
            "org_id", "r_name", "j", target.alias("target"), (F.col("o_orderkey") + 1_000_000).alias("request_id"),
            ((F.col("o_custkey") + 1000) * 100 + F.col("o_custkey") % 5 + 1).alias("own")))
    # an order of a few bytes becomes a body of some hundred: rows are dealt out before that, as files of orders have few splits
    return rows.repartition("request_id").select(
        F.col("request_id").cast("long").alias("request_id"),
        "org_id",
        F.when(F.col("target") == "own", F.col("own"))
        .when(F.col("target") == "other", F.pmod(F.col("org_id") + 1, F.lit(5)) * 100 + 2)
        .cast("long").alias("report_id"),
        _format_body().alias("body"),
    )


def _format_body() -> Column:
    # format_string needs a literal pattern, so the per-row template is chosen with CASE.
    args = [F.col("r_name"), attr_id(101), attr_id(102), attr_id(201), attr_id(203)]
    expr = None
    for j, _edit, tmpl in REQUEST_TEMPLATES:
        piece = F.format_string(tmpl, *args)
        expr = F.when(F.col("j") == j, piece) if expr is None else expr.when(F.col("j") == j, piece)
    return expr


# ---------------------------------------------------------------------------
# Tasks (onboarding page) derived from events.
# ---------------------------------------------------------------------------


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per event: purchase→document, signup→profile, others→signature; status by id."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    typ = (
        F.when(F.col("event_type") == "purchase", "document")
        .when(F.col("event_type") == "signup", "profile")
        .otherwise("signature")
    )
    status = (
        F.when(F.col("event_id") % 3 == 0, "pending")
        .when(F.col("event_id") % 3 == 1, "in_progress")
        .otherwise("completed")
    )
    blank_every_5 = F.col("event_id") % 5 == 0
    name_part = F.col("event_id").cast("string")
    fields = F.array(
        F.struct(F.lit("Event").alias("label"), F.col("event_type").alias("value"),
                 F.lit(True).alias("required"), F.lit("Type").alias("placeholder")),
        F.struct(F.lit("Amount").alias("label"),
                 F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(money_text(F.col("value"))).alias("value"),
                 F.lit(None).cast("boolean").alias("required"), F.lit(None).cast("string").alias("placeholder")),
        F.struct(F.lit("Note").alias("label"),
                 F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.col("props")).alias("value"),
                 F.lit(False).alias("required"), F.lit("Note").alias("placeholder")),
        F.struct(F.lit("User").alias("label"), F.col("user_id").cast("string").alias("value"),
                 F.lit(True).alias("required"), F.lit(None).cast("string").alias("placeholder")),
    )
    t = typ
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").alias("provider_id"),
        t.alias("type"),
        status.alias("status"),
        F.col("event_type").alias("title"),
        F.col("props").alias("description"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("dueDate"),
        F.when(t == "signature", "Harbour Desk").otherwise("Quay Office").alias("requestedBy"),
        F.when(t == "profile", F.when(blank_every_5, F.lit("")).otherwise(F.lit("Profile"))).alias("sectionName"),
        F.when(t == "document", F.when(blank_every_5, F.lit("")).otherwise(F.concat(F.lit("doc_"), name_part, F.lit(".pdf")))).alias("documentName"),
        F.when(t == "signature", F.concat(F.lit("form_"), name_part, F.lit(".pdf"))).alias("formName"),
        F.when(t == "profile", fields).alias("fields"),
    )
