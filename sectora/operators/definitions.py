"""Report definitions: intake, requests, validation, upserts, read-back and status.

Definition management is expressed as set-based jobs over a table of requests
``(request_id, org_id, report_id, body)`` (``report_id`` null = create) instead of one
request at a time: bodies are parsed with ``from_json``, flattened with ``posexplode``,
validated with anti joins against the tenant's catalog, and applied to snapshots of the
five definition tables (old child rows of edited reports are replaced).
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.operators.predicates import OPERATORS
from sectora.schemas import REQUEST_BODY
from sectora.sinks import versions

# Accepted sort directions.
DIRECTIONS = ("asc", "desc")


def load_definitions(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Normalise stored definition tables: org, section and attribute ids become long."""
    def ids(df: DataFrame, *extra) -> DataFrame:
        cols = [F.col("report_id").cast("long").alias("report_id"), F.col("org_id").cast("long").alias("org_id")]
        for c in ("section_id", "attribute_id"):
            if c in df.columns:
                cols.append(F.col(c).cast("long").alias(c))
        return df.select(*cols, *extra)

    return {
        "reports": ids(raw["reports"], "name", "description", "status", "created_at", "updated_at", "last_run_date"),
        "report_sections": ids(raw["report_sections"]),
        "report_section_attributes": ids(raw["report_section_attributes"]),
        "report_filters": ids(raw["report_filters"], "operator", "value"),
        "report_sorts": ids(raw["report_sorts"], "direction", F.col("sort_order").cast("int").alias("sort_order")),
    }


def pending_reports(reports: DataFrame) -> DataFrame:
    """Reports awaiting a (re)build: status ``created``."""
    return reports.where(F.col("status") == F.lit("created"))


# ---------------------------------------------------------------------------
# Requests → rows
# ---------------------------------------------------------------------------


def parse_requests(requests: DataFrame) -> DataFrame:
    """Add ``doc`` (the typed body). Ids are parsed as text and cast later."""
    return requests.withColumn("doc", F.from_json("body", REQUEST_BODY))


def flatten_sections(parsed: DataFrame) -> DataFrame:
    """``request_id, org_id, pos, section_id`` (one row per config item)."""
    return parsed.select("request_id", "org_id", F.posexplode("doc.config").alias("pos", "item")).select(
        "request_id", "org_id", F.col("pos").cast("int").alias("pos"),
        F.col("item.sectionId").try_cast("long").alias("section_id"),
    )


def flatten_attributes(parsed: DataFrame) -> DataFrame:
    """``request_id, org_id, pos, attr_pos, section_id, attribute_id``."""
    items = parsed.select("request_id", "org_id", F.posexplode("doc.config").alias("pos", "item"))
    return items.select(
        "request_id", "org_id", "pos", "item.sectionId", F.posexplode("item.attributeIds").alias("attr_pos", "aid")
    ).select(
        "request_id", "org_id", F.col("pos").cast("int").alias("pos"), F.col("attr_pos").cast("int").alias("attr_pos"),
        F.col("sectionId").try_cast("long").alias("section_id"), F.col("aid").try_cast("long").alias("attribute_id"),
    )


def _list_value(v: Column) -> Column:
    """A JSON list sent as a filter value is stored as its items joined with commas; text that isn't one stays."""
    items = F.when(F.trim(v).startswith("[") & F.trim(v).endswith("]"), F.from_json(v, "array<string>"))
    return F.coalesce(F.array_join(items, ","), v)


def flatten_filters(parsed: DataFrame) -> DataFrame:
    """``request_id, org_id, pos, section_id, attribute_id, operator, value`` (value defaults to '')."""
    return parsed.select("request_id", "org_id", F.posexplode("doc.filters").alias("pos", "f")).select(
        "request_id", "org_id", F.col("pos").cast("int").alias("pos"),
        F.col("f.sectionId").try_cast("long").alias("section_id"),
        F.col("f.attributeId").try_cast("long").alias("attribute_id"),
        F.trim(F.col("f.operator")).alias("operator"),
        F.coalesce(_list_value(F.col("f.value")), F.lit("")).alias("value"),
    )


def flatten_sorts(parsed: DataFrame) -> DataFrame:
    """``request_id, org_id, pos, section_id, attribute_id, direction, sort_order`` (asc / 1 by default)."""
    return parsed.select("request_id", "org_id", F.posexplode("doc.sorts").alias("pos", "s")).select(
        "request_id", "org_id", F.col("pos").cast("int").alias("pos"),
        F.col("s.sectionId").try_cast("long").alias("section_id"),
        F.col("s.attributeId").try_cast("long").alias("attribute_id"),
        F.lower(F.coalesce(F.col("s.direction"), F.lit("asc"))).alias("direction"),
        F.coalesce(F.col("s.sortOrder").try_cast("int"), F.lit(1)).alias("sort_order"),
    )


# ---------------------------------------------------------------------------
# Validation: every violation as a row; ``first_error`` picks the one the source reports.
# Order key: stage (0 shape, 1 report exists, 2 config, 3 filters, 4 sorts), item position,
# check within the item, attribute position.
# ---------------------------------------------------------------------------

ERROR_COLUMNS = ["request_id", "org_id", "stage", "pos", "step", "attr_pos", "message"]


#: JSON values that count as nothing where a list may be left out.
NOTHING = ["", "{}", "[]", "0", "0.0", "false", "null"]

#: The lists of a request and the stage that checks their items.
LISTS = {"config": 2, "filters": 3, "sorts": 4}


def _read_requests(requests: DataFrame) -> DataFrame:
    """Parsed requests with, for each list, its JSON type, its text and its items.

    Every body is parsed once for each of these columns: later steps only name them, as an expression that is repeated in
    a generator or a lambda function is evaluated again for each mention.
    """
    typed = parse_requests(requests).withColumn("json", F.try_parse_json("body"))
    members = typed.withColumns(
        {f"{key}_kind": F.schema_of_variant(F.try_variant_get("json", f"$.{key}", "variant")) for key in LISTS}
        | {f"{key}_text": F.get_json_object("body", f"$.{key}") for key in LISTS})
    return members.withColumns({f"{key}_maps": _maps(key) for key in LISTS})


def _is_list(key: str) -> Column:
    """Whether a member's JSON type (``ARRAY<...>``, ``OBJECT<...>``, ``STRING``, ``VOID`` for null ...; null if missing) is a list."""
    return F.coalesce(F.col(f"{key}_kind").startswith("ARRAY"), F.lit(False))


def _is_list_or_missing(key: str) -> Column:
    """``config`` must be a list if it is there at all; ``filters`` and ``sorts`` may also be empty in any way."""
    kind = F.col(f"{key}_kind")
    allowed = kind.isNull() | kind.startswith("ARRAY")
    return allowed if key == "config" else allowed | (kind == "VOID") | F.col(f"{key}_text").isin(NOTHING)


def _shown(c: Column) -> Column:
    """A member in a message; null reads ``None``."""
    return F.coalesce(c, F.lit("None"))


def catalog_sections(catalog: DataFrame) -> DataFrame:
    """``org_id, sid, ids``: the sections of each tenant, as text, with the ids of their attributes."""
    keys = catalog.where(F.col("section_id").isNotNull() & F.col("org_id").isNotNull())
    return keys.groupBy("org_id", F.col("section_id").cast("string").alias("sid")).agg(F.collect_set(F.col("attribute_id").cast("string")).alias("ids"))


#: A piece of a request to check: an item of a list, an attribute of a config item, or the request as a whole.
_ITEM = "struct<stage:int,pos:int,attr_pos:int,sid:string,aid:string,m:map<string,string>,step:int,message:string>"


def _item(stage: int, pos: Column, attr_pos: Column | None = None, sid: Column | None = None, aid: Column | None = None, m: Column | None = None,
          step: int | None = None, message: str | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(stage).alias("stage"), pos.cast("int").alias("pos"), (none if attr_pos is None else attr_pos).cast("int").alias("attr_pos"),
        (none if sid is None else sid).cast("string").alias("sid"), (none if aid is None else aid).cast("string").alias("aid"),
        (none if m is None else m).cast("map<string,string>").alias("m"), F.lit(step).cast("int").alias("step"), F.lit(message).cast("string").alias("message"),
    )


def _maps(key: str) -> Column:
    """Items of a list as raw JSON maps, to tell a missing key from a null value; an item that is no object has no members."""
    texts = F.from_json(F.when(_is_list(key), F.col(f"{key}_text")), "array<string>")
    return F.transform(texts, lambda text: F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>")))


def _list_items(key: str) -> Column:
    """One item for each item of a list."""
    def item(m: Column, pos: Column) -> Column:
        return _item(LISTS[key], pos, sid=m["sectionId"], aid=m["attributeId"], m=m)

    return F.coalesce(F.transform(f"{key}_maps", item), F.array().cast(f"array<{_ITEM}>"))


def _attribute_items() -> Column:
    """One item for each attribute id of a config item that names a section."""
    def of(item: Column, pos: Column) -> Column:
        ids = F.when(item["sectionId"].isNotNull(), item["attributeIds"])
        return F.coalesce(F.transform(ids, lambda a, at: _item(2, pos, at, item["sectionId"], a)), F.array().cast(f"array<{_ITEM}>"))

    return F.coalesce(F.flatten(F.transform("doc.config", of)), F.array().cast(f"array<{_ITEM}>"))


def _shape_items() -> Column:
    """The failed checks of the request as a whole; they bring their message along."""
    checks = [
        (0, F.coalesce(F.col("doc.name"), F.lit("")) == "", "name is required"),
        (1, ~_is_list_or_missing("config"), "config must be a list"),
        (2, ~_is_list_or_missing("filters"), "filters must be a list"),
        (3, ~_is_list_or_missing("sorts"), "sorts must be a list"),
    ]
    return F.filter(F.array(*[F.when(failed, _item(0, F.lit(0), step=step, message=text)) for step, failed, text in checks]), lambda x: x.isNotNull())


def _failed_checks(org: Column) -> Column:
    """``array<struct<step, message>>`` of an item with ``sec_ok`` and ``attr_ok``, by its stage."""
    m, sid, aid, sec_ok, attr_ok = (F.col(c) for c in ("m", "sid", "aid", "sec_ok", "attr_ok"))
    said_sid, said_aid = _shown(sid), _shown(aid)

    def has(*keys: str) -> Column:
        return functools.reduce(operator.and_, [F.map_contains_key(m, k) for k in keys])

    def checks(*steps: tuple[int, Column, Column]) -> Column:
        return F.array(*[F.when(failed, F.struct(F.lit(step).alias("step"), message.alias("message"))) for step, failed, message in steps])

    def of_list(label: str, keys: tuple[str, ...], missing: str, *more: tuple[Column, Column]) -> Column:
        return checks(
            (0, ~has(*keys), F.lit(missing)),
            (1, has(*keys) & ~sec_ok, F.concat(F.lit(f"Invalid {label} sectionId for org_id "), org, F.lit(": "), said_sid)),
            (2, has(*keys) & ~attr_ok,
             F.concat(F.lit(f"Invalid {label} attributeId "), said_aid, F.lit(" for sectionId "), said_sid, F.lit(" and org_id "), org)),
            *[(3 + k, has(*keys) & failed, message) for k, (failed, message) in enumerate(more)],
        )

    op = F.trim(_shown(m["operator"]))
    # a member that is there with null isn't left out
    direction = F.when(has("direction"), F.lower(_shown(m["direction"]))).otherwise("asc")
    order = m["sortOrder"]
    # The messages of the source system.
    of_attribute = checks(
        (2, ~attr_ok, F.concat(F.lit("Invalid attributeId "), said_aid, F.lit(" for sectionId "), sid, F.lit(" and org_id "), org)))
    of_config = checks(
        (0, ~has("sectionId"), F.lit("sectionId is required in each config item")),
        (1, has("sectionId") & ~sec_ok, F.concat(F.lit("Invalid sectionId for org_id "), org, F.lit(": "), said_sid)))
    of_filter = of_list(
        "filter", ("sectionId", "attributeId", "operator"), "Each filter must contain sectionId, attributeId, and operator",
        (~F.upper(op).isin(list(OPERATORS)), F.concat(F.lit("Invalid filter operator: "), op)))
    of_sort = of_list(
        "sort", ("sectionId", "attributeId"), "Each sort must contain sectionId and attributeId",
        (~direction.isin(list(DIRECTIONS)), F.concat(F.lit("Invalid sort direction: "), direction)),
        (has("sortOrder") & order.try_cast("int").isNull(), F.concat(F.lit("Invalid sort order: "), _shown(order))))
    stage = F.col("stage")
    every = (
        F.when(stage == 0, F.array(F.struct("step", "message"))).when(F.col("attr_pos").isNotNull(), of_attribute)
        .when(stage == 2, of_config).when(stage == 3, of_filter).otherwise(of_sort)
    )
    return F.filter(every, lambda x: x.isNotNull())


def validate_definitions(requests: DataFrame, catalog: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """All violations of a batch of requests: ``request_id, org_id, stage, pos, step, attr_pos, message``.

    Everything there is to check in a request becomes one stream of tagged items: its failed shape checks, the items of its
    three lists and the attributes of its config. The stream is joined once to the tenants' sections, each with its
    attribute ids, and the checks of each item follow in one projection. Items without a section are dealt out by request.
    """
    org = F.col("org_id").cast("string")
    items = F.concat(_shape_items(), _list_items("config"), _attribute_items(), _list_items("filters"), _list_items("sorts"))
    stream = _read_requests(requests).select("request_id", "org_id", F.explode(items).alias("x")).select("request_id", "org_id", "x.*")
    # ids are compared as text: 01 is not 1; a section id can't begin with a blank
    stream = stream.withColumn("key", F.coalesce("sid", F.concat(F.lit(" "), F.col("request_id").cast("string"))))
    known = catalog_sections(catalog).withColumnRenamed("sid", "key")
    checked = stream.join(known, ["org_id", "key"], "left").withColumns({
        "sec_ok": F.col("ids").isNotNull(), "attr_ok": F.coalesce(F.array_contains("ids", F.col("aid")), F.lit(False)),
    })
    errors = checked.select("request_id", "org_id", "stage", "pos", F.coalesce("attr_pos", F.lit(0)).alias("attr_pos"), F.explode(_failed_checks(org)).alias("e"))
    errors = errors.select("request_id", "org_id", "stage", "pos", "e.step", "attr_pos", "e.message")
    if reports is None:
        return errors
    edits = requests.where(F.col("report_id").isNotNull()).select("request_id", "org_id", "report_id")
    missing = edits.join(reports.select("report_id", "org_id"), ["report_id", "org_id"], "left_anti")
    text = F.concat(F.lit("Report "), F.col("report_id").cast("string"), F.lit(" not found for org_id "), org)
    zero = F.lit(0)
    return errors.unionByName(missing.select(
        "request_id", "org_id", F.lit(1).alias("stage"), zero.alias("pos"), zero.alias("step"), zero.alias("attr_pos"), text.alias("message")))


def first_error(errors: DataFrame) -> DataFrame:
    """Per request, the violation the source system raises first: ``request_id, org_id, message``."""
    return errors.groupBy("request_id", "org_id").agg(
        F.min_by("message", F.struct("stage", "pos", "step", "attr_pos")).alias("message")
    )


# ---------------------------------------------------------------------------
# Apply valid requests to the definition snapshots
# ---------------------------------------------------------------------------


def allocate_ids(requests: DataFrame, reports: DataFrame, now: Column, bits: int = 63) -> DataFrame:
    """``request_id, org_id, report_id``: a new id for each request that creates a report, unique and unlike any stored one.

    An id is a hash of organisation, request, time and round below 2^``bits``. Of the requests that get one id the smallest keeps it,
    unless it is stored already; the others are hashed again until none is left. The same input gives the same ids.
    """
    left = requests.where(F.col("report_id").isNull()).select("request_id", "org_id").distinct().checkpoint()
    taken, done, again = reports.select("report_id").distinct(), [], 0
    while not left.isEmpty():
        hashed = left.withColumn("report_id", F.pmod(F.xxhash64("org_id", "request_id", now, F.lit(again)), F.lit(2**bits - 1)) + 1)
        won = hashed.groupBy("report_id").agg(F.min(F.struct("org_id", "request_id")).alias("w")).join(taken, "report_id", "left_anti")
        won = won.select("w.request_id", "w.org_id", "report_id").checkpoint()
        done.append(won)
        taken = taken.unionByName(won.select("report_id"))
        left = left.join(won, ["request_id", "org_id"], "left_anti").checkpoint()
        again += 1
    return functools.reduce(DataFrame.unionByName, done) if done else left.withColumn("report_id", F.lit(None).cast("long"))


def save_definitions(
    spark: SparkSession, base: str, requests: DataFrame, catalog: DataFrame, now: Column, new_id: Column | None = None
) -> tuple[versions.Version, DataFrame]:
    """Validate a batch of requests and apply the valid ones to the definition tables under ``base``, all five in one commit.

    Returns the new version and each refused request's first error. A failure before the commit leaves the old version; another writer's
    commit in between raises ``versions.Conflict``, and the batch can be applied again to the version it finds then.
    """
    before = versions.current(spark, base)
    state = versions.read(spark, base, before)
    errors = validate_definitions(requests, catalog, state["reports"]).checkpoint()
    after = apply_definitions(state, requests, errors, now, new_id)
    staged = {name: versions.stage(df, base, name) for name, df in after.items()}
    return versions.commit(spark, base, before, staged), first_error(errors)


def apply_definitions(
    state: dict[str, DataFrame],
    requests: DataFrame,
    errors: DataFrame,
    now: Column,
    new_id: Column | None = None,
) -> dict[str, DataFrame]:
    """New snapshots of the five tables after applying the batch's valid requests.

    Creates get ``new_id`` (default: ``allocate_ids``) and status ``created``;
    edits replace name, description, status (``created``) and ``updated_at`` of their report and
    all its child rows. When several requests of a batch edit one report the latest request wins.
    """
    valid = requests.join(errors.select("request_id").distinct(), "request_id", "left_anti")
    if new_id is None:
        ids = allocate_ids(valid, state["reports"], now).withColumnRenamed("report_id", "_new")
        valid = valid.join(ids, ["request_id", "org_id"], "left")
        new_id = F.col("_new")
    valid = valid.withColumn("target_id", F.coalesce(F.col("report_id"), new_id)).drop("_new")
    latest = valid.groupBy("target_id", "org_id").agg(F.max("request_id").alias("request_id"))
    # The valid batch feeds five outputs: checkpoint it (reliably, in spark.checkpoint.dir) so
    # validation runs once and a lost executor does not replay it.
    valid = parse_requests(valid.join(latest, ["target_id", "org_id", "request_id"], "left_semi")).checkpoint()

    old = state["reports"]
    touched = valid.select(F.col("target_id").alias("report_id"), "org_id")
    prev = old.join(touched, ["report_id", "org_id"], "inner").select(
        "report_id", "org_id", F.col("created_at").alias("_created"), F.col("last_run_date").alias("_last")
    )
    upserted = (
        valid.select(F.col("target_id").alias("report_id"), "org_id", F.col("doc.name").alias("name"),
                     F.coalesce(F.col("doc.description"), F.lit("")).alias("description"))
        .join(prev, ["report_id", "org_id"], "left")
        .select(
            "report_id", "org_id", "name", "description", F.lit("created").alias("status"),
            F.coalesce(F.col("_created"), now).alias("created_at"), now.alias("updated_at"),
            F.col("_last").alias("last_run_date"),
        )
    )
    reports = old.join(touched, ["report_id", "org_id"], "left_anti").unionByName(upserted.select(*old.columns))

    def children(name: str, rows: DataFrame, cols: list[str]) -> DataFrame:
        rows = rows.join(valid.select("request_id", F.col("target_id").alias("report_id")), "request_id")
        kept = state[name].join(touched, ["report_id", "org_id"], "left_anti")
        return kept.unionByName(rows.select("report_id", "org_id", *cols).select(*state[name].columns))

    return {
        "reports": reports,
        "report_sections": children("report_sections", flatten_sections(valid), ["section_id"]),
        "report_section_attributes": children(
            "report_section_attributes", flatten_attributes(valid), ["section_id", "attribute_id"]),
        "report_filters": children(
            "report_filters", flatten_filters(valid), ["section_id", "attribute_id", "operator", "value"]),
        "report_sorts": children(
            "report_sorts", flatten_sorts(valid), ["section_id", "attribute_id", "direction", "sort_order"]),
    }


# ---------------------------------------------------------------------------
# Read-back and status
# ---------------------------------------------------------------------------


def definition_config(state: dict[str, DataFrame]) -> DataFrame:
    """Sections of each report left-joined with their attributes on (report, org, section)."""
    return state["report_sections"].join(
        state["report_section_attributes"], ["report_id", "org_id", "section_id"], "left"
    ).select("report_id", "org_id", "section_id", "attribute_id")


def nest_config(state: dict[str, DataFrame]) -> DataFrame:
    """``report_id, org_id, config`` with config = [{sectionId, attributeIds[]}] in numeric order;
    a section without attributes has an empty list."""
    per_section = definition_config(state).groupBy("report_id", "org_id", "section_id").agg(
        F.array_sort(F.collect_list("attribute_id")).alias("ids")
    )
    return per_section.groupBy("report_id", "org_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("section_id", "ids"))),
            lambda x: F.struct(x["section_id"].cast("string").alias("sectionId"),
                               F.transform(x["ids"], lambda a: a.cast("string")).alias("attributeIds")),
        ).alias("config")
    )


def nest_filters(state: dict[str, DataFrame]) -> DataFrame:
    """``report_id, org_id, filters`` ordered by section then attribute id as text."""
    f = state["report_filters"].select(
        "report_id", "org_id",
        F.struct(
            F.col("section_id").cast("string").alias("sectionId"), F.col("attribute_id").cast("string").alias("attributeId"),
            "operator", "value",
        ).alias("f"),
    )
    return f.groupBy("report_id", "org_id").agg(F.array_sort(F.collect_list("f")).alias("filters"))


def nest_sorts(state: dict[str, DataFrame]) -> DataFrame:
    """``report_id, org_id, sorts`` ordered by sort order, then section and attribute id as text."""
    s = state["report_sorts"].select(
        "report_id", "org_id",
        F.struct(
            F.col("sort_order").alias("k"), F.col("section_id").cast("string").alias("sectionId"),
            F.col("attribute_id").cast("string").alias("attributeId"), "direction",
            F.col("sort_order").alias("sortOrder"),
        ).alias("s"),
    )
    return s.groupBy("report_id", "org_id").agg(
        F.transform(F.array_sort(F.collect_list("s")), lambda x: x.dropFields("k")).alias("sorts")
    )


def get_definition(state: dict[str, DataFrame], org_id: int | None = None) -> DataFrame:
    """One nested definition document per report (optionally of one org)."""
    reports = state["reports"]
    if org_id is not None:
        reports = reports.where(F.col("org_id") == F.lit(int(org_id)))
    empty = F.array().cast
    doc = (
        reports.join(nest_config(state), ["report_id", "org_id"], "left")
        .join(nest_filters(state), ["report_id", "org_id"], "left")
        .join(nest_sorts(state), ["report_id", "org_id"], "left")
    )
    return doc.select(
        "report_id", "org_id", "name", "description", "status", "created_at", "updated_at",
        F.coalesce("config", empty("array<struct<sectionId:string,attributeIds:array<string>>>")).alias("config"),
        F.coalesce("filters", empty(
            "array<struct<sectionId:string,attributeId:string,operator:string,value:string>>")).alias("filters"),
        F.coalesce("sorts", empty(
            "array<struct<sectionId:string,attributeId:string,direction:string,sortOrder:int>>")).alias("sorts"),
    )


def set_status(reports: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Apply ``changes(report_id, org_id, status)``: ``updated_at = now``; ``last_run_date = now``
    only for ``completed``."""
    ch = changes.select("report_id", "org_id", F.col("status").alias("_new"))
    j = reports.join(ch, ["report_id", "org_id"], "left")
    changed = F.col("_new").isNotNull()
    return j.select(
        "report_id", "org_id", "name", "description",
        F.coalesce("_new", "status").alias("status"), "created_at",
        F.when(changed, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("_new") == "completed", now).otherwise(F.col("last_run_date")).alias("last_run_date"),
    )


def existing_targets(requests: DataFrame, reports: DataFrame) -> DataFrame:
    """Edit requests whose report exists for the requesting org: ``request_id, org_id, report_id``."""
    return requests.where(F.col("report_id").isNotNull()).join(
        reports.select("report_id", "org_id"), ["report_id", "org_id"], "left_semi"
    ).select("request_id", "org_id", "report_id")
