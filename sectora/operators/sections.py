"""EAV → per-record attribute maps, wide section tables and explicit pivots.

The central table is ``section_records``::

    org_id, section_id, section_name, record_id, provider_id, attrs map<string,string>

built for all tenants and sections in one distributed job. Wide tables and reports are
lazy projections ``attrs['<attribute id>'] AS attr_<id>`` of it, so a new attribute needs
no schema change and no per-section loop.

When a record holds several values for one attribute the smallest non-null value wins
(deterministic; the source's ``first`` depended on row order).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectora.operators.joins import lookup_join
from sectora.operators.records import for_org, for_section, section_context
from sectora.session import scratch_path
from sectora.sources.eav import Eav


def defined_attributes(eav: Eav) -> DataFrame:
    """``(org_id, section_id, attribute_id)`` of attribute definitions with a known org."""
    return eav.attributes.where(F.col("org_id").isNotNull()).select("org_id", "section_id", "attribute_id").distinct()


def reduced_values(values: DataFrame) -> DataFrame:
    """One value per ``(record_id, attribute_id)``: min of the non-null values.

    The aggregation is partial before the shuffle, so repeated values of a hot record are
    combined map-side and a hot record's attributes spread over many reducers.
    """
    return (
        values.where(F.col("value").isNotNull())
        .groupBy("record_id", "attribute_id")
        .agg(F.min("value").alias("value"))
    )


def section_records(eav: Eav, org_id: int | None = None, section_id: int | None = None) -> DataFrame:
    """Fold all values into one attribute map per active record, all sections in one pass.

    Only attributes defined for the record's own (org, section) are kept (the same list the per-section pivot uses);
    records without values get an empty map. Values are summed up per (record, attribute) and gathered per record;
    they never meet the dimensions: each record carries its section's attribute ids, and its map is filtered by them.
    With ``org_id`` or ``section_id`` only those records are read, and only their values folded.
    """
    folded = _folded(eav, section_attributes(eav).withColumnRenamed("attribute_ids", "own"), org_id, section_id)
    kept = F.map_filter("attrs", lambda k, _: F.array_contains("own", k))
    return folded.select("org_id", "section_id", "section_name", "record_id", "provider_id", kept.alias("attrs"))


def _folded(eav: Eav, own: DataFrame, org_id: int | None = None, section_id: int | None = None) -> DataFrame:
    """Context, all values (``attrs``) and the attribute ids of the section as text (``own``) of each active record."""
    ctx = section_context(eav)
    if org_id is not None:
        ctx = for_org(ctx, org_id)
    if section_id is not None:
        ctx = ctx.where(F.col("section_id") == F.lit(int(section_id)).cast("long"))
    values = eav.values if org_id is None and section_id is None else eav.values.join(ctx.select("record_id"), "record_id", "left_semi")
    entry = F.struct(F.col("attribute_id").cast("string").alias("k"), F.col("value").alias("v"))
    maps = reduced_values(values).groupBy("record_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("attrs"))
    ids = own.select("org_id", "section_id", F.transform("own", lambda a: a.cast("string")).alias("own"))
    none = F.array().cast("array<string>")
    joined = lookup_join(ctx, ids, ["org_id", "section_id"], "left", tiebreak=["record_id"]).join(maps, "record_id", "left")
    return joined.withColumns({"own": F.coalesce("own", none), "attrs": F.coalesce("attrs", F.create_map().cast("map<string,string>"))})


# ---------------------------------------------------------------------------
# Attributes as columns of their own
# ---------------------------------------------------------------------------

#: Columns for the attributes of a section; further ones go to a map.
SLOTS = 64


def attribute_slots(eav: Eav, slots: int = SLOTS) -> DataFrame:
    """``org_id, section_id, attribute_id, place``: the attributes of a section by their number of values, most first.

    Places below ``slots`` are columns ``v<place>`` of a :class:`SectionStore`, the others lie in its map.
    """
    counts = eav.values.where(F.col("value").isNotNull()).groupBy("attribute_id").agg(F.count("*").alias("n"))
    order = Window.partitionBy("org_id", "section_id").orderBy(F.desc_nulls_last("n"), "attribute_id")
    return defined_attributes(eav).join(counts, "attribute_id", "left").select(
        "org_id", "section_id", "attribute_id", (F.row_number().over(order) - 1).alias("place")
    )


@dataclass(frozen=True)
class SectionStore:
    """The records of all sections with the frequent attributes of each section in columns ``v0``, ``v1``, ... and the rest in a map.

    All sections share one schema, whatever their attributes; ``slots`` says which attribute a section has in which column. So
    a report reads the Parquet columns of its own attributes only, and its filters reach the scan.
    """

    records: DataFrame  # org_id, section_id (partitions), section_name, record_id, provider_id, v0 ..., rest
    slots: DataFrame  # org_id, section_id, attribute_id, place

    @classmethod
    def write(cls, eav: Eav, path: str | None = None, slots: int = SLOTS) -> SectionStore:
        """Fold all values and write the store: the slot table, then the records in one job, partitioned by org and section."""
        spark = eav.records.sparkSession
        base = path or scratch_path(spark, "section_store")
        attribute_slots(eav, slots).coalesce(1).write.mode("overwrite").parquet(f"{base}/slots")
        placed = spark.read.parquet(f"{base}/slots")
        own = placed.groupBy("org_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("place", "attribute_id"))).alias("own"))
        # as many columns as the largest section needs
        width = min(slots, placed.agg(F.coalesce(F.max("place") + 1, F.lit(0))).first()[0])
        folded = _folded(eav, own.withColumn("own", F.transform("own", lambda x: x["attribute_id"])))
        columns = [F.try_element_at("attrs", F.get("own", F.lit(k))).alias(f"v{k}") for k in range(width)]
        beyond = F.slice("own", slots + 1, F.greatest(F.size("own"), F.lit(1)))
        rest = F.when(F.size("own") > slots, F.map_filter("attrs", lambda k, _: F.array_contains(beyond, k)))
        records = folded.select("org_id", "section_id", "section_name", "record_id", "provider_id", *columns, rest.alias("rest"))
        return cls(snapshot(records, f"{base}/records"), placed)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> SectionStore:
        return cls(spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/slots"))

    def columns(self, org_id: int, wanted: Iterable[tuple[int, int]]) -> dict[tuple[int, int], Column]:
        """The column of each wanted (section, attribute); reads one row of the slot table for each of them.

        An attribute that its section doesn't define has no values.
        """
        wanted = list(dict.fromkeys((int(s), int(a)) for s, a in wanted))
        found = for_org(self.slots, org_id).where(F.col("attribute_id").isin([a for _, a in wanted]))
        places = {(r.section_id, r.attribute_id): r.place for r in found.select("section_id", "attribute_id", "place").collect()}
        out = {}
        for key in wanted:
            place = places.get(key)
            if place is None:
                out[key] = F.lit(None).cast("string")
            else:
                own = f"v{place}"
                out[key] = F.col(own) if own in self.records.columns else F.try_element_at("rest", F.lit(str(key[1])))
        return out

    def as_maps(self) -> DataFrame:
        """``section_records`` put together again from the columns."""
        own = self.slots.groupBy("org_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("place", "attribute_id"))).alias("own"))
        ids = F.transform("own", lambda x: x["attribute_id"].cast("string"))
        joined = lookup_join(self.records, own.withColumn("own", ids), ["org_id", "section_id"], "left", tiebreak=["record_id"])
        width = sum(c[1:].isdigit() for c in self.records.columns if c[0] == "v")
        pairs = F.array(*[F.struct(F.get("own", F.lit(k)).alias("k"), F.col(f"v{k}").alias("v")) for k in range(width)]).cast("array<struct<k:string,v:string>>")
        entries = F.filter(pairs, lambda x: x["k"].isNotNull() & x["v"].isNotNull())
        rest = F.coalesce(F.map_entries("rest"), F.array().cast("array<struct<key:string,value:string>>"))
        every = F.concat(entries, F.transform(rest, lambda x: F.struct(x["key"].alias("k"), x["value"].alias("v"))))
        return joined.select("org_id", "section_id", "section_name", "record_id", "provider_id", F.map_from_entries(F.array_sort(every)).alias("attrs"))


def attr_col(attribute_id: int, prefix: str = "attr_", source: str = "attrs") -> Column:
    """``attrs['<id>'] AS attr_<id>`` (null when the record has no value)."""
    return F.try_element_at(F.col(source), F.lit(str(int(attribute_id)))).alias(f"{prefix}{int(attribute_id)}")


def wide_section(
    records: DataFrame, org_id: int, section_id: int, attribute_ids: Sequence[int], prefix: str = "attr_"
) -> DataFrame:
    """Wide table of one (org, section): ``record_id, provider_id, attr_<id>...`` ascending by id.

    ``attribute_ids`` is the section's attribute list (see ``section_attributes``); attributes
    without any value become all-null columns, a section without attributes keeps the ids only.
    """
    ids = sorted(dict.fromkeys(int(a) for a in attribute_ids))
    return for_section(records, org_id, section_id).select(
        "record_id", "provider_id", *[attr_col(a, prefix) for a in ids]
    )


def section_attributes(eav: Eav) -> DataFrame:
    """Attribute ids per (org, section), ascending: ``org_id, section_id, attribute_ids``.

    Taken from the definitions (not from the values), one job for all sections.
    """
    return (
        defined_attributes(eav)
        .groupBy("org_id", "section_id")
        .agg(F.array_sort(F.collect_set("attribute_id")).alias("attribute_ids"))
    )


def pivot_values(
    values: DataFrame, record_ids: DataFrame, attribute_ids: Sequence[int], prefix: str = "attr_"
) -> DataFrame:
    """Explicit pivot of ``(record_id, attribute_id, value)`` to one column per listed attribute.

    ``record_ids`` (``record_id, provider_id``) is left-joined so records without values stay.
    With an explicit id list Spark needs no extra job to find the pivot values.
    """
    ids = sorted(dict.fromkeys(int(a) for a in attribute_ids))
    if not ids:
        return record_ids.select("record_id", "provider_id")
    pivoted = (
        values.where(F.col("attribute_id").isin(ids))
        .groupBy("record_id")
        .pivot("attribute_id", ids)
        .agg(F.min("value"))
    )
    pivoted = pivoted.select("record_id", *[F.col(str(a)).alias(f"{prefix}{a}") for a in ids])
    return record_ids.select("record_id", "provider_id").join(pivoted, "record_id", "left")


def wide_section_by_pivot(
    eav: Eav, org_id: int, section_id: int, attribute_ids: Sequence[int], prefix: str = "attr_"
) -> DataFrame:
    """The reference-shaped plan for one (org, section): filter records, pivot values, left join."""
    recs = for_section(section_context(eav), org_id, section_id).select("record_id", "provider_id")
    vals = eav.values.join(recs.select("record_id"), "record_id", "left_semi")
    return pivot_values(vals, recs, attribute_ids, prefix)


def records_as_json(records: DataFrame) -> DataFrame:
    """Attribute map as JSON text (keys ascending) for comparisons."""
    return records.select(
        "org_id", "section_id", "section_name", "record_id", "provider_id",
        F.to_json("attrs").alias("attrs_json"), F.size("attrs").alias("n_attrs"),
    )


def snapshot(records: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``section_records`` partitioned by org and section and read it back.

    Reports then read only their (org, section) partitions, and the lineage of the build is
    cut by a table in the shared checkpoint folder (``spark.checkpoint.dir``), so a lost
    executor never forces the whole EAV fold to be recomputed. The rows are rebalanced by
    (org, section): adaptive execution gives a large section as many writers as its size
    asks for and joins small ones, so neither tasks nor files grow out of proportion.
    """
    target = path or scratch_path(records.sparkSession, "section_records")
    (
        records.hint("rebalance", "org_id", "section_id")
        .write.mode("overwrite").partitionBy("org_id", "section_id")
        .option("compression", "snappy").parquet(target)
    )
    return records.sparkSession.read.parquet(target).select(*records.columns)


def hot_providers(records: DataFrame, rows_per_task: int = 2_000_000, path: str | None = None) -> DataFrame:
    """``org_id, provider_id, counts map<section, records>`` of providers whose joined sections exceed ``rows_per_task`` rows.

    Counted once for a snapshot and written: the product over all of a provider's sections bounds every report's.
    """
    per = records.where(F.col("provider_id").isNotNull()).groupBy("org_id", "provider_id", "section_id").agg(F.count("*").alias("n"))
    all_rows = F.aggregate("entries", F.lit(1.0), lambda total, e: total * e["n"])
    hot = (
        per.groupBy("org_id", "provider_id").agg(F.collect_list(F.struct("section_id", "n")).alias("entries"))
        .where(all_rows > rows_per_task).select("org_id", "provider_id", F.map_from_entries("entries").alias("counts"))
    )
    target = path or scratch_path(records.sparkSession, "hot_providers")
    hot.write.mode("overwrite").parquet(target)
    return records.sparkSession.read.schema(hot.schema).parquet(target)
