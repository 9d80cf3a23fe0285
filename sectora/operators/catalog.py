"""Attribute catalog: options per attribute, the attribute/section table and its documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.operators.records import active_sections, for_org
from sectora.sources.eav import Eav

# The columns of the catalog table.
CATALOG_COLUMNS = ["attribute_id", "section_id", "attribute_name", "section_name", "org_id", "attribute_type", "attribute_options"]


def attribute_options(options: DataFrame) -> DataFrame:
    """``attribute_id, attribute_options array<string>``: an attribute's options in order, repeats kept, nulls dropped."""
    return options.groupBy("attribute_id").agg(F.array_sort(F.collect_list("attribute_option_value")).alias("attribute_options"))


def options_as_text(df: DataFrame) -> DataFrame:
    """The option array rendered for a text target: comma-separated, null stays null."""
    return df.withColumn("attribute_options", F.array_join("attribute_options", ","))


def attribute_catalog(eav: Eav) -> DataFrame:
    """One row for each attribute of an active section, with its option array (null without options)."""
    named = active_sections(eav.sections).selectExpr("section_id", "section_name")
    described = eav.attributes.join(attribute_options(eav.options), on="attribute_id", how="left").join(named, on="section_id")
    return described.selectExpr(*CATALOG_COLUMNS)


def attribute_entry() -> F.Column:
    return F.struct(
        F.col("attribute_id").alias("attributeId"),
        F.col("attribute_name").alias("name"),
        F.col("attribute_type").alias("attributeType"),
        F.col("attribute_options").alias("attributeOptions"),
    )


def catalog_documents(catalog: DataFrame, org_id: int | None = None) -> DataFrame:
    """One document per (org, section): ``org_id, section_id, section_name, attributes`` with the
    attributes ordered by id. Rows without a section are skipped."""
    df = catalog if org_id is None else for_org(catalog, org_id)
    return (
        df.where(F.col("section_id").isNotNull())
        .groupBy("org_id", "section_id", "section_name")
        .agg(F.array_sort(F.collect_list(attribute_entry())).alias("attributes"))
    )


def ordered_catalog(catalog: DataFrame, org_id: int) -> DataFrame:
    """A tenant's catalog rows ordered by section then attribute."""
    return for_org(catalog, org_id).select(
        "section_id", "section_name", "attribute_id", "attribute_name", "attribute_type", "attribute_options"
    ).orderBy("section_id", "attribute_id")


def catalog_keys_table(eav: Eav) -> DataFrame:
    """``org_id, section_id, attribute_id`` of the catalog (what validation needs; no options)."""
    sections = active_sections(eav.sections).select("section_id")
    return eav.attributes.join(sections, "section_id", "inner").select("org_id", "section_id", "attribute_id")
