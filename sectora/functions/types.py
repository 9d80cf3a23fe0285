"""Spark type → warehouse column type, and rows made to fit those types."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sectora.functions.text import sanitize_name

# Warehouse column types by Spark type name; anything else is stored as text.
WAREHOUSE_TYPES = {
    "bigint": "BIGINT",
    "long": "BIGINT",
    "int": "INTEGER",
    "integer": "INTEGER",
    "double": "DOUBLE PRECISION",
    "float": "REAL",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}
TEXT_TYPE = "VARCHAR(65535)"
#: The Spark type that holds a warehouse type; decimals have the same name, VARCHAR(n) is text of at most n bytes.
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE PRECISION": "double", "REAL": "float", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def warehouse_type(spark_type: str) -> str:
    t = spark_type.lower()
    if t.startswith("decimal"):
        return spark_type.upper()
    return WAREHOUSE_TYPES.get(t, TEXT_TYPE)


def warehouse_columns(schema: StructType) -> list[tuple[str, str]]:
    """``(sanitised name, warehouse type)`` per field."""
    return [(sanitize_name(f.name), warehouse_type(f.dataType.simpleString())) for f in schema.fields]


def _fitted(name: str, kind: str, nested: bool) -> tuple[Column, Column]:
    """A column cast to a warehouse type, and what is wrong with a value (null if nothing is)."""
    value = F.to_json(f"`{name}`") if nested else F.col(f"`{name}`")
    text = re.fullmatch(r"VARCHAR\((\d+)\)", kind)
    if text:
        value = value.cast("string")
        return value, F.when(F.octet_length(value) > int(text[1]), F.lit(f"longer than {text[1]} bytes"))
    target = SPARK_TYPES.get(kind, kind.lower())
    cast = value.try_cast(target)
    wrong = value.isNotNull() & cast.isNull()
    if target == "float":
        double = value.try_cast("double")
        wrong = wrong | ((F.abs(cast) == float("inf")) & (F.abs(double) != float("inf")))
    return cast, F.when(wrong, F.lit(f"is no {kind}"))


def conform(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with the columns of a typed target and ``_violations array<struct<column, reason, value>>`` of each row.

    Values that don't fit (text that is too long in bytes, numbers that overflow, text that is no number) are null in the
    typed columns and named in ``_violations``. Nested columns become JSON text.
    """
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    typed, found = [], []
    for name, kind in columns:
        value, reason = _fitted(name, kind, name in nested)
        typed.append(F.when(reason.isNull(), value).alias(name))
        shown = F.to_json(f"`{name}`") if name in nested else F.col(f"`{name}`").cast("string")
        found.append(F.when(reason.isNotNull(), F.struct(F.lit(name).alias("column"), reason.alias("reason"), shown.alias("value"))))
    return df.select(*typed, F.filter(F.array(*found), lambda x: x.isNotNull()).alias("_violations"))
