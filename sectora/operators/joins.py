"""Skew-safe equi-joins.

A hot key (one provider holding a large share of the rows) would put all of its rows, and all of its join output,
into one task. ``skew_join`` spreads the rows of keys with more than ``rows_per_task`` rows on either side: the left
side's over ``ceil(n_left / rows_per_task)`` buckets, the right side's over ``ceil(n_right / rows_per_task)``, and
each side is repeated once for every bucket of the other, so every pair of buckets meets in a task of its own. Other
keys have bucket (0, 0). The number of buckets follows the counts alone, and the plan has one shape whatever they are.

The hot-key table has at most ``rows / rows_per_task`` rows a side. It is joined without a hint: a written one is
broadcast when its size allows.

In a left join of a key whose right rows lie in several buckets, a left row may find nothing in some of them. Such
rows carry a flag that their key has right rows, and are dropped where unmatched; no second pass over the left
side is needed.

Rows whose key is null match nothing. On the right they are dropped; on the left of a left join they are spread over
``NULL_BUCKETS`` buckets, as one key would take them all to one task.

``lookup_join`` joins facts to a dimension with one row for each key. A dimension under the broadcast threshold is left to Spark,
which then moves no fact. Beyond it, keys of many facts are salted: their facts spread over as many salts as their
count asks for, and the dimension's row is repeated for each.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


NULL_BUCKETS = 4096


def hot_key_table(left: DataFrame, right: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``<key>, n_left, n_right`` of keys with more than ``rows_per_task`` rows on either side: one aggregation over both
    sides' key columns, with partial counts before its shuffle."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    counts = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    return counts.where(F.greatest("n_left", "n_right") > rows_per_task)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    hot: DataFrame | None = None,
    rows_per_task: int = 2_000_000,
    left_tiebreak: Sequence[str] | None = None,
    right_tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join on ``key`` (same name on both sides) that splits hot keys; ``how`` is inner or left. Lazy.

    ``hot`` is a table like ``hot_key_table``'s with the exact counts of its keys (more keys than needed are
    fine); without it the counts become part of the plan. ``*_tiebreak`` name columns that make rows of a key
    distinct (e.g. ``record_id``); their hash picks a row's bucket, so the split is deterministic and survives retries.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    if key not in left.columns or key not in right.columns:
        raise ValueError(f"join key {key!r} must exist on both sides")
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    hot = hot_key_table(left, right, key, rows_per_task) if hot is None else hot

    def buckets(n: str) -> F.Column:
        return F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(rows_per_task))).cast("int")

    hot = hot.select(F.col(key).alias("_hk"), buckets("n_left").alias("_sl"), buckets("n_right").alias("_sr"))

    def spread(df: DataFrame, own: str, other: str, tiebreak: Sequence[str] | None, own_col: str, other_col: str) -> DataFrame:
        cols = list(tiebreak) if tiebreak else [c for c in df.columns if c != key]
        nulls = F.when(F.col(key).isNull(), F.lit(NULL_BUCKETS))
        n_own, n_other = F.coalesce(nulls, F.col(own), F.lit(1)), F.coalesce(F.col(other), F.lit(1))
        return df.join(hot, df[key] == F.col("_hk"), "left").select(
            *df.columns,
            F.pmod(F.xxhash64(*[F.col(c) for c in cols]), n_own).cast("int").alias(own_col),
            F.explode(F.sequence(F.lit(0), n_other - 1)).alias(other_col),
            (n_other > 1).alias(f"_several{own_col}"),
        )

    lt = spread(left if how == "left" else left.where(F.col(key).isNotNull()), "_sl", "_sr", left_tiebreak, "_bl", "_br")
    rt = spread(right.where(F.col(key).isNotNull()), "_sr", "_sl", right_tiebreak, "_br", "_bl").drop("_several_br").withColumn("_hit", F.lit(True))
    joined = lt.join(rt, [key, "_bl", "_br"], how)
    if how == "left":
        joined = joined.where(F.col("_hit").isNotNull() | ~F.col("_several_bl"))
    return joined.select(*left.columns, *[c for c in right.columns if c != key])


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's size estimate of ``df`` is under the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def lookup_join(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner", *, tiebreak: Sequence[str], rows_per_task: int = 2_000_000
) -> DataFrame:
    """Join ``dimension`` (at most one row for each key) to ``facts``; ``how`` is inner or left. Lazy.

    The table of hot keys holds at most ``facts / rows_per_task`` rows of a few numbers; it is broadcast, so that facts
    get their salts where they are. ``tiebreak`` names columns that make the facts of a key distinct.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    keys = list(keys)
    if broadcastable(dimension):
        return facts.join(dimension, keys, how)
    some = functools.reduce(operator.and_, [F.col(k).isNotNull() for k in keys])
    hot = facts.where(some).groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(rows_per_task)).cast("int").alias("_salts")).where("_salts > 1")
    # facts without a key match nothing and are only dealt out
    salts = F.when(some, F.coalesce("_salts", F.lit(1))).otherwise(F.lit(NULL_BUCKETS))
    salted = facts.where(some) if how == "inner" else facts
    salted = salted.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*tiebreak), salts).cast("int")).drop("_salts")
    repeated = dimension.where(some).join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
