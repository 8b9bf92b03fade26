"""Lookup joins: role-playing date keys, one row per lookup key, NULL keys kept
from meeting in one task. No side is broadcast by hint: AQE broadcasts a side
whose shuffled size proves small and splits skewed ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Reduce a lookup to one row per key (greatest ``values``), so a LEFT join
    to it can never multiply the probing rows."""
    packed = F.struct(*[F.col(v).alias(v) for v in values])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def date_role(df: DataFrame, calendar: DataFrame, date_col: str, out_col: str,
              how: str = "left") -> DataFrame:
    """J-1: look up the calendar id of ``date_col`` under the role name
    ``out_col``. ``calendar`` is (date_dim_id, date_actual)."""
    tag = f"_cal_{out_col}"
    cal = calendar.select(F.col("date_actual").alias(tag), F.col("date_dim_id").alias(out_col))
    return df.join(cal, df[date_col] == cal[tag], how).drop(tag)


#: Tasks that rows with a NULL lookup key are spread over.
NULL_SPREAD = 1024


def left_lookup(df: DataFrame, lookup: DataFrame, pairs: Sequence[tuple[str, str]], spread_by: str) -> DataFrame:
    """LEFT join on equal ``pairs`` of columns in which rows with a NULL key, which
    can match nothing, are dealt by a hash of ``spread_by`` and not to one task."""
    null_key = F.lit(False)
    for a, _ in pairs:
        null_key = null_key | F.col(a).isNull()
    salt = F.when(null_key, 1 + F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD))).otherwise(F.lit(0).cast("bigint"))
    left, right = df.withColumn("_null_salt", salt), lookup.withColumn("_no_salt", F.lit(0).cast("bigint"))
    cond = F.col("_null_salt") == F.col("_no_salt")
    for a, b in pairs:
        # a filler keeps NULL keys in the hash; their salt lets them match nothing
        kind = dict(df.dtypes)[a]
        filler = F.lit("") if kind == "string" else F.lit(0).cast(kind)
        cond = cond & (F.coalesce(F.col(a), filler) == F.col(b))
    return left.join(right, cond, "left").drop("_null_salt", "_no_salt")
