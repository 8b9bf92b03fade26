"""A-2 over many days: distinct keys from mergeable sketches that are stored per day.

A day's theta sketch holds the smallest hashes of its keys, ``2**LG`` at least; sketches merge
by union, so a month is gated on its days' sketches alone, however many rows it has. While a
set has fewer keys than a sketch holds, the sketch is exact. Beyond that it tells for certain
only when two sets differ (one has a small hash that the other lacks); what it leaves open, and
the exact counts of sets that differ, are counted again from the rows of those months alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the hashes a sketch holds.
LG = 14


def daily_sketches(df: DataFrame, day: str, keys: Sequence[str], lg: int = LG) -> DataFrame:
    """(day, sketch): what a day's load stores. A NULL key is a key of its own."""
    return df.groupBy(day).agg(F.theta_sketch_agg(F.xxhash64(F.struct(*keys)), lg).alias("sketch"))


def gate_sketches(src: DataFrame, dst: DataFrame, period: Column, lg: int = LG) -> DataFrame:
    """(period, src_cnt, dst_cnt, ok): distinct keys of both sides by ``period`` of the day, from daily
    sketches alone; ``ok`` is NULL, and counts are NULL, where the sketches do not decide."""
    def merged(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(period.alias("period")).agg(F.theta_union_agg("sketch", lg).alias(name))

    both = merged(src, "s").join(merged(dst, "d"), "period", "full")
    size = {c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.theta_sketch_estimate(c)) for c in "sd"}
    # no sample was taken of a set that is smaller than the sketch
    exact = (size["s"] < (1 << lg)) & (size["d"] < (1 << lg))
    differ = (F.col("s").isNull() | F.col("d").isNull()
              | (F.theta_sketch_estimate(F.theta_difference("s", "d")) > 0) | (F.theta_sketch_estimate(F.theta_difference("d", "s")) > 0))
    return both.select("period", *[F.when(exact, size[c].cast("long")).alias(n) for c, n in (("s", "src_cnt"), ("d", "dst_cnt"))],
                       F.when(exact, ~differ).alias("ok"))


def gate_periods(src: DataFrame, dst: DataFrame, src_rows: DataFrame, dst_rows: DataFrame, day: str, period, keys: Sequence[str],
                 lg: int = LG) -> DataFrame:
    """(period, src_cnt, dst_cnt, ok) for every period. ``src`` and ``dst`` are daily sketches, the
    rows behind them are read only for periods that the sketches leave open. ``period`` makes a
    period of a day column."""
    told = gate_sketches(src, dst, period(F.col(day)), lg)
    left = told.where("ok is null").select("period")

    def rows(df: DataFrame, side: int) -> DataFrame:
        # a period or two: Spark broadcasts them if they prove small
        open_ = df.select(period(F.col(day)).alias("period"), F.struct(*keys).alias("k")).join(left, "period", "left_semi")
        return open_.withColumn("side", F.lit(side))

    seen = rows(src_rows, 1).unionByName(rows(dst_rows, 2)).groupBy("period", "k").agg(F.bit_or("side").alias("side"))
    has = lambda bit: F.count_if(F.col("side").bitwiseAND(F.lit(bit)) != 0)
    counted = seen.groupBy("period").agg(has(1).alias("src_cnt"), has(2).alias("dst_cnt"), (F.count_if(F.col("side") != 3) == 0).alias("ok"))
    return told.where("ok is not null").unionByName(counted)
