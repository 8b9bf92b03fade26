"""J-4/J-8: joins whose left side may hold a large share of its rows on few keys.

One pass over the key finds its heavy hitters (Misra-Gries counters, which Spark keeps
as a frequent-items sketch: a bounded number of counters in each task, merged by adding
them up; a key beyond the asked share is always among them). The rows of a hot key are then
dealt over many pieces, and the other side's rows of that key are copied to each piece;
all other keys join as ever. NULL keys, which match nothing, are dealt likewise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces that a task's fair share of rows is cut into; more pieces even out which task gets them.
PIECES = 16
#: Counters of the sketch; a count is off by less than 3.5 in so many rows.
COUNTERS = 8192


def _hash(df: DataFrame, cols: Sequence[str], types: Sequence[str]) -> Column:
    """Hash of a key that is the same on both sides; NULL if a column is."""
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.xxhash64(*[F.col(c).cast(t) for c, t in zip(cols, types)]))


def heavy_keys(df: DataFrame, cols: Sequence[str], tasks: int, types: Sequence[str] | None = None) -> DataFrame:
    """(_hot, _pieces): hashes of the keys with more rows than half a task's fair share of ``df``, and
    how many pieces each is cut into. At most 4 x ``tasks`` rows."""
    types = types or [dict(df.dtypes)[c] for c in cols]
    k = max(1, min(4 * tasks, COUNTERS // 4))
    counted = df.select(_hash(df, cols, types).alias("h")).where("h is not null") \
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {k}, {COUNTERS})").alias("top"))
    hot = counted.select("n", F.explode("top").alias("t")).where(F.col("t.count") * 2 * tasks >= F.col("n"))
    return hot.select(F.col("t.item").alias("_hot"), F.ceil(F.col("t.count") * (PIECES * tasks) / F.col("n")).cast("int").alias("_pieces"))


def spread_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner",
                measured: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """INNER or LEFT join on equal ``pairs`` of columns with hot keys of ``left`` cut into pieces. The keys
    are counted on ``measured`` (``left``, or a table it was made from that is cheaper to read)."""
    if how not in ("inner", "left"):
        raise ValueError(f"no {how} join")
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    types = [dict(right.dtypes)[c] for c in b]
    # a bounded number of rows, however large the sides are
    heavy = F.broadcast(heavy_keys(left if measured is None else measured, a, tasks, types))
    lefts, rights = left.columns, right.columns
    row = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in lefts])
    lh = left.withColumn("_h", _hash(left, a, types)).join(heavy, F.col("_h") == F.col("_hot"), "left")
    pieces = F.when(F.col("_h").isNull(), F.lit(PIECES * tasks)).otherwise(F.coalesce("_pieces", F.lit(1)))
    lh = lh.withColumn("_piece", F.pmod(row, pieces.cast("long")).cast("int")).drop("_h", "_hot", "_pieces")
    rh = right.withColumn("_rh", _hash(right, b, types)).join(heavy, F.col("_rh") == F.col("_hot"), "left")
    rh = rh.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_rh", "_hot", "_pieces")
    cond = F.col("_piece") == F.col("_copy")
    for x, y in pairs:
        cond = cond & (lh[x] == rh[y])
    return lh.join(rh, cond, how).select(*[lh[c] for c in lefts], *[rh[c] for c in rights])
