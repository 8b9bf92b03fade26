"""A-4: dense surrogate keys without a single-partition window."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.session import shared_root


def surrogate_key(df: DataFrame, order: Sequence[str], key_col: str = "row_wid",
                  start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Number rows ``start+1, start+2, …`` in ``order`` (which must be unique),
    like ``row_number() OVER (ORDER BY order) + start``.

    1. range-partition on ``order`` and sort inside each partition (AQE sizes
       the ranges from real shuffle bytes; coalescing neighbours keeps order);
    2. write the rows with their partition and place in it as Parquet in the
       shared folder: the layout is fixed for the next step and survives lost
       executors, and only the counts' column is read for the next one;
    3. count rows per partition (one small aggregate, one row per partition
       reaches the driver) and turn the counts into offsets;
    4. a row's key is its partition's offset plus its place.

    The written rows are removed when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/boxoffice-keys/{uuid.uuid4().hex}"
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    pid = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    laid = ranged.sortWithinPartitions(*order).select(pid.alias("_p"), place.alias("_pos"), *[F.col(c) for c in df.columns])
    laid.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    rows = spark.read.schema(laid.schema).parquet(path)
    counts = {r["_p"]: r["count"] for r in rows.groupBy("_p").count().collect()}
    offsets, acc = [], start
    for p in sorted(counts):
        offsets.append((p, acc))
        acc += counts[p]
    # one row per non-empty partition: bounded by the partition count, not the data
    base = F.broadcast(spark.createDataFrame(offsets or [(0, start)], "_p int, _base long"))
    return rows.join(base, "_p").select((F.col("_base") + F.col("_pos") + 1).alias(key_col),
                                        *[F.col(c) for c in df.columns])


def next_key_start(existing: DataFrame | None, key_col: str = "row_wid") -> int:
    """New keys start after the largest key already in the table."""
    if existing is None:
        return 0
    v = existing.agg(F.max(key_col).alias("m")).collect()[0]["m"]
    return int(v) if v is not None else 0
