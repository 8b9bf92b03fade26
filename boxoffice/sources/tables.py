"""Staging and warehouse tables on Parquet (S-5, S-6, K-1, K-2, K-8)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boxoffice.operators.changes import latest_per_key
from boxoffice.session import setting

LOAD_COL = "load_date"


def change_versions(src: DataFrame, create="CreateDate", update="UpdateDate") -> DataFrame:
    """What daily change pulls of a source table append to staging, derived from
    its current state: the row as created (update still NULL) on its create
    day, and the row as updated on its update day. One pass: each row becomes
    one or two versions through ``explode``, with ``load_date`` set."""
    versions = F.array(
        F.struct(F.lit(None).cast("date").alias("u"), F.col(create).alias("d")),
        F.struct(F.col(update).cast("date").alias("u"), F.col(update).cast("date").alias("d")),
    )
    keep = F.filter(versions, lambda v: v["d"].isNotNull())
    cols = [c for c in src.columns]
    out = src.select(*cols, F.explode(keep).alias("_v"))
    return out.select(*[F.col("_v.u").alias(c) if c == update else F.col(c) for c in cols],
                      F.col("_v.d").alias(LOAD_COL))


#: Pieces that values are dealt over before Spark puts small ones together. A piece that is too
#: large for a task is split, each split having rows of all its values, so pieces are many:
#: the files written grow with the values, not with values times splits.
VALUE_PIECES = 1024


def by_partition_value(df: DataFrame, partition_col: str) -> DataFrame:
    """Lay rows out for a write partitioned by ``partition_col``. Spark sizes the
    writing tasks from the bytes that were really shuffled, never from an estimate
    (a join's is the product of its sides): small values share a task and a value
    that holds a large share of the rows is split over several."""
    return df.hint("rebalance", VALUE_PIECES, F.col(partition_col))


def writers_per_core(spark: SparkSession):
    """Small writes of many folders take as long as their files take to create, not
    as their bytes: within this block Spark keeps a task a core for them."""
    return setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")


def drop_partition(spark: SparkSession, path: str, partition_col: str, value) -> None:
    """Remove one partition folder, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={value}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder) and not fs.delete(folder, True):
        raise OSError(f"could not remove {folder}")


def write_staging(df: DataFrame, path: str, partition_col: str = LOAD_COL, day: dt.date | None = None) -> None:
    """K-1: append a load to a staging table partitioned by load date. Dynamic
    partition overwrite replaces only the days present in ``df``, so rerunning
    a day replaces it instead of duplicating it. With ``day``, the one day that
    ``df`` is for, its old rows also go if ``df`` is empty."""
    if day is not None and df.isEmpty():
        drop_partition(df.sparkSession, path, partition_col, day.isoformat())
    with writers_per_core(df.sparkSession):
        (by_partition_value(df, partition_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col)
         .parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged_window(staged: DataFrame, day: dt.date | None, create="CreateDate",
                  update="UpdateDate") -> DataFrame:
    """S-5: staged rows created or updated on ``day``. The ``load_date``
    predicate prunes partitions; the change predicate is kept as written. With
    ``day=None`` every staged day is taken (a backfill)."""
    if day is None:
        return staged
    return staged.filter((F.col(LOAD_COL) == F.lit(day))
                         & ((F.col(create) == F.lit(day)) | (F.col(update) == F.lit(day))))


def current_lookup(staged: DataFrame, keys: Sequence[str], create="CreateDate",
                   update="UpdateDate") -> DataFrame:
    """S-6: the current version of every key in an append-only staging table."""
    return latest_per_key(staged.drop(LOAD_COL), keys, [update, create])


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType, path: str,
                           partition_cols: Sequence[str] = ()) -> None:
    """K-8: ``CREATE TABLE IF NOT EXISTS`` from a declared schema."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{path}'")
