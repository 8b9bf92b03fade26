"""Relational sources and sinks over JDBC (S-1, S-2, K-2).

Connection settings are passed by the caller; nothing is hard-wired."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.columns import changed_on


def read_jdbc(spark: SparkSession, url: str, table: str, options: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table as a DataFrame. With ``partition_column`` the read is
    split into ``num_partitions`` range queries that run in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def incremental_pull_jdbc(spark: SparkSession, url: str, table: str, day: dt.date,
                          options: dict | None = None, create="CreateDate", update="UpdateDate",
                          **partitioning) -> DataFrame:
    """S-1: rows created or updated on ``day``; the filter is pushed into the
    database query (``PushedFilters`` in the plan)."""
    return read_jdbc(spark, url, table, options, **partitioning).filter(changed_on(day, create, update))


def incremental_count_jdbc(spark: SparkSession, url: str, table: str, day: dt.date,
                           options: dict | None = None, create="CreateDate",
                           update="UpdateDate") -> DataFrame:
    """S-2: count of the same rows, one row ``cnt``, computed by the database."""
    d = "{d '" + day.isoformat() + "'}"          # a date in the escape syntax that every JDBC driver reads
    quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    counted = f"(SELECT COUNT(*) AS cnt FROM {table} WHERE {quoted(create)} = {d} OR {quoted(update)} = {d}) counted"
    return read_jdbc(spark, url, counted, options).select(F.col("cnt").cast("long").alias("cnt"))


def export_jdbc(df: DataFrame, url: str, table: str, options: dict | None = None,
                mode: str = "append", batchsize: int = 10000,
                num_partitions: int = 16) -> None:
    """K-2: append rows to a database table over at most ``num_partitions``
    connections. A task that Spark retries appends its rows again, so the target
    should be a load table without readers, moved on by the database in one
    statement; ``boxoffice.sources.tables.write_staging`` needs no such care."""
    df = df.coalesce(num_partitions)
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batchsize))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()
