"""Intermediate tables: written in the shared folder and read back, so that a lost
executor costs only the tasks it was running and a plan used twice is computed once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from boxoffice.session import shared_root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own, removed when the session's file system closes."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/boxoffice-scratch/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
