"""Reseller files as they land: a Structured Streaming file source over the
drop folder, each micro-batch validated with the same rules as the daily batch.

The stream's checkpoint records which files were taken. Each batch overwrites its
own partition (load day and batch), so a batch replayed after a crash between
its writes and its commit replaces its rows: every file counts once. ``availableNow``
processes what has landed and stops, which is how a daily schedule runs it;
a processing-time trigger keeps it running instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxoffice.functions.columns import date_id
from boxoffice.operators import rules
from boxoffice.sources import files
from boxoffice.sources.tables import LOAD_COL


#: Error comment of rows whose file is not named for the run date.
ERR_FILE = "invalid_file_name"


def feed_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming scan of CSV files (header, declared schema) with the feed's
    column names and the file each row came from."""
    raw = (spark.readStream.schema(files.CSV_SCHEMA).option("header", True).option("enforceSchema", False)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(drop_dir))
    cols = [F.col(f"`{f.name}`").alias(n) for f, n in zip(files.CSV_SCHEMA.fields, files.FEED_COLUMNS)]
    name = F.regexp_extract(F.col("_metadata.file_path"), files.SALES_FILE_PATTERN, 0)
    return raw.select(*cols, name.alias("source_file"))


def write_batch(rows: DataFrame, path: str, day: dt.date, batch_id: int) -> None:
    """Write one micro-batch as its own partition, in place of an earlier try."""
    own = f"{path}/{LOAD_COL}={day.isoformat()}/stream_batch={batch_id}"
    rows.drop(LOAD_COL).write.mode("overwrite").parquet(own)


def validate_batch(lookups: Callable[[], tuple[DataFrame, DataFrame]], run_date: Callable[[], dt.date],
                   staging_path: str, errors_path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: rules on the batch, valid rows to the staging
    table, failures to the quarantine table, both for the run date and batch.
    The batch is persisted so the feed is read once for both writes."""
    def run(batch: DataFrame, batch_id: int) -> None:
        day = run_date()
        ev, loc = lookups()
        flags = rules.rule_flags(batch, ev, loc, day).persist()
        # V-4: a file's name must follow the pattern and be of the run date
        dated = F.concat(*[F.regexp_extract("source_file", files.SALES_FILE_PATTERN, i) for i in (1, 2, 3)])
        named = dated == F.lit(day.strftime("%m%d%y"))
        try:
            res_id = F.regexp_extract(F.col("source_file"), files.SALES_FILE_PATTERN, 4).try_cast("bigint")
            valid = rules.valid_rows(flags).filter(named).select(*files.FEED_COLUMNS, res_id.alias("Reseller_id"),
                                                   F.lit(day).alias(LOAD_COL)) \
                .withColumn("BatchId", date_id(LOAD_COL))
            strays = flags.filter(~named).select("transID", F.lit(ERR_FILE).alias("comment"), F.lit("N").alias("reprocessed"),
                                                 F.lit(day).alias("createDt"), F.lit(None).cast("date").alias("updateDt"))
            errors = rules.quarantine(flags.filter(named), day).unionByName(strays)
            for rows, path in ((valid, staging_path), (errors.withColumn(LOAD_COL, F.lit(day)), errors_path)):
                write_batch(rows, path, day, batch_id)
        finally:
            flags.unpersist()
    return run


def start_feed_validation(spark: SparkSession, drop_dir: str, checkpoint: str, staging_path: str,
                          errors_path: str, lookups: Callable[[], tuple[DataFrame, DataFrame]],
                          run_date: Callable[[], dt.date], available_now: bool = True) -> StreamingQuery:
    w = (feed_stream(spark, drop_dir).writeStream
         .foreachBatch(validate_batch(lookups, run_date, staging_path, errors_path))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
