"""File sources: reseller CSV and XML drops, the ``&``-delimited weblog
(S-3, S-4, S-10, P-3, P-5), and their writers for round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

from boxoffice.sources.xmlrows import xml_rows
from boxoffice.workspace import few_listing_tasks

# Header layout of a reseller's daily sales file (fixed by the feed format).
# Office Location holds a location name, so it is text (the reference declared
# it integer but compared it with names).
CSV_SCHEMA = StructType([
    StructField("Transaction ID", LongType(), False),
    StructField("Event name", StringType(), False),
    StructField("Number of purchased tickets", IntegerType(), False),
    StructField("Total amount", DoubleType(), True),
    StructField("Sales channel(office,web,mobile web)", StringType(), False),
    StructField("Customer first name", StringType(), False),
    StructField("Customer last name", StringType(), True),
    StructField("Office Location", StringType(), True),
    StructField("Created_date", DateType(), False),
])
# Names given to the nine columns after the scan (P-3), fixed by the staging format.
FEED_COLUMNS = ["transID", "eventName", "Purchased_ticket", "Amount", "channel",
                "custFirstName", "custLastName", "officeLoc", "createDate"]

# Nested layout of a reseller's XML rows (fixed by the feed format).
XML_ROW_TAG = "xml"
XML_SCHEMA = StructType([
    StructField("transaction", StructType([
        StructField("date", StringType(), False),
        StructField("reseller-id", StringType(), False),
    ])),
    StructField("tranactionId", LongType(), False),
    StructField("eventName", StringType(), False),
    StructField("numberOfPurchasedTickets", IntegerType(), False),
    StructField("totalAmount", DoubleType(), True),
    StructField("salesChannel", StringType(), False),
    StructField("Customer", StructType([
        StructField("first_name", StringType(), False),
        StructField("last_name", StringType(), True),
    ])),
    StructField("officeLocation", StringType(), True),
    StructField("dateCreated", DateType(), False),
])

WEBLOG_SCHEMA = StructType([
    StructField("client_ip", StringType()),
    StructField("user_identity", StringType()),
    StructField("user_name", StringType()),
    StructField("request_date", TimestampNTZType()),
    StructField("request_type", StringType()),
    StructField("request", StringType()),
    StructField("status", StringType()),
    StructField("response_size", LongType()),
    StructField("referer", StringType()),
    StructField("user_agent", StringType()),
])
WEBLOG_SEP = "&"
WEBLOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Name of a reseller's daily file: DailySales_<MMDD><any digit><YY>_<reseller>.csv
SALES_FILE_PATTERN = r"DailySales_(\d{2})(\d{2})\d(\d{2})_(-?\d+)\.csv"

def write_sales_csv(df: DataFrame, path: str, folders: int = 1) -> None:
    """One directory per feed file (``source_file=DailySales_…csv``), header on.
    A small file is one part, a large file is written by several tasks. With
    ``folders``, files are shared out among so many drop folders (``drop=…``),
    which a reader can take one after the other."""
    from boxoffice.sources.tables import by_partition_value, writers_per_core
    drop = [] if folders == 1 else [F.pmod(F.xxhash64("source_file"), F.lit(folders)).alias("drop")]
    with writers_per_core(df.sparkSession):
        (by_partition_value(df.select("*", *drop), "source_file")
         .write.mode("overwrite").partitionBy(*["drop"] * len(drop), "source_file")
         .option("header", True).csv(path))


def source_name():
    """The feed file a row came from: its name, or that of the folder it is part of."""
    return F.regexp_extract(F.col("_metadata.file_path"), SALES_FILE_PATTERN, 0).alias("source_file")


def read_sales_csv(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """S-3 + P-3: scan every feed file under ``path`` (a file may be a folder of
    parts) with the declared schema, then rename the nine columns. A header that
    differs from the declared names fails the read. ``source_file`` is the name
    of the feed file."""
    schema = CSV_SCHEMA if typed else StructType(
        [StructField(f.name, StringType(), True) for f in CSV_SCHEMA.fields])
    with few_listing_tasks(spark):
        raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
               .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path))
    if not typed:
        return raw
    return raw.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(CSV_SCHEMA.fields, FEED_COLUMNS)],
                      source_name())


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(path, header)``: the first line of every CSV file under ``path``. A file
    is read by whole blocks; the line with the lowest place in its first block
    is the header."""
    with few_listing_tasks(spark):
        text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    lines = (text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), "value")
             .filter(F.col("_start") == 0).withColumn("_at", F.monotonically_increasing_id()))
    return lines.groupBy("path").agg(F.min_by("value", "_at").alias("header"))


def write_sales_xml(df: DataFrame, path: str, files: int | None = None, compression: str = "none") -> None:
    """One XML file per task (or ``files`` files), so readers get as many
    tasks as the writer had. A compressed file is read by one task."""
    df = df.repartition(files) if files else df
    (df.write.mode("overwrite").option("compression", compression)
     .option("rowTag", XML_ROW_TAG).option("rootTag", "sales").xml(path))


def read_sales_xml(spark: SparkSession, path: str) -> DataFrame:
    """S-4: nested XML rows (row tag ``xml``) with the declared schema. One large file is
    split over many tasks, at its rows' true borders."""
    rows = xml_rows(spark, path, XML_ROW_TAG)
    return rows.select(F.from_xml("row", XML_SCHEMA, {"rowTag": XML_ROW_TAG}).alias("r")).select("r.*")


def flatten_xml(df: DataFrame) -> DataFrame:
    """P-4 + P-5: nested XML rows to the common feed layout plus the reseller id
    carried inside each row."""
    return df.select(
        F.col("tranactionId").alias("transID"),
        F.col("eventName"),
        F.col("numberOfPurchasedTickets").alias("Purchased_ticket"),
        F.col("totalAmount").alias("Amount"),
        F.col("salesChannel").alias("channel"),
        F.col("Customer.first_name").alias("custFirstName"),
        F.col("Customer.last_name").alias("custLastName"),
        F.col("officeLocation").alias("officeLoc"),
        F.col("dateCreated").alias("createDate"),
        F.col("transaction.`reseller-id`").alias("reseller_id"),
    )


def write_weblog(df: DataFrame, path: str, files: int | None = None) -> None:
    df = df.repartition(files) if files else df
    (df.write.mode("overwrite")
     .option("sep", WEBLOG_SEP).option("timestampNTZFormat", WEBLOG_TS_FORMAT).csv(path))


def read_weblog(spark: SparkSession, path: str) -> DataFrame:
    """S-10: the 10-column weblog, ``&`` as delimiter, no header."""
    return (spark.read.schema(WEBLOG_SCHEMA).option("sep", WEBLOG_SEP)
            .option("timestampNTZFormat", WEBLOG_TS_FORMAT).csv(path))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File paths under ``path`` as a DataFrame. ``binaryFile`` with only the
    path selected lists files in parallel and never reads their content."""
    with few_listing_tasks(spark):
        return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                .option("recursiveFileLookup", "true").load(path).select("path"))
