import datetime as dt
import uuid

from boxoffice.operators.rangejoin import ip_range_lookup
from boxoffice.sources import database, files

D = dt.date


def test_csv_round_trip_and_positional_rename(spark, tmp_dir):
    rows = [(1, "E1", 2, 20.5, "web", "Ann", None, "Paris", D(1999, 6, 1), "DailySales_0101000_5.csv"),
            (2, "E2", 1, None, "office", "Bob", "B", None, D(1999, 6, 2), "DailySales_0101000_7.csv")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.CSV_SCHEMA.fields)
    df = spark.createDataFrame(rows, schema + ", source_file string")
    files.write_sales_csv(df, tmp_dir)
    back = files.read_sales_csv(spark, tmp_dir)
    assert back.columns == files.FEED_COLUMNS + ["source_file"]
    got = sorted(repr(tuple(r)) for r in back.collect())
    assert got == sorted(repr(r) for r in rows)


def test_xml_round_trip_and_flatten(spark, tmp_dir):
    df = spark.createDataFrame(
        [(("2000-01-01", "5"), 1, "E1", 2, 20.0, "web", ("Ann", None), "Paris", D(1999, 6, 1))],
        files.XML_SCHEMA)
    files.write_sales_xml(df, tmp_dir, files=1)
    flat = files.flatten_xml(files.read_sales_xml(spark, tmp_dir)).collect()
    assert [tuple(r) for r in flat] == [(1, "E1", 2, 20.0, "web", "Ann", None, "Paris", D(1999, 6, 1), "5")]


def test_weblog_round_trip_keeps_microseconds(spark, tmp_dir):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    row = ("10.1.2.3", "-", "u", ts, "GET", "/a?b", "200", 123, "-", "Firefox")
    df = spark.createDataFrame([row], files.WEBLOG_SCHEMA)
    files.write_weblog(df, tmp_dir, files=1)
    assert [tuple(r) for r in files.read_weblog(spark, tmp_dir).collect()] == [row]


def test_jdbc_export_and_incremental_pull_pushdown(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:10]};create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.createDataFrame([(1, D(2000, 1, 1), None), (2, D(1999, 1, 1), D(2000, 1, 1)), (3, D(1999, 1, 1), None)],
                                "k int, CreateDate date, UpdateDate date")
    database.export_jdbc(src.filter("k < 3"), url, "SRC", opts)
    database.export_jdbc(src.filter("k = 3"), url, "SRC", opts)     # second append must not fail
    pulled = database.incremental_pull_jdbc(spark, url, "SRC", D(2000, 1, 1), opts)
    assert sorted(r.k for r in pulled.collect()) == [1, 2]
    assert "PushedFilters" in pulled._jdf.queryExecution().executedPlan().toString()
    assert database.incremental_count_jdbc(spark, url, "SRC", D(2000, 1, 1), opts).collect()[0].cnt == 2


def test_range_join_has_no_nested_loop_and_picks_block(spark):
    blocks = spark.createDataFrame([("10.0.0.0/8", "A"), ("11.0.0.0/9", "B"), ("12.1.2.0/24", "C")],
                                   "network string, country string")
    reqs = spark.createDataFrame([("10.200.1.1",), ("11.0.0.5",), ("11.200.0.1",), ("12.1.2.99",), ("bad",)],
                                 "client_ip string")
    out = ip_range_lookup(reqs, "client_ip", blocks, ["country"])
    assert dict((r.client_ip, r.country) for r in out.collect()) == {
        "10.200.1.1": "A", "11.0.0.5": "B", "11.200.0.1": None, "12.1.2.99": "C", "bad": None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_nested_blocks_take_longest_prefix(spark):
    blocks = spark.createDataFrame([("10.0.0.0/8", "wide"), ("10.1.0.0/16", "narrow")], "network string, c string")
    reqs = spark.createDataFrame([("10.1.2.3",), ("10.9.9.9",), ("10.1.2.3",)], "client_ip string")
    out = ip_range_lookup(reqs, "client_ip", blocks, ["c"], nested=True)
    assert sorted((r.client_ip, r.c) for r in out.collect()) == [
        ("10.1.2.3", "narrow"), ("10.1.2.3", "narrow"), ("10.9.9.9", "wide")]


def test_same_day_filter_pushes_to_parquet(spark, tmp_dir):
    from boxoffice.functions.columns import same_day
    spark.createDataFrame([(dt.datetime(2024, 1, 15, 23, 59),), (dt.datetime(2024, 1, 16, 0, 0),)],
                          "ts timestamp_ntz").write.mode("overwrite").parquet(tmp_dir)
    df = spark.read.parquet(tmp_dir).filter(same_day("ts", D(2024, 1, 15)))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_quarantine_reads_feed_once(spark, tmp_dir):
    from boxoffice.operators import rules
    spark.createDataFrame([(1, "E1", 2, 20.0, "web", "a", "b", "Paris", D(1999, 6, 1))],
                          "transID int, eventName string, Purchased_ticket int, Amount double, channel string, "
                          "custFirstName string, custLastName string, officeLoc string, createDate date") \
        .write.mode("overwrite").parquet(tmp_dir)
    feed = spark.read.parquet(tmp_dir)
    ev = spark.createDataFrame([("E2", 1.0, D(1990, 1, 1))], "EventName string, TicketCost double, CreateDate date")
    loc = spark.createDataFrame([("Rome",)], "LocName string")
    q = rules.quarantine(rules.rule_flags(feed, ev, loc, D(2000, 1, 1)), D(2000, 1, 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count(tmp_dir.rstrip("/").split("/")[-1]) == 1
    assert q.count() == 4


def test_create_table_if_absent_is_idempotent(spark, tmp_dir):
    from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType
    from boxoffice.sources.tables import create_table_if_absent
    schema = StructType([StructField("k", LongType(), False), StructField("v", StringType()),
                         StructField("load_date", DateType())])
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_table_if_absent(spark, name, schema, tmp_dir, ["load_date"])
    spark.createDataFrame([(1, "a", D(2000, 1, 1))], schema).write.insertInto(name)
    create_table_if_absent(spark, name, schema, tmp_dir, ["load_date"])      # second call keeps the data
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a", D(2000, 1, 1))]


def test_a_feed_file_is_one_part_however_much_is_shuffled(spark, tmp_dir):
    """More bytes than a task writes: splits of a piece would each hold rows of all its files."""
    from pyspark.sql import functions as F

    from boxoffice.session import setting
    rows = spark.range(60000, numPartitions=8).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("x"),
                                     F.concat(F.lit("DailySales_010100_"), (F.col("id") % 300).cast("string"), F.lit(".csv")).alias("source_file"))
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k"):
        files.write_sales_csv(rows, tmp_dir)
    assert len(files.list_files(spark, tmp_dir, "*.csv").collect()) == 300
    assert spark.read.option("header", True).csv(tmp_dir).count() == 60000
