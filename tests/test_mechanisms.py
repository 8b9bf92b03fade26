"""Set difference, hot keys, nested networks and repeated keys against plain joins."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from boxoffice.operators import hotkeys, rangejoin, setdiff, uniqueness


def plain_difference(src, dst):
    return {(*k, "missing") for k in set(src) - set(dst)} | {(*k, "extra") for k in set(dst) - set(src)}


@pytest.mark.parametrize("lost", [0, 3, 40, 900])
def test_differing_keys_equal_an_anti_join(spark, lost):
    rng = random.Random(lost)
    src = [(rng.choice([1, 2, None]), i if i % 50 else None, str(i)) for i in range(2000)]
    gone = set(rng.sample(range(2000), lost))
    dst = [r for i, r in enumerate(src) if i not in gone] + [(2, -i, "x") for i in range(lost // 3)]
    src += src[:30]                                     # repeated keys are one key
    schema = "day int, k long, name string"
    a, b = (spark.createDataFrame(x, schema) for x in (src, dst))
    got = [tuple(r) for r in setdiff.differing_keys(a, b, ["day"], ["k", "name"]).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_difference(src, dst)


def test_small_differences_empty_their_tables(spark):
    src = spark.range(20_000).select((F.col("id") % 5).alias("day"), "id")
    dst = src.where("id % 250 != 7")
    table = setdiff.difference_table(src, dst, ["day"], ["id"])
    assert table.count() <= 3 * 80
    found = setdiff.decode(table, ["day"]).collect()
    assert len(found) == 80 and all(r.element is not None for r in found)
    whole = setdiff.decode(setdiff.difference_table(src, dst.limit(10), ["day"], ["id"]), ["day"]).collect()
    assert [r.element for r in whole] == [None] * 5       # told, and then compared key by key
    assert setdiff.differing_keys(src, src, [], ["id"]).count() == 0
    assert [tuple(r) for r in setdiff.differing_keys(src.where("id < 3"), src.where("id < 2"), [], ["id"]).collect()] == [(2, "missing")]


def test_spread_join_equals_the_plain_join(spark):
    rows = [(i, "hot" if i % 2 else f"k{i % 97}" if i % 3 else None, i % 4) for i in range(4000)] + [(1, "hot", 1)] * 50
    left = spark.createDataFrame(rows, "id int, name string, n int")
    right = spark.createDataFrame([("hot", 1, "a"), ("hot", 3, "b"), ("k5", 1, "c"), ("k4", 0, "d"), (None, 1, "e")], "rname string, rn long, v string")
    for pairs in ([("name", "rname")], [("name", "rname"), ("n", "rn")]):
        cond = [left[a] == right[b] for a, b in pairs]
        for how in ("inner", "left"):
            got = hotkeys.spread_join(left, right, pairs, how, tasks=8)
            assert got.columns == left.columns + right.columns
            assert sorted(map(repr, got.collect())) == sorted(map(repr, left.join(right, cond, how).select(*left.columns, *right.columns).collect()))


def test_a_hot_name_is_shared_by_all_tasks(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    left = spark.range(64_000, numPartitions=8).select("id", F.when(F.col("id") % 2 == 0, F.lit("E1")).otherwise(F.concat(F.lit("E"), F.col("id") % 5000)).alias("name"))
    right = spark.range(5000).select(F.concat(F.lit("E"), F.col("id")).alias("rname"), F.col("id").alias("cost"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = hotkeys.spread_join(left, right, [("name", "rname")])
        plain = left.join(right, left["name"] == right["rname"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(sizes) == 16 and sum(sizes) == 64_000
    assert sizes[-1] <= 2 * sizes[8] < worst


def brute_network(blocks, ip):
    try:
        a = ipaddress.ip_address(ip)
    except ValueError:
        return None
    inside = [(-n.prefixlen, c) for n, c in blocks if a in n]
    return min(inside)[1] if inside else None


@pytest.mark.parametrize("group", [1 << 14, 100])
def test_nested_networks_give_the_longest_prefix(spark, monkeypatch, group):
    monkeypatch.setattr(rangejoin, "GROUP_ROWS", group)
    rng = random.Random(8)
    nets = [("0.0.0.0/0", "all")] * 1 + [("10.0.0.0/8", "ten"), ("10.0.0.0/8", "other"), ("10.0.0.0/9", "half"), ("10.0.0.0/32", "one"),
                                         ("255.255.255.255/32", "last"), ("bad", "x"), ("1.2.3.4/40", "y")]
    for _ in range(400):
        length = rng.choice([6, 8, 10, 15, 16, 17, 20, 24, 28, 32])
        start = rng.getrandbits(32) if rng.random() < .5 else (10 << 24) + rng.getrandbits(24)
        nets.append((str(ipaddress.ip_network((start >> (32 - length) << (32 - length), length))), f"c{rng.randint(0, 9)}"))
    for some in (nets, nets[1:]):
        parsed = [(ipaddress.ip_network(n), c) for n, c in some if "/" in n and n != "1.2.3.4/40"]
        ips = [str(ipaddress.ip_address(rng.getrandbits(32) if i % 2 else (10 << 24) + rng.getrandbits(24))) for i in range(600)]
        ips += [str(n[0]) for n, _ in parsed] + [str(n[-1]) for n, _ in parsed] + ["no address", None] + ["10.0.0.1"] * 500
        blocks = spark.createDataFrame(some, "network string, country string")
        reqs = spark.createDataFrame(list(enumerate(ips)), "id int, client_ip string")
        out = rangejoin.ip_range_lookup(reqs, "client_ip", blocks, ["country"], nested=True)
        got = {r.id: r.country for r in out.collect()}
        assert out.columns == ["id", "client_ip", "country"] and got == {i: brute_network(parsed, ip) for i, ip in enumerate(ips)}
        flat = sorted(tuple(r) for r in rangejoin.flatten_blocks(blocks, ["country"]).collect())
        assert all(a[1] < b[0] for a, b in zip(flat, flat[1:])) and all(s <= e for s, e, _ in flat)
        assert len(flat) <= 2 * len(parsed) + 33 * 8


def test_a_wide_network_is_a_few_rows(spark):
    blocks = spark.createDataFrame([("0.0.0.0/0", "all"), ("10.0.0.0/8", "ten")], "network string, country string")
    assert rangejoin.flatten_blocks(blocks, ["country"]).count() <= 3 + 8
    empty = blocks.limit(0)
    reqs = spark.createDataFrame([("10.0.0.1",)], "client_ip string")
    assert [tuple(r) for r in rangejoin.ip_range_lookup(reqs, "client_ip", empty, ["country"], nested=True).collect()] == [("10.0.0.1", None)]


def test_ipv6_lookup_equals_the_library(spark):
    rng = random.Random(6)
    nets = [("::/0", "all"), ("2001:db8::/32", "doc"), ("2001:DB8:0:8000::/49", "half"), ("2001:db8::1:0:0:0/64", "x"), ("::1/128", "one"),
            ("2001:db8::/129", "bad"), ("2001:db8::", "bad"), ("8000::/1", "top"), ("2001:db8::8000:0:0:0/65", "low")]
    ips = [str(ipaddress.IPv6Address(rng.getrandbits(128))) for _ in range(200)]
    ips += [str(ipaddress.IPv6Address((0x20010db8 << 96) + (rng.getrandbits(64) << rng.choice([0, 16, 32])))) for _ in range(200)]
    ips += ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "ffff:FFFF:ffff:ffff:ffff:ffff:ffff:ffff", "2001:db8:0:8000::"]
    bad = ["", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4::5:6:7:8", "::12345", "g::", "1:", ":1", "::1.2.3.4", "::1 ",
           "::1\n", None, "1:::2", "10.0.0.1"]
    parsed = [(ipaddress.ip_network(n.lower(), strict=False), c) for n, c in nets if c != "bad"]

    def brute(ip):
        inside = [(n.prefixlen, c) for n, c in parsed if ipaddress.IPv6Address(ip) in n]
        return (True, max(inside)[1])

    df = spark.createDataFrame(list(enumerate(ips + bad)), "id int, client_ip string")
    out = rangejoin.ipv6_prefix_lookup(df, "client_ip", spark.createDataFrame(nets, "network string, country string"), ["country"])
    want = {i: brute(ip) for i, ip in enumerate(ips)} | {len(ips) + i: (False, None) for i in range(len(bad))}
    assert {r.id: (r.ip_ok, r.country) for r in out.collect()} == want


def test_packed_numbers_come_back():
    import numpy as np
    rng = np.random.default_rng(9)
    gaps = np.concatenate([[0, 127, 128, (1 << 40) - 1, 0], rng.integers(0, 1 << 40, 500) >> rng.integers(0, 40, 500)])
    assert (uniqueness._unpacked(uniqueness._packed(gaps)) == gaps).all()


def test_repeated_keys_equal_a_count(spark, monkeypatch):
    rows = [(i % 700 if i % 3 else None, f"n{i % 11}") for i in range(3000)] + [(10_000 + i, "once") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, name string").repartition(5)
    want = sorted(map(repr, df.groupBy("k", "name").count().withColumnRenamed("count", "n").where("n > 1").collect()))
    for size in (1 << 20, 100):
        monkeypatch.setattr(uniqueness, "STRETCH", size)
        assert sorted(map(repr, uniqueness.repeated_keys(df, ["k", "name"]).collect())) == want
    assert uniqueness.repeated_keys(df.limit(0), ["k"]).count() == 0


def test_the_first_pass_sends_a_few_bytes_a_key(spark):
    keys = spark.range(400_000, numPartitions=4).select(F.concat(F.lit("customer-number-"), "id").alias("k"))
    sent = uniqueness.stretches(keys, ["k"], 0).agg(F.sum(F.length("places")).alias("n")).first()["n"]
    assert sent < 4 * 400_000
    hot = spark.range(400_000, numPartitions=4).select(F.lit("same").alias("k"))
    assert uniqueness.stretches(hot, ["k"], 0).agg(F.sum(F.length("places")).alias("n")).first()["n"] < 100


def test_only_buckets_of_the_day_are_rewritten(spark, tmp_dir):
    import datetime as dt
    import glob

    from boxoffice.plans import dims, pipeline
    from boxoffice.sources.calendar import lookup_calendar

    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    schema = "VenueId long, VenueName string, CreateDate date, UpdateDate date, load_date date"
    one = spark.createDataFrame([(i, f"v{i}", d1, None, d1) for i in range(300)], schema)
    two = spark.createDataFrame([(300, "new", d2, None, d2), (7, "changed", d1, d2, d2)], schema)
    cal = lookup_calendar(spark, d1, dt.date(2020, 12, 31))
    house = pipeline.Warehouse(spark, tmp_dir + "/part", dim_buckets=16)
    files_of = lambda: {f: f.split("key_bucket_of_16=")[1].split("/")[0] for f in glob.glob(tmp_dir + "/part/dwh/venue/*/*.parquet")}
    pipeline.load_dimension_part(house, "venue", one, cal)
    before = files_of()
    for _ in range(2):                                    # and again
        dim = pipeline.load_dimension_part(house, "venue", two, cal)
    after = files_of()
    touched = {str(r["b"]) for r in two.select(house.bucket("VenueId").alias("b")).collect()}
    assert {f for f, b in before.items() if b not in touched} == {f for f, b in after.items() if b not in touched}
    assert len(set(before.values()) - touched) >= 14 and not {f for f, b in before.items() if b in touched} & set(after)
    whole = dims.load_dimension(two, cal, dims.VENUE, existing=dims.load_dimension(one, cal, dims.VENUE))
    assert sorted(map(repr, dim.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))
    other = pipeline.Warehouse(spark, tmp_dir + "/part", dim_buckets=4)          # another layout
    again = pipeline.load_dimension_part(other, "venue", two, cal)
    assert sorted(map(repr, again.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("lg", [4, 12])
def test_sketches_gate_months_like_exact_counts(spark, lg):
    from boxoffice.operators import sketches
    src = spark.range(6000).select((F.lit(20200100) + F.col("id") % 3 * 100 + F.col("id") % 28 + 1).alias("day"),
                                   F.when(F.col("id") % 500 != 7, F.col("id")).alias("k"))
    dst = src.where("k is null or k % 3 != 1 or k % 1000 != 1").union(src.limit(5)).union(spark.sql("select 20200505L, 1L"))
    month = lambda d: (d / 100).cast("int")
    a, b = (sketches.daily_sketches(x, "day", ["k"], lg) for x in (src, dst))
    got = {r.period: (r.src_cnt, r.dst_cnt, r.ok) for r in sketches.gate_periods(a, b, src, dst, "day", month, ["k"], lg).collect()}
    sets = [{}, {}]
    for s, df in zip(sets, (src, dst)):
        for r in df.collect():
            s.setdefault(r.day // 100, set()).add(r.k)
    want = {m: (len(sets[0].get(m, ())), len(sets[1].get(m, ())), sets[0].get(m) == sets[1].get(m)) for m in set(sets[0]) | set(sets[1])}
    assert got == want and {v[2] for v in want.values()} == {True, False}
    left = sketches.gate_sketches(a, b, month(F.col("day")), lg).where("ok is null").count()
    assert (left == 0) == (lg == 12)                      # sketches alone decide while they are exact


def test_types_of_files_join_upwards(spark):
    from pyspark.sql import types as T

    from boxoffice.operators import schemadrift
    rows = [("a", "1", "true", "2020-01-01", None, "1"), ("a", "-7", "FALSE", "2020-02-29", None, "x"),
            ("b", "3000000000", "true", "2020-01-01 10:00:00", None, "1"), ("b", None, "false", "2020-01-02", None, "2"),
            ("c", "1.5e3", "1", "2020-02-30", None, "3"), ("c", ".5", "0", "2020-01-01", None, "3")]
    df = spark.createDataFrame(rows, "f string, n string, b string, d string, e string, s string")
    counts = schemadrift.type_counts(df, ["f"], ["n", "b", "d", "e", "s"])
    got = {(r.f, r.column_name): r.type_name for r in schemadrift.narrowest(counts).collect()}
    assert [got[f, "n"] for f in "abc"] == ["int", "bigint", "double"]
    assert [got[f, "b"] for f in "abc"] == ["boolean", "boolean", "int"]
    assert [got[f, "d"] for f in "abc"] == ["date", "timestamp", "string"]
    assert [got[f, "e"] for f in "abc"] == ["void"] * 3 and [got[f, "s"] for f in "abc"] == ["string", "int", "int"]
    whole = schemadrift.narrowest(schemadrift.joined(counts))
    assert {r.column_name: r.type_name for r in whole.collect()} == {"n": "double", "b": "string", "d": "string", "e": "void", "s": "string"}
    direct = schemadrift.narrowest(schemadrift.type_counts(df, [], ["n", "b", "d", "e", "s"])).select(whole.columns)
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, whole.collect()))
    schema = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("d", T.DateType()), T.StructField("s", T.StringType(), False)])
    ok = {(r.f, r.column_name): r.ok for r in schemadrift.drift(schemadrift.narrowest(counts), schema).collect()}
    assert ok == {("a", "n"): True, ("b", "n"): False, ("c", "n"): False, ("a", "d"): True, ("b", "d"): False, ("c", "d"): False,
                  ("a", "s"): True, ("b", "s"): True, ("c", "s"): True}


def test_a_joins_estimate_does_not_size_a_write(spark, tmp_dir):
    import glob
    import re

    from boxoffice.sources.tables import write_staging
    wide = spark.range(1_000_000).select(F.col("id").alias("a"))
    for c in "bcd":                                       # the estimate is the product of the sides
        wide = wide.join(spark.range(1_000_000).select(F.col("id").alias(c)), F.col("a") == F.col(c))
    write_staging(wide.where("a < 500").withColumn("load_date", F.expr("date_add(date'2020-01-01', int(a % 20))")), tmp_dir + "/t")
    tasks = {re.search(r"part-(\d+)", f).group(1) for f in glob.glob(tmp_dir + "/t/*/*.parquet")}
    assert 1 <= len(tasks) <= 64 and spark.read.parquet(tmp_dir + "/t").count() == 500


def test_xml_rows_end_outside_comments_and_cdata(spark, tmp_dir):
    import os

    from boxoffice.sources import files
    rng = random.Random(11)
    names, text = [], ["<?xml version='1.0'?>\n<!-- <xml> no row </xml> --><sales>\n"]
    for i in range(300):
        kind = rng.randrange(6)
        name = f"E{i}" + ["", "</xml>", "<!--", "]]", "<xml>" * 40 + "</xml>" * 30, ""][kind]
        names.append((i, name))
        noise = ["", "<!-- </xml> ]]> <![CDATA[ -->", "<?pi </xml> --> ?>", "<!--" + "</xml>" * rng.randrange(60) + "-->"][rng.randrange(4)]
        shown = f"<![CDATA[{name}]]>" if kind else name
        text.append(f"<xml>{noise}<tranactionId>{i}</tranactionId><eventName>{shown}</eventName>"
                    f"<numberOfPurchasedTickets>1</numberOfPurchasedTickets>{noise}</xml>\n")
    os.makedirs(tmp_dir + "/x")
    for f in ("a", "b"):
        with open(f"{tmp_dir}/x/{f}.xml", "w") as out:
            out.write("".join(text) + "</sales><!-- end </xml> -->")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "2000b", "300b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b" if size != "128m" else "4m")
            got = sorted((r.tranactionId, r.eventName) for r in files.read_sales_xml(spark, tmp_dir + "/x").collect())
            assert got == sorted(names * 2), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_feeds_are_parsed_once_and_kept_compressed(spark):
    import glob

    from boxoffice.plans import staging as stg
    from boxoffice.workspace import Workspace
    ws = Workspace(spark, "/root/testdata/sf0.001")
    for again in stg.reprocessed(ws, "xml"):
        plan = again._jdf.queryExecution().toString()
        assert "from_xml" not in plan and "MapInArrow" not in plan and "landed/xml" in plan
    assert "landed/csv" in stg.reprocessed(ws, "csv")[0]._jdf.queryExecution().toString()
    parts = glob.glob(stg.xml_feed_path(ws).removeprefix("file:") + "/part-*")
    assert parts and all(p.endswith(".gz") for p in parts)
    assert sorted(map(repr, stg.xml_rows(ws).collect())) == sorted(map(repr, stg.xml_feed(ws).collect()))
    assert sorted(map(repr, stg.csv_rows(ws).collect())) == sorted(map(repr, stg.csv_feed(ws).collect()))


def test_a_feed_of_several_drop_folders_is_landed_folder_by_folder(spark, tmp_dir, monkeypatch):
    import datetime as dt
    import os

    from boxoffice import fixtures as fx
    from boxoffice.plans import staging as stg
    from boxoffice.sources import files
    from boxoffice.workspace import Workspace
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.CSV_SCHEMA.fields)
    rows = [(i, f"E{i}", 2, None, "web", "Ann", None, None, dt.date(1999, 6, 1), f"DailySales_0101000_{i % 40}.csv") for i in range(200)]
    feed = spark.createDataFrame(rows, schema + ", source_file string")
    monkeypatch.setattr(fx, "f_csv_sale", lambda *a: feed)
    monkeypatch.setattr(fx, "f_reseller", lambda *a: spark.range(40))
    monkeypatch.setattr(stg, "FILES_A_FOLDER", 16)
    listed, read = [], files.read_sales_csv
    monkeypatch.setattr(files, "read_sales_csv", lambda s, path, **k: listed.append(path) or read(s, path, **k))
    ws = Workspace(spark, tmp_dir)
    monkeypatch.setattr(ws, "root", tmp_dir + "/tables")
    got = stg.csv_rows(ws)
    assert len(listed) == 3 and len({os.path.basename(p) for p in listed}) == 3
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, rows))


def test_shuffles_of_a_built_table_are_removed_when_it_is_written(spark, tmp_dir, monkeypatch):
    from boxoffice.workspace import Workspace
    ws = Workspace(spark, tmp_dir)
    monkeypatch.setattr(ws, "root", tmp_dir + "/tables")
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = set(range(1_000_000)) if shuffles is None else {k for k in range(100_000) if shuffles.contains(k)}
    made = ws.parquet("t", lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert made.count() == 7
    kept = {k for k in range(max(before, default=0) + 1, max(before, default=0) + 1000) if shuffles.contains(k)}
    assert len(kept) <= 1                                 # that of made.count() above
