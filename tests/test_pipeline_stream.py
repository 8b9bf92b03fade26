import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from boxoffice import fixtures as fx
from boxoffice.operators.checks import GateError
from boxoffice.plans import pipeline
from boxoffice.sources import files
from boxoffice.sources.tables import current_lookup

from .conftest import SF_SMALL

D = dt.date


def test_two_days_through_the_pipeline(spark, tmp_dir):
    wh = pipeline.Warehouse(spark, tmp_dir)
    sources = {"customer": fx.f_customer(spark, SF_SMALL), "event": fx.f_event(spark, SF_SMALL),
               "location": fx.f_location(spark, SF_SMALL), "reseller": fx.f_reseller(spark, SF_SMALL),
               "venue": fx.f_venue(spark, SF_SMALL), "commission": fx.f_commission(spark, SF_SMALL)}
    span = fx.date_span(spark, SF_SMALL)
    for day in (D(1995, 1, 1), D(1995, 1, 2)):
        pipeline.run_day(wh, sources, day, span)
    for name in pipeline.LOOKUPS:
        inc = wh.read("current", name)
        full = current_lookup(wh.read("staging", name), pipeline.STAGED_KEYS[name]).drop("BatchId")
        assert sorted(map(repr, inc.select(*full.columns).collect())) == sorted(map(repr, full.collect()))
    before = sorted(map(repr, wh.read("dwh", "customer").collect()))
    keys = sorted(r.row_wid for r in wh.read("dwh", "customer").collect())
    assert keys == list(range(1, len(keys) + 1))        # dense across both days
    pipeline.run_day(wh, sources, D(1995, 1, 2), span)  # a rerun changes nothing
    assert sorted(map(repr, wh.read("dwh", "customer").collect())) == before
    st = wh.read("staging", "customer").filter(F.col("load_date") == F.lit(D(1995, 1, 2)))
    assert st.count() == sources["customer"].filter(
        (F.col("CreateDate") == F.lit(D(1995, 1, 2))) | (F.col("UpdateDate") == F.lit(D(1995, 1, 2)))).count()


DAY, NEXT = D(2020, 1, 1), D(2020, 1, 2)
BIG = 30_000_000_001        # beyond 32 bits


def little_sources(spark):
    c = "CreateDate date, UpdateDate date"
    return {
        "customer": spark.createDataFrame([(1, "Ann", "Lee", None, None, DAY, None)],
                                          f"CustId long, FirstName string, LastName string, Pmail string, PhoneNo string, {c}"),
        "event": spark.createDataFrame([(1, 1, 1, "E1", "t", 10.0, DAY, None, DAY, NEXT)],
                                       f"EventId long, VenueId int, LocId int, EventName string, EventType string, TicketCost double, {c}, StartDate date, EndDate date"),
        "location": spark.createDataFrame([(1, "Paris", None, "c", "p", 1.0, DAY, None, "FR", None)],
                                          f"LocId int, LocName string, StAddress string, City string, Province string, Region double, {c}, Country string, PstCd string"),
        "reseller": spark.createDataFrame([(5, "Res", "Eller", DAY, None)], f"ResellerId long, FirstName string, LastName string, {c}"),
        "venue": spark.createDataFrame([(1, "V", DAY, DAY)], f"VenueId int, VenueName string, {c}"),
        "commission": spark.createDataFrame([(1, 1, 5, 0.1, DAY, None)], f"EvResId long, EvntId long, ResId long, Commission double, {c}"),
        "transaction": spark.createDataFrame(
            [(1, 1, 1, "web", DAY, None, 2, 20.0, "N", 5), (2, 1, 1, "web", DAY, None, 1, 10.0, "N", None),
             (3, 1, 1, "web", DAY, DAY, 1, 10.0, "Y", -1)],
            f"TransId long, CustId long, EventId long, Channel string, {c}, TicketsCnt int, Amount double, delFlag string, Reseller_id long"),
    }


HEADER = ",".join(f'"{f.name}"' for f in files.CSV_SCHEMA.fields)


def drop(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return folder


XML_ROW = ("<xml><transaction><date>2020-01-01</date><reseller-id>5</reseller-id></transaction><tranactionId>{id}</tranactionId>"
           "<eventName>{event}</eventName><numberOfPurchasedTickets>2</numberOfPurchasedTickets><totalAmount>20.0</totalAmount>"
           "<salesChannel>web</salesChannel><Customer><first_name>Ann</first_name><last_name>Lee</last_name></Customer>"
           "<officeLocation>Paris</officeLocation><dateCreated>2020-01-01</dateCreated></xml>")


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_a_day_of_all_channels_and_its_rerun(spark, tmp_dir):
    wh, src = pipeline.Warehouse(spark, tmp_dir + "/wh"), little_sources(spark)
    csv = drop(tmp_dir + "/csv", "DailySales_0101020_5.csv",
               [f"{BIG},E1,2,20.0,web,Ann,Lee,Paris,2020-01-01", "11,E2,2,20.0,web,Ann,Lee,Paris,2020-01-01"])
    os.makedirs(tmp_dir + "/xml")
    with open(tmp_dir + "/xml/a.xml", "w") as f:
        f.write("<sales>" + XML_ROW.format(id=BIG + 1, event="E1") + XML_ROW.format(id=21, event="E2") + "</sales>")
    args = (wh, src, DAY, (DAY, D(2020, 12, 31)))
    drops = {"csv": csv, "xml": tmp_dir + "/xml"}
    pipeline.run_day(*args, drops)
    fact = wh.read("dwh", "transaction")
    assert {(r.src_trans_id, r.sold_by, r.reseller_id, r.commission) for r in fact.collect()} == {
        (1, "platfrom", 1, 0.1), (2, "platfrom", 1, 0.0), (3, "platfrom", 1, 0.0),
        (BIG, "Csv_3rdparthy_platfrom", 1, 0.1), (BIG + 1, "Xml_3rdparty_platfrom", 1, 0.1)}
    assert wh.read("dwh", "venue").count() == 1          # created and updated on one day
    before = {n: rows(wh.read("dwh", n)) for n in ("transaction", "customer", "event", "reseller", "venue", "location")}
    pipeline.run_day(*args, drops)
    assert before == {n: rows(wh.read("dwh", n)) for n in before}
    # the next day the unknown event exists: the rejected rows pass
    src["event"] = src["event"].union(spark.createDataFrame([(2, 1, 1, "E2", "t", 10.0, D(2019, 12, 1), NEXT, DAY, NEXT)], src["event"].schema))
    src["event"] = src["event"].withColumn("CreateDate", F.when(F.col("EventId") == 2, F.lit(DAY)).otherwise(F.col("CreateDate")))
    for _ in range(2):
        pipeline.stage_changes(wh, src, NEXT)
        for kind in ("csv", "xml"):
            pipeline.reprocess_files(wh, kind, pipeline.read_feed(wh, kind, drops[kind]), NEXT)
        for kind, ident in (("csv", 11), ("xml", 21)):
            staged = wh.read("staging", pipeline.STAGED_FILES[kind]).filter(F.col("load_date") == F.lit(NEXT)).collect()
            assert [(r.transID, r.Reseller_id, r.BatchId) for r in staged] == [(ident, 5, 20200102)]
            errors = wh.read("errors", kind).collect()
            assert {(r.transID, r.reprocessed, r.updateDt) for r in errors} == {(ident, "Y", NEXT)}


def test_a_failing_gate_removes_only_the_day(spark, tmp_dir):
    wh, src = pipeline.Warehouse(spark, tmp_dir), little_sources(spark)
    span = (DAY, D(2020, 12, 31))
    pipeline.run_day(wh, src, DAY, span)
    bad = src["transaction"].limit(1).withColumn("TransId", F.lit(9).cast("long")).withColumn("EventId", F.lit(99).cast("long")) \
        .withColumn("CreateDate", F.lit(NEXT))
    with pytest.raises(GateError):                       # its event is unknown
        pipeline.run_day(wh, src | {"transaction": bad}, NEXT, span)
    assert {r.src_trans_id for r in wh.read("dwh", "transaction").collect()} == {1, 2, 3}


def test_file_gates(spark, tmp_dir):
    wh, src = pipeline.Warehouse(spark, tmp_dir + "/wh"), little_sources(spark)
    pipeline.stage_changes(wh, src, DAY)
    line = ["1,E1,2,20.0,web,Ann,Lee,Paris,2020-01-01"]
    with pytest.raises(GateError, match="file name"):
        pipeline.stage_files(wh, "csv", drop(tmp_dir + "/a", "sales.csv", line), DAY)
    swapped = HEADER.replace("first", "x").replace("last", "first").replace("x", "last")
    with pytest.raises(GateError, match="column"):
        pipeline.stage_files(wh, "csv", drop(tmp_dir + "/b", "DailySales_0101020_5.csv", line, swapped), DAY)
    good = drop(tmp_dir + "/c", "DailySales_0101020_5.csv", ["1,E9,2,20.0,web,Ann,Lee,Paris,2020-01-01"])
    pipeline.stage_files(wh, "csv", good, DAY)
    assert wh.read("errors", "csv").count() == 3
    drop(tmp_dir + "/c", "DailySales_0101020_5.csv", line)
    pipeline.stage_files(wh, "csv", good, DAY)           # a clean rerun leaves no old errors
    left = wh.read("errors", "csv")
    assert left is None or left.count() == 0


def test_replayed_stream_batch_adds_nothing(spark, tmp_dir):
    from boxoffice.streaming.file_drop import write_batch
    df = spark.createDataFrame([(1, DAY)], "transID long, load_date date")
    for _ in range(2):
        write_batch(df, tmp_dir + "/t", DAY, 0)
    assert spark.read.parquet(tmp_dir + "/t").count() == 1


def test_changed_input_gets_new_tables(spark, tmp_dir):
    from boxoffice.workspace import Workspace
    spark.range(3).write.parquet(tmp_dir + "/t.parquet")
    first = Workspace(spark, tmp_dir).root
    assert Workspace(spark, tmp_dir).root == first
    spark.range(4).write.mode("overwrite").parquet(tmp_dir + "/t.parquet")
    assert Workspace(spark, tmp_dir).root != first


def test_null_keys_do_not_meet_in_one_task(spark):
    from boxoffice.operators.lookups import left_lookup
    left = spark.createDataFrame([(i, None if i % 2 else i) for i in range(40)], "id long, k long")
    right = spark.createDataFrame([(0, "zero"), (2, "two")], "rk long, v string")
    got = {r.id: r.v for r in left_lookup(left, right, [("k", "rk")], "id").collect()}
    assert got == {i: {0: "zero", 2: "two"}.get(i) for i in range(40)}


def test_stream_validates_each_dropped_file_once(spark, tmp_dir):
    drop = os.path.join(tmp_dir, "drop")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.CSV_SCHEMA.fields)
    rows = [(1, "E1", 2, 20.0, "web", "a", "b", "Paris", D(1999, 6, 1)),
            (2, "E9", 2, 20.0, "web", "a", "b", "Paris", D(1999, 6, 1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True) \
        .csv(os.path.join(drop, "DailySales_0101000_5.csv"))
    ev = spark.createDataFrame([("E1", 10.0, D(1999, 1, 1))], "EventName string, TicketCost double, CreateDate date")
    loc = spark.createDataFrame([("Paris",)], "LocName string")
    args = dict(drop_dir=drop + "/*", checkpoint=os.path.join(tmp_dir, "ckpt"),
                staging_path=os.path.join(tmp_dir, "staging"), errors_path=os.path.join(tmp_dir, "errors"),
                lookups=lambda: (ev, loc), run_date=lambda: D(2000, 1, 1))
    from boxoffice.streaming.file_drop import start_feed_validation
    q = start_feed_validation(spark, **args)
    q.awaitTermination(120)
    q2 = start_feed_validation(spark, **args)        # restart: nothing new to take
    q2.awaitTermination(120)
    staged = spark.read.parquet(args["staging_path"]).collect()
    assert [(r.transID, r.Reseller_id) for r in staged] == [(1, 5)]
    errs = sorted(r.comment for r in spark.read.parquet(args["errors_path"]).collect())
    assert errs == ["invalid_date", "invalid_event", "invalid_ticket_amount"]


def test_interrupted_swap_is_undone_on_read(spark, tmp_dir):
    wh = pipeline.Warehouse(spark, tmp_dir)
    df = spark.createDataFrame([(1, 199501), (2, 199502)], "k int, create_month int")
    wh.replace("dwh", "t", df)
    fs, hp = wh._fs(wh.path("dwh", "t"))
    _, aside = wh._fs(wh.path("dwh", "t") + ".old")
    fs.rename(hp, aside)                       # stopped after moving the old copy aside
    assert sorted(r.k for r in wh.read("dwh", "t").collect()) == [1, 2]
    wh.replace_partitions("dwh", "p", df, "create_month", [199501, 199502])
    p = wh.path("dwh", "p")
    _, part = wh._fs(f"{p}/create_month=199501")
    _, paside = wh._fs(f"{p}.aside/create_month=199501")
    fs.mkdirs(paside.getParent())
    fs.rename(part, paside)                    # stopped inside a partition swap
    assert sorted(r.k for r in wh.read("dwh", "p").collect()) == [1, 2]
