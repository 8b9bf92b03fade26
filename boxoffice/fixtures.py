"""Stand-ins for the ticketing sources, derived from the driver's test tables.

Every entity is a lazy DataFrame over the parquet tables, so scans prune to the
columns each definition touches and the work grows with the tables. The SQL
twins of these definitions live in ``boxoffice.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.columns import ntz_literal

# Fixed values of the fixture design (not taken from any source system).
BASE_CREATE = dt.date(1995, 1, 1)
BASE_UPDATE = dt.date(1996, 1, 1)
EVENT_START = dt.date(1996, 6, 1)
EVENT_END = dt.date(1996, 7, 1)
LOCATION_UPDATE = dt.date(1996, 3, 1)
RESELLER_UPDATE = dt.date(1996, 2, 1)
VENUE_UPDATE = dt.date(1996, 4, 1)
WEB_BASE = dt.datetime(2024, 1, 1)
DOB_BASE = dt.date(1960, 1, 1)
FILE_RUN_DATE = dt.date(2000, 1, 1)      # run date of the reseller file drop
REPROCESS_DATE = dt.date(2002, 1, 1)     # later run that re-validates errors
CHANGE_DAY = dt.date(1998, 3, 2)         # a day with creates and updates

FEED_PLATFORM, FEED_CSV, FEED_XML = "N", "A", "R"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days_after(base: dt.date, n: Column) -> Column:
    return F.date_add(F.lit(base), n.cast("int"))


def f_customer(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("CustId"),
        F.substring("c_name", 1, 8).alias("FirstName"),
        F.expr("substring(c_name, 10)").alias("LastName"),
        F.lit(None).cast("string").alias("Pmail"),
        F.lit(None).cast("string").alias("PhoneNo"),
        _days_after(BASE_CREATE, F.col("c_custkey") % 365).alias("CreateDate"),
        F.when(F.col("c_custkey") % 4 == 0,
               _days_after(BASE_UPDATE, F.col("c_custkey") % 365)).alias("UpdateDate"),
    )


def f_location(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("LocId"),
        F.col("n_name").alias("LocName"),
        F.lit(None).cast("string").alias("StAddress"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("Province"),
        F.col("r_regionkey").cast("double").alias("Region"),
        F.lit(BASE_CREATE).alias("CreateDate"),
        F.when(F.col("n_nationkey") % 3 == 0,
               _days_after(LOCATION_UPDATE, F.col("n_nationkey"))).alias("UpdateDate"),
        F.col("n_name").alias("Country"),
        F.lit(None).cast("string").alias("PstCd"),
    )


def f_venue(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    vid = F.expr("substring(p_brand, 7)").cast("int")
    return p.select(vid.alias("VenueId"), F.col("p_brand").alias("VenueName")).distinct().select(
        "VenueId", "VenueName",
        F.lit(BASE_CREATE).alias("CreateDate"),
        F.when(F.col("VenueId") % 4 == 0,
               _days_after(VENUE_UPDATE, F.col("VenueId"))).alias("UpdateDate"),
    )


def f_event(spark, sf_dir, name_col: str | None = None) -> DataFrame:
    """Events from parts. ``name_col='p_name'`` gives the non-unique names used
    for the lookup fan-out case."""
    p = table(spark, sf_dir, "part")
    name = (F.col(name_col) if name_col
            else F.concat(F.lit("Event#"), F.col("p_partkey").cast("string")))
    return p.select(
        F.col("p_partkey").alias("EventId"),
        F.expr("substring(p_brand, 7)").cast("int").alias("VenueId"),
        (F.col("p_partkey") % 25).cast("int").alias("LocId"),
        name.alias("EventName"),
        F.col("p_type").alias("EventType"),
        F.col("p_retailprice").alias("TicketCost"),
        _days_after(BASE_CREATE, F.col("p_partkey") % 365).alias("CreateDate"),
        F.when(F.col("p_partkey") % 5 == 0,
               _days_after(BASE_UPDATE, F.col("p_partkey") % 365)).alias("UpdateDate"),
        _days_after(EVENT_START, F.col("p_partkey") % 365).alias("StartDate"),
        F.when(F.col("p_partkey") % 10 != 0,
               _days_after(EVENT_END, F.col("p_partkey") % 365)).alias("EndDate"),
    )


def f_reseller(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("ResellerId"),
        F.substring("s_name", 1, 8).alias("FirstName"),
        F.expr("substring(s_name, 10)").alias("LastName"),
        F.lit(BASE_CREATE).alias("CreateDate"),
        F.when(F.col("s_suppkey") % 3 == 0,
               _days_after(RESELLER_UPDATE, F.col("s_suppkey") % 365)).alias("UpdateDate"),
    )


def f_commission(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_partkey").alias("EvntId"), F.col("l_suppkey").alias("ResId"))
            .agg(F.max("l_discount").alias("Commission"))
            .select((F.col("EvntId") * 1000000 + F.col("ResId")).alias("EvResId"),
                    "EvntId", "ResId", "Commission",
                    F.lit(BASE_CREATE).alias("CreateDate"),
                    F.lit(None).cast("date").alias("UpdateDate")))


def f_sale(spark, sf_dir) -> DataFrame:
    """One sale per line item; ``feed`` splits it into the three channels."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(p, li.l_partkey == p.p_partkey)
         .join(n, (li.l_partkey % 25) == n.n_nationkey))
    tickets = F.col("l_quantity").cast("int")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("TransId"),
        F.col("l_returnflag").alias("feed"),
        F.col("o_custkey").alias("CustId"),
        F.col("l_partkey").alias("EventId"),
        F.col("l_suppkey").alias("l_suppkey"),
        F.when(F.col("l_orderkey") % 50 == 0, F.lit("Unknown event"))
         .otherwise(F.concat(F.lit("Event#"), F.col("l_partkey").cast("string"))).alias("eventName"),
        F.when(F.col("l_orderkey") % 40 == 0, F.lit("Nowhere")).otherwise(F.col("n_name")).alias("officeLoc"),
        F.when(F.col("l_orderkey") % 60 == 0, F.lit(-1).cast("bigint"))
         .when(F.col("l_partkey") % 7 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("l_suppkey")).alias("reseller_id"),
        F.col("o_orderpriority").alias("channel"),
        tickets.alias("tickets"),
        F.when(F.col("l_linenumber") % 5 == 0, F.col("l_extendedprice"))
         .otherwise(tickets * F.col("p_retailprice")).alias("amount"),
        F.to_date("o_orderdate").alias("createDate"),
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("updateDate"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("delFlag"),
    )


def f_platform_transaction(spark, sf_dir) -> DataFrame:
    s = f_sale(spark, sf_dir).filter(F.col("feed") == FEED_PLATFORM)
    return s.select(
        "TransId", "CustId", "EventId",
        F.col("channel").alias("Channel"),
        F.col("createDate").alias("CreateDate"),
        F.col("updateDate").alias("UpdateDate"),
        F.col("tickets").alias("TicketsCnt"),
        F.col("amount").alias("Amount"),
        "delFlag",
        F.col("reseller_id").alias("Reseller_id"),
    )


def _file_sales(spark, sf_dir, feed: str) -> DataFrame:
    s = f_sale(spark, sf_dir).filter(F.col("feed") == feed)
    c = f_customer(spark, sf_dir).select("CustId", "FirstName", "LastName")
    return s.join(c, "CustId")


def f_csv_sale(spark, sf_dir) -> DataFrame:
    """Reseller CSV feed rows in the reference's header layout, plus the file
    they travel in: one file per reseller on the run date (every tenth reseller
    files a day late)."""
    s = _file_sales(spark, sf_dir, FEED_CSV)
    file_res = F.coalesce(F.col("reseller_id"), F.col("l_suppkey"))
    file_day = F.when(F.abs(file_res) % 10 == 9, F.date_sub(F.lit(FILE_RUN_DATE), 1)) \
        .otherwise(F.lit(FILE_RUN_DATE))
    return s.select(
        F.col("TransId").cast("bigint").alias("Transaction ID"),
        F.col("eventName").alias("Event name"),
        F.col("tickets").alias("Number of purchased tickets"),
        F.col("amount").alias("Total amount"),
        F.col("channel").alias("Sales channel(office,web,mobile web)"),
        F.col("FirstName").alias("Customer first name"),
        F.col("LastName").alias("Customer last name"),
        F.col("officeLoc").alias("Office Location"),
        F.col("createDate").alias("Created_date"),
        F.concat(F.lit("DailySales_"), F.date_format(file_day, "MMdd"), F.lit("0"),
                 F.date_format(file_day, "yy"), F.lit("_"), file_res.cast("string"),
                 F.lit(".csv")).alias("source_file"),
    )


def f_xml_sale(spark, sf_dir) -> DataFrame:
    """Reseller XML feed rows in the nested layout of the reference."""
    s = _file_sales(spark, sf_dir, FEED_XML)
    return s.select(
        F.struct(F.date_format(F.lit(FILE_RUN_DATE), "yyyy-MM-dd").alias("date"),
                 F.col("reseller_id").cast("string").alias("reseller-id")).alias("transaction"),
        F.col("TransId").cast("bigint").alias("tranactionId"),
        "eventName",
        F.col("tickets").alias("numberOfPurchasedTickets"),
        F.col("amount").alias("totalAmount"),
        F.col("channel").alias("salesChannel"),
        F.struct(F.col("FirstName").alias("first_name"),
                 F.col("LastName").alias("last_name")).alias("Customer"),
        F.col("officeLoc").alias("officeLocation"),
        F.col("createDate").alias("dateCreated"),
    )


# ---------------------------------------------------------------- web-order mart

BROWSERS = ["Firefox", "Chrome", "Safari", "Edge"]   # fixed values of the fixture


def f_weblog(spark, sf_dir) -> DataFrame:
    """One web request per row of ``events``."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    ip = F.concat_ws(".",
                     (F.lit(10) + (uid * 7) % 210).cast("string"),
                     ((uid * 31) % 256).cast("string"),
                     ((uid * 17) % 256).cast("string"),
                     (uid % 256).cast("string"))
    agent = F.element_at(F.array(*[F.lit(b) for b in BROWSERS]), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(
        ip.alias("client_ip"),
        F.lit("-").alias("user_identity"),
        F.concat(F.lit("Customer#"), F.lpad(uid.cast("string"), 9, "0")).alias("user_name"),
        F.col("ts").alias("request_date"),
        F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET")).alias("request_type"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")).alias("request"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        (F.col("value") * 100).cast("bigint").alias("response_size"),
        F.lit("-").alias("referer"),
        agent.alias("user_agent"),
    )


def f_geo_location(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select((F.col("n_nationkey") + 1000).alias("geoname_id"), F.col("n_name").alias("country_name"))


def f_geo_block(spark, sf_dir) -> DataFrame:
    """Eight network blocks per nation: seven /8 and one /9 (lower half only, so
    the upper half of that octet has no country)."""
    n = table(spark, sf_dir, "nation")
    b = n.select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j"))
    octet = F.lit(10) + F.col("n_nationkey") * 8 + F.col("j")
    plen = F.when(F.col("j") == 7, F.lit(9)).otherwise(F.lit(8))
    return b.select(
        F.concat(octet.cast("string"), F.lit(".0.0.0/"), plen.cast("string")).alias("network"),
        (F.col("n_nationkey") + 1000).alias("geoname_id"),
    )


def f_geo_block_nested(spark, sf_dir) -> DataFrame:
    """The blocks of ``f_geo_block``, in each /8 a /10 of the next nation and in that a /12 of
    the one after, and one block over half of all addresses around them."""
    n = table(spark, sf_dir, "nation")
    b = n.select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("j"))
    octet = (F.lit(10) + F.col("n_nationkey") * 8 + F.col("j")).cast("string")
    inner = [b.select(F.concat(octet, F.lit(tail)).alias("network"), ((F.col("n_nationkey") + k) % 25 + 1000).alias("geoname_id"))
             for k, tail in ((1, ".64.0.0/10"), (2, ".80.0.0/12"))]
    wide = n.filter("n_nationkey = 24").select(F.lit("0.0.0.0/1").alias("network"), (F.col("n_nationkey") + 1000).alias("geoname_id"))
    return f_geo_block(spark, sf_dir).unionByName(inner[0]).unionByName(inner[1]).unionByName(wide)


def lossy_load(staged: DataFrame) -> DataFrame:
    """What a faulty load would have staged of ``(month_id, TransId)``: single ids are lost, some come
    that no source has, and one whole month is missing."""
    t = F.col("TransId")
    kept = staged.filter((t % 997 != 5) & (F.col("month_id") != 199803))
    return kept.unionByName(staged.filter(t % 1499 == 7).withColumn("TransId", t + 1_000_000_000_000))


def f_weblog6(spark, sf_dir) -> DataFrame:
    """Requests over IPv6: one per row of ``events``; every 50th address is malformed."""
    e = table(spark, sf_dir, "events")
    hexed = lambda c: F.lower(F.hex(c.cast("long")))
    ip = F.concat(F.lit("2001:db8:"), hexed(F.col("user_id") % 256), F.lit("::"), hexed(F.col("event_id") % 65536))
    return e.select("event_id", F.when(F.col("event_id") % 50 == 0, F.lit("2001:db8::1::2")).otherwise(ip).alias("client_ip"))


def f_geo_block6(spark, sf_dir) -> DataFrame:
    """A /45 block for each nation, and within it a /48 of the next nation."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("country_name"))
    hexed = lambda c: F.lower(F.hex(c))
    wide = n.select(F.concat(F.lit("2001:DB8:"), hexed(F.col("k") * 8), F.lit("::/45")).alias("network"), "country_name")
    inner = n.filter(F.col("k") > 0).select(F.concat(F.lit("2001:db8:"), hexed((F.col("k") - 1) * 8 + 3), F.lit(":0:0:0:0:0/48")).alias("network"),
                                            "country_name")
    return wide.unionByName(inner)


def f_web_customer(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("cust_document_no"),
        F.col("c_name").alias("customer_name"),
        _days_after(DOB_BASE, F.col("c_custkey") % 10000).cast("timestamp_ntz").alias("date_of_birth"),
        (ntz_literal(WEB_BASE)
         + F.make_dt_interval((F.col("c_custkey") % 31).cast("int"), (F.col("c_custkey") % 24).cast("int"))).alias("created_at"),
    )


def f_company(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("cuit_identifier"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("company_type"),
        (ntz_literal(WEB_BASE)
         + F.make_dt_interval(((F.col("c_custkey") + 7) % 31).cast("int"), (F.col("c_custkey") % 24).cast("int"))).alias("created_at"),
    )


def _products(spark, sf_dir, seller: bool) -> DataFrame:
    p = table(spark, sf_dir, "part")
    p = p.filter(F.col("p_size") <= 25) if seller else p.filter(F.col("p_size") > 25)
    return p.select(
        F.col("p_partkey").alias("prod_id"),
        (ntz_literal(WEB_BASE)
         + F.make_dt_interval((F.col("p_partkey") % 31).cast("int"), (F.col("p_partkey") % 24).cast("int"))).alias("created_at"),
    )


def f_seller_products(spark, sf_dir) -> DataFrame:
    return _products(spark, sf_dir, True)


def f_supplier_products(spark, sf_dir) -> DataFrame:
    return _products(spark, sf_dir, False)


def f_web_order(spark, sf_dir) -> DataFrame:
    """Every purchase event is a web order."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.when(F.col("user_id") % 3 == 0, F.lit("Company")).otherwise(F.lit("Customer")).alias("end_user_type"),
        F.when(F.col("user_id") % 2 == 0, F.lit("Seller")).otherwise(F.lit("Supplier")).alias("order_src_type"),
    )


def f_order_item(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("total_paid"),
    )


def date_span(spark, sf_dir) -> tuple[dt.date, dt.date]:
    """Calendar span of the warehouse: first order date to last ship date."""
    o = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("d")).select(F.to_date("d").alias("d"))
    li = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("d")).select(F.to_date("d").alias("d"))
    lo = o.collect()[0]["d"]
    hi = li.collect()[0]["d"]
    return lo, hi
