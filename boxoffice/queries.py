"""Named queries, one per operator of the inventory. Each takes
``(spark, sf_dir)`` and returns a DataFrame over the whole input tables (or
tables Spark derived from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice import fixtures as fx
from boxoffice.functions.columns import date_id, same_day
from boxoffice.operators import changes, checks, rules, schemadrift, setdiff, sketches, uniqueness
from boxoffice.operators.hotkeys import spread_join
from boxoffice.operators.keys import next_key_start, surrogate_key
from boxoffice.operators.lookups import left_lookup
from boxoffice.operators.rangejoin import ipv6_prefix_lookup
from boxoffice.plans import dims as dimplans
from boxoffice.plans import facts as factplans
from boxoffice.plans import pipeline
from boxoffice.plans import staging as stg
from boxoffice.plans import warehouse as wh
from boxoffice.plans import webmart as wm
from boxoffice.plans.martday import read_mart, run_mart_day
from boxoffice.sources import files
from boxoffice.sources.tables import LOAD_COL, read_table, staged_window, write_staging
from boxoffice.workspace import Workspace

WEB_DAY = fx.dt.date(2024, 1, 15)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn):
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(Workspace(spark, sf_dir))
    return fn


# ------------------------------------------------------------------ sources

@query
def incremental_pull(ws):
    return changes.incremental_pull(stg.source(ws, "transaction"), fx.CHANGE_DAY)


@query
def incremental_count(ws):
    return changes.incremental_pull(stg.source(ws, "transaction"), fx.CHANGE_DAY) \
        .agg(F.count(F.lit(1)).alias("cnt"))


@query
def csv_sales_scan(ws):
    return stg.csv_feed(ws)


@query
def xml_sales_scan(ws):
    raw = files.read_sales_xml(ws.spark, stg.xml_feed_path(ws))
    return raw.select("tranactionId", "eventName", "numberOfPurchasedTickets", "totalAmount",
                      "salesChannel", "officeLocation", "dateCreated",
                      F.col("transaction.date").alias("transaction_date"),
                      F.col("transaction.`reseller-id`").alias("transaction_reseller_id"),
                      F.col("Customer.first_name").alias("customer_first_name"),
                      F.col("Customer.last_name").alias("customer_last_name"))


@query
def weblog_scan(ws):
    return wh.weblog(ws)


@query
def staged_window_scan(ws):
    return staged_window(stg.staged(ws, "transaction"), fx.CHANGE_DAY)


@query
def current_lookup(ws):
    return stg.current(ws, "event")


@query
def calendar_dim(ws):
    return wh.calendar(ws)


# ------------------------------------------------------------------ sinks

@query
def staging_append_roundtrip(ws):
    """Write every day, then rerun one day: the rerun replaces its partition."""
    path = ws.path("roundtrip/staging_customer")
    versions = stg.source_versions(ws, "customer")
    write_staging(versions, path)
    write_staging(versions.filter(F.col(LOAD_COL) == F.lit(fx.CHANGE_DAY)), path)
    return read_table(ws.spark, path)


@query
def warehouse_append(ws):
    """K-2: append the reseller dimension to the shared warehouse table in two
    batches; a batch is written to its own partition, so a retried task or a
    repeated batch replaces rows instead of adding them twice."""
    path = ws.path("roundtrip/dwh_reseller")
    d = wh.dim(ws, "reseller")
    for batch in (0, 1, 1):
        write_staging(d.filter(F.col("row_wid") % 2 == batch).withColumn("batch", F.lit(batch)), path, "batch")
    return read_table(ws.spark, path).drop("batch")


def _customer_resync(ws) -> DataFrame:
    cur = stg.current(ws, "customer")
    return cur.select(F.col("CustId").alias("Src_cust_id"), F.col("FirstName").alias("Fname"),
                      F.col("LastName").alias("Lname"), "Pmail", "PhoneNo",
                      date_id("CreateDate").alias("createDt_id"),
                      date_id("UpdateDate").alias("UpdateDt_id"))


CUSTOMER_SET = ["Fname", "Lname", "Pmail", "PhoneNo", "UpdateDt_id"]


@query
def scd1_update(ws):
    """Re-apply current staged customers to the warehouse customer table;
    keys the table lacks are ignored."""
    return changes.scd1_update(wh.dim(ws, "customer"), _customer_resync(ws), ["Src_cust_id"], CUSTOMER_SET)


@query
def scd1_upsert(ws):
    """As ``scd1_update``, and customers the table lacks are inserted with new
    surrogate keys after the existing ones."""
    target = wh.dim(ws, "customer")
    upd = _customer_resync(ws)
    updated = changes.scd1_update(target, upd, ["Src_cust_id"], CUSTOMER_SET)
    new = upd.join(target.select("Src_cust_id"), "Src_cust_id", "left_anti")
    new = surrogate_key(new, ["Src_cust_id"], start=next_key_start(target))
    return updated.unionByName(new)


@query
def mark_reprocessed(ws):
    """Error table after a later run re-validates the open CSV errors: their
    errors are closed, renewed failures open new error rows."""
    return stg.reprocessed(ws, "csv")[1]


@query
def mark_reprocessed_xml(ws):
    return stg.reprocessed(ws, "xml")[1]


@query
def reprocess_staged_csv(ws):
    """Rejected CSV rows that pass when checked again, as they are staged."""
    return stg.reprocessed(ws, "csv")[0]


@query
def reprocess_staged_xml(ws):
    return stg.reprocessed(ws, "xml")[0]


@query
def rollback_day(ws):
    return changes.rollback_day(wh.fact_table(ws), int(fx.CHANGE_DAY.strftime("%Y%m%d")))


@query
def rollback_day_channel(ws):
    return changes.rollback_day_channel(wh.fact_table(ws), int(fx.CHANGE_DAY.strftime("%Y%m%d")),
                                        factplans.SOLD_BY_PLATFORM)


# ------------------------------------------------------------------ projections

@query
def xml_flatten(ws):
    return stg.xml_feed(ws)


@query
def insert_update_split(ws):
    st = stg.staged(ws, "transaction").select("TransId", LOAD_COL, "CreateDate", "UpdateDate")
    return changes.tag_insert_update(st)


@query
def same_day_filter(ws):
    o = fx.f_web_order(ws.spark, ws.sf_dir)
    return o.filter(same_day("created_at", WEB_DAY))


# ------------------------------------------------------------------ dimensions and facts

@query
def dim_customer_load(ws):
    return wh.build_dim(ws, "customer")


@query
def dim_reseller_load(ws):
    return wh.build_dim(ws, "reseller")


@query
def dim_venue_load(ws):
    return wh.build_dim(ws, "venue")


@query
def dim_location_load(ws):
    return wh.build_dim(ws, "location")


@query
def dim_event_load(ws):
    return wh.build_dim(ws, "event")


@query
def fact_platform_load(ws):
    return wh.platform_fact(ws)


@query
def fact_unknown_member(ws):
    """J-6: sales without a known reseller have the unknown member's key."""
    return wh.platform_fact(ws).filter((F.col("reseller_id") == factplans.UNKNOWN_RESELLER_KEY)
                                       & (F.col("commission") == factplans.NO_COMMISSION))


@query
def fact_platform_inner(ws):
    """The platform fact with INNER reseller and commission lookups, which leave
    out sales without a known reseller."""
    return wh.platform_fact(ws, unknown_member=False)


@query
def fact_same_day_update(ws):
    """Sales created and updated on one load day are in the fact."""
    return wh.platform_fact(ws).filter(F.col("createDt_id") == F.col("UpdateDt_id"))


@query
def fact_rerun_day(ws):
    """Loading a day again leaves the platform fact as it was."""
    day = stg.staged(ws, "transaction").filter(F.col(LOAD_COL) == F.lit(fx.CHANGE_DAY))
    loaded = wh.fact_table(ws).filter(F.col("sold_by") == factplans.SOLD_BY_PLATFORM)
    return factplans.load_platform_fact(day, wh.fact_dims(ws), existing=loaded)


@query
def dim_rerun_day(ws):
    """Loading every staged day again leaves each of the five dimensions as it was."""
    parts = []
    for name, spec in dimplans.SPECS.items():
        ctx = {"location": wh.dim(ws, "location"), "venue": wh.dim(ws, "venue")}
        again = dimplans.load_dimension(stg.staged(ws, name), wh.calendar(ws), spec, existing=wh.dim(ws, name), context=ctx)
        parts.append(again.select(F.lit(name).alias("entity"), "row_wid", F.col(spec.dwh_key).cast("bigint").alias("src_id"),
                                  "createDt_id", "UpdateDt_id"))
    return _union(parts)


@query
def dim_bucketed_load(ws):
    """The customer dimension after three loads, each rewriting the buckets of its keys."""
    house = pipeline.Warehouse(ws.spark, ws.path("roundtrip/buckets"))
    staged = stg.staged(ws, "customer")
    for first, end in ((1990, 199507), (199507, 199601), (199601, 209901)):
        month = F.year(LOAD_COL) * 100 + F.month(LOAD_COL)
        dim = pipeline.load_dimension_part(house, "customer", staged.filter((month >= first) & (month < end)), wh.calendar(ws))
    return dim


@query
def fact_csv_load(ws):
    return wh.csv_fact(ws)


@query
def fact_xml_load(ws):
    return wh.xml_fact(ws)


@query
def fact_all_channels(ws):
    return factplans.all_channels(wh.platform_fact(ws), wh.csv_fact(ws), wh.xml_fact(ws))


@query
def commission_lookup(ws):
    """J-5: current platform sales with the commission of (event, reseller)."""
    tx = stg.current(ws, "transaction").select("TransId", "EventId", "Reseller_id")
    com = stg.snapshot(ws, "commission").select("EvntId", "ResId", "Commission")
    return left_lookup(tx, com, [("EventId", "EvntId"), ("Reseller_id", "ResId")], "TransId") \
        .select("TransId", "EventId", "Reseller_id", "Commission")


# ------------------------------------------------------------------ aggregation

@query
def latest_per_key(ws):
    li = fx.table(ws.spark, ws.sf_dir, "lineitem")
    return changes.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def distinct_key_count(ws):
    return changes.distinct_key_count(stg.sales_source(ws), ["reseller_id"], "n_keys", by=["feed"])


@query
def surrogate_key_query(ws):
    c = fx.table(ws.spark, ws.sf_dir, "customer").select("c_custkey", "c_name")
    return surrogate_key(c, ["c_custkey"], "row_wid")


REGISTRY["surrogate_key"] = REGISTRY.pop("surrogate_key_query")


# ------------------------------------------------------------------ validation

@query
def count_gate(ws):
    return checks.count_gate(stg.source_versions(ws, "transaction"), stg.staged(ws, "transaction"))


@query
def non_empty_gate(ws):
    return checks.non_empty_gate({"csv": stg.csv_feed(ws), "xml": stg.xml_feed(ws), "weblog": wh.weblog(ws)})


@query
def schema_conformance(ws):
    raw = files.read_sales_csv(ws.spark, stg.csv_feed_path(ws), typed=False)
    return checks.schema_conformance(raw, files.CSV_SCHEMA)


@query
def schema_drift(ws):
    """V-3: the narrowest type of each column of each feed file, and whether it fits the declared one."""
    raw = files.read_sales_csv(ws.spark, stg.csv_feed_path(ws), typed=False).select("*", files.source_name())
    counts = schemadrift.type_counts(raw, ["source_file"], [f.name for f in files.CSV_SCHEMA.fields])
    return schemadrift.drift(schemadrift.narrowest(counts), files.CSV_SCHEMA) \
        .select("source_file", "column_name", "type_name", "declared", "nullable", "ok", "n_values")


@query
def column_presence(ws):
    return checks.column_presence(files.read_headers(ws.spark, stg.csv_feed_path(ws)), files.CSV_SCHEMA) \
        .select("column_name", "n_missing", "n_misplaced", "ok")


@query
def file_name_gate(ws):
    paths = files.list_files(ws.spark, stg.csv_feed_path(ws), "*.csv")
    return checks.file_name_gate(paths, stg.snapshot(ws, "reseller"), fx.FILE_RUN_DATE)


@query
def rule_flags(ws):
    return stg.csv_flags(ws)


@query
def hot_name_lookup(ws):
    """J-8 over a feed with half of its rows on one event name, dealt over many tasks."""
    feed = stg.csv_feed(ws).select("transID", F.when(F.col("transID") % 2 == 0, F.lit("Event#1")).otherwise(F.col("eventName")).alias("eventName"))
    events = stg.snapshot(ws, "event").select(F.col("EventName").alias("name"), "EventId", "TicketCost")
    return spread_join(feed, events, [("eventName", "name")], "left").drop("name")


@query
def valid_rows(ws):
    return rules.valid_rows(stg.csv_flags(ws))


@query
def quarantine_csv(ws):
    return rules.quarantine(stg.csv_flags(ws), fx.FILE_RUN_DATE)


@query
def quarantine_xml(ws):
    return rules.quarantine(stg.xml_flags(ws), fx.FILE_RUN_DATE)


@query
def reprocess_candidates(ws):
    return rules.reprocess_candidates(stg.csv_rows(ws), stg.csv_errors(ws))


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def reconcile_staging(ws):
    """V-7: every staged entity, every day."""
    return _union([checks.reconcile_days(stg.source_versions(ws, e), date_id(LOAD_COL), stg.staged(ws, e), date_id(LOAD_COL), keys)
                   .withColumn("entity", F.lit(e)) for e, (_, keys) in stg.ENTITIES.items()])


@query
def distinct_keys_by_month(ws):
    """A-2 over every month: distinct sales of the source and of a faulty load, from stored daily
    sketches; months that these leave open are counted again."""
    src = stg.source_versions(ws, "transaction").select("BatchId", "TransId")
    month = lambda day: (day / 100).cast("int")
    lossy = fx.lossy_load(stg.staged(ws, "transaction").select("BatchId", month(F.col("BatchId")).alias("month_id"), "TransId")).drop("month_id")
    stored = [ws.parquet(f"sketches/{name}", lambda rows=rows: sketches.daily_sketches(rows, "BatchId", ["TransId"], lg=8))
              for name, rows in (("source", src), ("lossy", lossy))]
    return sketches.gate_periods(*stored, src, lossy, "BatchId", month, ["TransId"], lg=8).withColumnRenamed("period", "month_id")


@query
def differing_keys(ws):
    """V-7: which sales of a month a faulty load lost, and which it has without a source."""
    month = (F.col("BatchId") / 100).cast("int").alias("month_id")
    src = stg.source_versions(ws, "transaction").select(month, "TransId")
    return setdiff.differing_keys(src, fx.lossy_load(stg.staged(ws, "transaction").select(month, "TransId")), ["month_id"], ["TransId"])


@query
def reconcile_file(ws):
    """V-7: both feeds."""
    return _union([checks.reconcile_file(feed(ws), staged(ws), errors(ws)).withColumn("feed", F.lit(kind))
                   for kind, feed, staged, errors in (("csv", stg.csv_rows, stg.staged_csv, stg.csv_errors),
                                                      ("xml", stg.xml_rows, stg.staged_xml, stg.xml_errors))])


@query
def reconcile_dwh(ws):
    """V-8: every dimension, every day."""
    return _union([checks.reconcile_per_day(stg.staged(ws, e), date_id(LOAD_COL), [spec.key], wh.dim(ws, e),
                                            ["createDt_id", "UpdateDt_id"]).withColumn("entity", F.lit(e))
                   for e, spec in dimplans.SPECS.items()])


@query
def reconcile_dwh_channel(ws):
    st = stg.staged(ws, "transaction").withColumn("sold_by", F.lit(factplans.SOLD_BY_PLATFORM))
    dwh = wh.fact_table(ws).filter(F.col("sold_by") == factplans.SOLD_BY_PLATFORM)
    return checks.reconcile_per_day(st, date_id(LOAD_COL), ["TransId"], dwh,
                                    ["createDt_id", "UpdateDt_id"], group_cols=["sold_by"])


@query
def reconcile_dwh_files(ws):
    """V-8 for the file channels: staged ids of each load day against the
    fact's ids of that day's batch."""
    both = _union([t(ws).select(F.lit(sold_by).alias("sold_by"), "BatchId", F.col("transID").alias("id"))
                   for t, sold_by in ((stg.staged_csv, factplans.SOLD_BY_CSV), (stg.staged_xml, factplans.SOLD_BY_XML))])
    return checks.reconcile_batches(both, wh.fact_table(ws).select("sold_by", "BatchId", F.col("src_trans_id").alias("id")))


@query
def duplicate_lookup_keys(ws):
    return checks.duplicate_lookup_keys(fx.f_event(ws.spark, ws.sf_dir, name_col="p_name"), ["EventName"])


@query
def repeated_keys(ws):
    """V-9: keys of the line items that are not unique, by the two-pass filter."""
    return uniqueness.repeated_keys(fx.table(ws.spark, ws.sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def weblog_load_check(ws):
    return checks.rows_per_day(wh.weblog(ws), "request_date")


# ------------------------------------------------------------------ web-order mart

@query
def mart_customer_load(ws):
    return wm.mart_customers(fx.f_web_customer(ws.spark, ws.sf_dir))


@query
def mart_company_load(ws):
    return wm.mart_companies(fx.f_company(ws.spark, ws.sf_dir))


@query
def product_dim_load(ws):
    return wm.product_dim(fx.f_seller_products(ws.spark, ws.sf_dir), fx.f_supplier_products(ws.spark, ws.sf_dir))


@query
def geoip_range_join(ws):
    s, d = ws.spark, ws.sf_dir
    return wm.request_country(wh.weblog(ws), fx.f_geo_block(s, d), fx.f_geo_location(s, d)) \
        .select("request", "client_ip", "country_name")


@query
def geoip_nested(ws):
    """J-9 over nested networks of all widths: the smallest one counts."""
    s, d = ws.spark, ws.sf_dir
    return wm.request_country(wh.weblog(ws), fx.f_geo_block_nested(s, d), fx.f_geo_location(s, d)) \
        .select("request", "client_ip", "country_name")


@query
def geoip_ipv6(ws):
    """J-9 over IPv6, nested blocks, malformed addresses reported."""
    s, d = ws.spark, ws.sf_dir
    return ipv6_prefix_lookup(fx.f_weblog6(s, d), "client_ip", fx.f_geo_block6(s, d), ["country_name"])


@query
def mart_two_days(ws):
    """The mart's customers and orders after two run dates, the second one run
    twice: keys go on from day to day."""
    s, d, root = ws.spark, ws.sf_dir, ws.path("roundtrip/mart")
    for day in (WEB_DAY, WEB_DAY + fx.dt.timedelta(days=1), WEB_DAY + fx.dt.timedelta(days=1)):
        run_mart_day(s, root, day, wh.weblog(ws), fx.f_geo_block(s, d), fx.f_geo_location(s, d), fx.f_web_customer(s, d),
                     fx.f_company(s, d), fx.f_seller_products(s, d), fx.f_supplier_products(s, d), fx.f_web_order(s, d),
                     fx.f_order_item(s, d))
    cust = read_mart(s, root, "customers").select(F.lit("customer").alias("entity"), LOAD_COL, F.col("customer_key").alias("key"),
                                                  F.col("cuit_identifier").cast("long").alias("src_id"))
    prod = read_mart(s, root, "products").select(F.lit("product").alias("entity"), LOAD_COL, F.col("product_key").alias("key"),
                                                 F.col("product_src_id").cast("long").alias("src_id"))
    return cust.unionByName(prod)


@query
def order_request_load(ws):
    s, d = ws.spark, ws.sf_dir
    return wm.order_requests(wh.weblog(ws), fx.f_geo_block(s, d), fx.f_geo_location(s, d))


@query
def conditional_left_join(ws):
    return wh.order_lines(ws).select("order_id", "order_item_id", "order_src_type", "c_name", "cp_name",
                                     "sp_prod_id", "slp_prod_id")


@query
def order_fact_load(ws):
    return wh.order_fact(ws)
