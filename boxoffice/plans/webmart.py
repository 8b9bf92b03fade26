"""Web-order mart (L-5 … L-7, U-2, J-9 … J-12): mart dimensions from the day's
new rows, order requests with a geo-IP country, and the order fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.columns import business_key, same_day
from boxoffice.operators.checks import assert_gate
from boxoffice.operators.keys import next_key_start, surrogate_key
from boxoffice.operators.lookups import left_lookup
from boxoffice.operators.rangejoin import ip_range_lookup
from boxoffice.operators.uniqueness import repeated_keys

SELLER, SUPPLIER = "Seller", "Supplier"
CUSTOMER, COMPANY = "Customer", "Company"


def _day(df: DataFrame, ts: str, day: dt.date | None) -> DataFrame:
    """P-10 when a run date is given; every day otherwise (a backfill)."""
    return df if day is None else df.filter(same_day(ts, day))


def mart_customers(customers: DataFrame, day: dt.date | None = None, existing: DataFrame | None = None) -> DataFrame:
    """L-5: customers created on the run date, keyed in (day, id) order."""
    rows = _day(customers, "created_at", day).select(
        F.to_date("created_at").alias("_d"),
        F.col("cust_document_no").alias("cuit_identifier"), "customer_name",
        F.col("date_of_birth").alias("customer_DOB"))
    return surrogate_key(rows, ["_d", "cuit_identifier"], "customer_key",
                         start=next_key_start(existing, "customer_key")).drop("_d")


def mart_companies(companies: DataFrame, day: dt.date | None = None, existing: DataFrame | None = None) -> DataFrame:
    """L-5: companies created on the run date."""
    rows = _day(companies, "created_at", day).select(
        F.to_date("created_at").alias("_d"),
        F.col("cuit_identifier").alias("company_src_identifier"), "company_name", "company_type")
    return surrogate_key(rows, ["_d", "company_src_identifier"], "company_key",
                         start=next_key_start(existing, "company_key")).drop("_d")


def product_dim(seller: DataFrame, supplier: DataFrame, day: dt.date | None = None,
                existing: DataFrame | None = None) -> DataFrame:
    """U-2: supplier and seller products as one dimension with a type tag;
    within a day supplier products are keyed first, as they are loaded first."""
    def tagged(df, tag, rank):
        return _day(df, "created_at", day).select(
            F.to_date("created_at").alias("_d"), F.lit(rank).alias("_r"),
            F.col("prod_id").alias("product_src_id"), F.lit(tag).alias("product_src_type"))
    both = tagged(supplier, SUPPLIER, 0).unionByName(tagged(seller, SELLER, 1))
    return surrogate_key(both, ["_d", "_r", "product_src_id"], "product_key",
                         start=next_key_start(existing, "product_key")).drop("_d", "_r")


def geo_blocks(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Blocks with their country (INNER on geoname id)."""
    return blocks.join(locations, "geoname_id").select("network", "country_name")


def request_country(weblog: DataFrame, blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """J-9: every request with the country of the smallest network containing its
    address (NULL when none does); networks may nest."""
    return ip_range_lookup(weblog, "client_ip", geo_blocks(blocks, locations), ["country_name"], nested=True)


def order_requests(weblog: DataFrame, blocks: DataFrame, locations: DataFrame,
                   day: dt.date | None = None, existing: DataFrame | None = None) -> DataFrame:
    """L-6: one order request per web request of the day: business key
    ``user_name || request_date`` (F-5), browser and country."""
    rows = request_country(_day(weblog, "request_date", day), blocks, locations).select(
        "request_date", "request",
        business_key("user_name", "request_date").alias("req_src_id"),
        F.col("user_agent").alias("browser"), F.col("country_name").alias("country"))
    return surrogate_key(rows, ["request_date", "request"], "req_key",
                         start=next_key_start(existing, "req_key")).drop("request_date", "request")


def order_lines(orders: DataFrame, items: DataFrame, customers: DataFrame, companies: DataFrame,
                seller_products: DataFrame, supplier_products: DataFrame,
                day: dt.date | None = None) -> DataFrame:
    """J-10 + J-11: order header INNER items, then conditional LEFT joins: the
    customer and the seller product only for seller orders, the company and
    the supplier product only for supplier orders."""
    o = _day(orders, "created_at", day)
    j = o.join(items, "order_id")
    c = customers.select(F.col("cust_document_no").alias("_c_id"), F.col("customer_name").alias("c_name"))
    cp = companies.select(F.col("cuit_identifier").alias("_cp_id"), F.col("company_name").alias("cp_name"))
    sp = supplier_products.select(F.col("prod_id").alias("sp_prod_id"))
    slp = seller_products.select(F.col("prod_id").alias("slp_prod_id"))
    seller = F.col("order_src_type") == SELLER
    supplier = F.col("order_src_type") == SUPPLIER
    j = j.join(c, (F.col("customer_id") == F.col("_c_id")) & seller, "left")
    j = j.join(cp, (F.col("customer_id") == F.col("_cp_id")) & supplier, "left")
    j = j.join(sp, (F.col("item_id") == F.col("sp_prod_id")) & supplier, "left")
    j = j.join(slp, (F.col("item_id") == F.col("slp_prod_id")) & seller, "left")
    return j.drop("_c_id", "_cp_id")


def _unique(df: DataFrame, key: str, what: str) -> DataFrame:
    """A scalar lookup must not find two rows (J-12); fail like the database.
    NULL keys are never found, so they may repeat."""
    df = df.filter(F.col(key).isNotNull())
    dups = repeated_keys(df, [key]).limit(1).withColumn("ok", F.lit(False))
    assert_gate(dups, what=f"lookup {what} has repeated {key}")
    return df


def order_fact(lines: DataFrame, products: DataFrame, customers_dim: DataFrame,
               companies_dim: DataFrame, requests_dim: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """L-7 / J-12: order fact. The scalar lookups become LEFT joins on unique
    keys (checked first); the end user is the customer or the company by
    ``end_user_type``; order keys follow (order date, order, item, …)."""
    p = _unique(products, "product_src_id", "products").select(
        F.col("product_src_id").alias("_p_src"), "product_key")
    cu = _unique(customers_dim, "cuit_identifier", "customers").select(
        F.col("cuit_identifier").alias("_cu_src"), "customer_key")
    co = _unique(companies_dim, "company_src_identifier", "companies").select(
        F.col("company_src_identifier").alias("_co_src"), "company_key")
    rq = _unique(requests_dim, "req_src_id", "order requests").select(
        F.col("req_src_id").alias("_rq_src"), "req_key")
    j = lines.withColumn("_p_id", F.coalesce("sp_prod_id", "slp_prod_id")) \
        .withColumn("_rq_id", business_key(F.coalesce("c_name", "cp_name"), F.col("created_at")))
    for lookup, a, b in ((p, "_p_id", "_p_src"), (cu, "customer_id", "_cu_src"), (co, "customer_id", "_co_src"), (rq, "_rq_id", "_rq_src")):
        j = left_lookup(j, lookup, [(a, b)], "order_item_id")
    rows = j.select(
        F.col("created_at").alias("order_date"), "product_key", "end_user_type",
        F.when(F.col("end_user_type") == CUSTOMER, F.col("customer_key"))
         .otherwise(F.col("company_key")).alias("end_user_key"),
        F.col("req_key").alias("order_request_key"),
        F.col("order_id").alias("order_src_id"), F.col("order_item_id").alias("order_item_src_id"),
        F.col("quantity").alias("line_item_qty"), F.col("total_paid").alias("line_paid_amt"))
    order = ["order_date", "order_src_id", "order_item_src_id", "product_key", "end_user_type",
             "end_user_key", "order_request_key", "line_item_qty", "line_paid_amt"]
    return surrogate_key(rows, order, "order_key", start=next_key_start(existing, "order_key"))
