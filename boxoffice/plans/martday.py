"""The web-order mart's run date: the load check, the four dimensions of the day's
new rows, then the day's order fact. Each table is partitioned by load day; keys
go on after the largest key of the other days, and running a day again replaces
its rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.operators import checks
from boxoffice.plans import webmart as wm
from boxoffice.sources.tables import LOAD_COL, write_staging


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException:          # not written yet
        return None


def _load(spark: SparkSession, root: str, name: str, day: dt.date, make: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Write the day's rows of a table; ``make`` gets the table without the day."""
    old = read_mart(spark, root, name)
    others = None if old is None else old.filter(F.col(LOAD_COL) != F.lit(day)).drop(LOAD_COL)
    rows = make(others).withColumn(LOAD_COL, F.lit(day))
    write_staging(rows, f"{root}/{name}", day=day)
    return spark.read.schema(rows.schema).parquet(f"{root}/{name}").drop(LOAD_COL)


def run_mart_day(spark: SparkSession, root: str, day: dt.date, weblog: DataFrame, blocks: DataFrame, locations: DataFrame,
                 customers: DataFrame, companies: DataFrame, seller_products: DataFrame, supplier_products: DataFrame,
                 orders: DataFrame, items: DataFrame) -> None:
    """V-10, then L-5 to L-7 for one run date."""
    checks.assert_gate(checks.weblog_load_check(weblog, "request_date", day), what="weblog load check")
    cust = _load(spark, root, "customers", day, lambda old: wm.mart_customers(customers, day, old))
    comp = _load(spark, root, "company", day, lambda old: wm.mart_companies(companies, day, old))
    prod = _load(spark, root, "products", day, lambda old: wm.product_dim(seller_products, supplier_products, day, old))
    reqs = _load(spark, root, "order_request", day, lambda old: wm.order_requests(weblog, blocks, locations, day, old))
    lines = wm.order_lines(orders, items, customers, companies, seller_products, supplier_products, day)
    _load(spark, root, "orders", day, lambda old: wm.order_fact(lines, prod, cust, comp, reqs, old))
