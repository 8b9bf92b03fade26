"""Warehouse state for one input directory: calendar, dimensions, facts and
the web-order mart, each written once to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from boxoffice import fixtures as fx
from boxoffice.plans import dims as dimplans
from boxoffice.plans import facts as factplans
from boxoffice.plans import staging as stg
from boxoffice.plans import webmart as wm
from boxoffice.sources.calendar import lookup_calendar
from boxoffice.sources.files import read_weblog
from boxoffice.workspace import Workspace

_SPANS: dict[str, tuple] = {}


def calendar(ws: Workspace) -> DataFrame:
    """Calendar over the data's span (first order day to last ship day)."""
    if ws.sf_dir not in _SPANS:
        _SPANS[ws.sf_dir] = fx.date_span(ws.spark, ws.sf_dir)
    lo, hi = _SPANS[ws.sf_dir]
    return lookup_calendar(ws.spark, lo, hi)


def build_dim(ws: Workspace, name: str) -> DataFrame:
    """Load a dimension from every staged day (backfill)."""
    ctx = {}
    if name == "event":
        ctx = {"location": dim(ws, "location"), "venue": dim(ws, "venue")}
    return dimplans.load_dimension(stg.staged(ws, name), calendar(ws), dimplans.SPECS[name], context=ctx)


def dim(ws: Workspace, name: str) -> DataFrame:
    return ws.parquet(f"dwh/{name}", lambda: build_dim(ws, name))


_DIMS: dict[tuple[str, str], factplans.Dims] = {}


def fact_dims(ws: Workspace) -> factplans.Dims:
    """Lookups for the fact loads. The tables behind them are written once,
    so the size-checked set is built once per session and shared."""
    key = (ws.spark.sparkContext.applicationId, ws.root)
    if key not in _DIMS:
        _DIMS[key] = factplans.Dims(event=dim(ws, "event"), customer=dim(ws, "customer"), venue=dim(ws, "venue"),
                                    location=dim(ws, "location"), reseller=dim(ws, "reseller"),
                                    commission=stg.snapshot(ws, "commission"), calendar=calendar(ws))
    return _DIMS[key]


def platform_fact(ws: Workspace, unknown_member: bool = True) -> DataFrame:
    return factplans.load_platform_fact(stg.staged(ws, "transaction"), fact_dims(ws), unknown_member)


def csv_fact(ws: Workspace) -> DataFrame:
    return factplans.load_file_fact(stg.staged_csv(ws), fact_dims(ws), factplans.SOLD_BY_CSV)


def xml_fact(ws: Workspace) -> DataFrame:
    return factplans.load_file_fact(stg.staged_xml(ws), fact_dims(ws), factplans.SOLD_BY_XML)


def fact_table(ws: Workspace) -> DataFrame:
    """The warehouse fact table after loading all three channels."""
    return ws.parquet("dwh/transaction",
                      lambda: factplans.all_channels(platform_fact(ws), csv_fact(ws), xml_fact(ws)))


# ---------------------------------------------------------------- web-order mart

def weblog(ws: Workspace) -> DataFrame:
    return read_weblog(ws.spark, stg.weblog_path(ws))


def mart(ws: Workspace, name: str) -> DataFrame:
    s, d = ws.spark, ws.sf_dir
    makers = {
        "customers": lambda: wm.mart_customers(fx.f_web_customer(s, d)),
        "company": lambda: wm.mart_companies(fx.f_company(s, d)),
        "products": lambda: wm.product_dim(fx.f_seller_products(s, d), fx.f_supplier_products(s, d)),
        "order_request": lambda: wm.order_requests(weblog(ws), fx.f_geo_block(s, d), fx.f_geo_location(s, d)),
    }
    return ws.parquet(f"mart/{name}", makers[name])


def order_lines(ws: Workspace) -> DataFrame:
    s, d = ws.spark, ws.sf_dir
    return wm.order_lines(fx.f_web_order(s, d), fx.f_order_item(s, d), fx.f_web_customer(s, d),
                          fx.f_company(s, d), fx.f_seller_products(s, d), fx.f_supplier_products(s, d))


def order_fact(ws: Workspace) -> DataFrame:
    return wm.order_fact(order_lines(ws), mart(ws, "products"), mart(ws, "customers"),
                         mart(ws, "company"), mart(ws, "order_request"))
