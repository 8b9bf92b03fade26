"""Warehouse dimension loads (L-1, L-2): one enriched row per natural key with
a dense surrogate key, role-playing calendar ids, and type-1 updates applied as
set-based joins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.operators.changes import (created_on_load_day, first_per_key, insert_update_split,
                                         latest_per_key, scd1_update)
from boxoffice.operators.keys import next_key_start, surrogate_key
from boxoffice.operators.lookups import date_role, left_lookup
from boxoffice.sources.tables import LOAD_COL


@dataclass
class DimSpec:
    key: str                                  # natural key in staging
    dwh_key: str                              # its warehouse name
    columns: dict[str, str]                   # warehouse name -> staging column
    set_cols: list[str]                       # columns an update overwrites
    update_date_join: str = "left"            # update branch: calendar join on UpdateDate
    roles: dict[str, str] = field(default_factory=lambda: {"CreateDate": "createDt_id",
                                                           "UpdateDate": "UpdateDt_id"})
    extra: Callable[[DataFrame, dict], DataFrame] | None = None   # more lookups (event)
    extra_cols: list[str] = field(default_factory=list)


def _role_joins(df: DataFrame, calendar: DataFrame, spec: DimSpec, update_how: str) -> DataFrame:
    for date_col, out in spec.roles.items():
        how = {"CreateDate": "inner", "UpdateDate": update_how}.get(date_col, "left")
        df = date_role(df, calendar, date_col, out, how)
    return df


def _project(df: DataFrame, spec: DimSpec) -> DataFrame:
    cols = [F.col(src).alias(dst) for dst, src in spec.columns.items()]
    cols += [F.col(r) for r in spec.roles.values()] + [F.col(c) for c in spec.extra_cols]
    return df.select(*cols, F.col(LOAD_COL))


def load_dimension(staged: DataFrame, calendar: DataFrame, spec: DimSpec,
                   existing: DataFrame | None = None, context: dict | None = None, start: int | None = None) -> DataFrame:
    """Load the staged days of a dimension. ``existing`` may be the part of the table that can hold
    the staged keys; ``start`` is then the largest surrogate key of the whole table.

    * per day, one version per key (A-3);
    * versions created on their load day, updated since or not, are inserts if
      the table lacks the key, so a rerun of a day adds nothing: calendar ids
      (create INNER, update LEFT), surrogate keys in (load day, key) order
      after the existing ones;
    * updated versions overwrite ``set_cols`` of the row with the same key,
      the last day's update winning; a key not in the table is not inserted
      (type-1 update, K-4).
    """
    per_day = latest_per_key(staged, [spec.key, LOAD_COL], ["UpdateDate", "CreateDate"])
    upd = insert_update_split(per_day)[1]
    ins = first_per_key(per_day.filter(created_on_load_day()), spec.key)
    if existing is not None:
        known = existing.select(F.col(spec.dwh_key).alias("_known"))
        ins = ins.join(known, F.col(spec.key) == F.col("_known"), "left_anti")
    ctx = context or {}

    def enrich(df: DataFrame, update_how: str) -> DataFrame:
        df = _role_joins(df, calendar, spec, update_how)
        if spec.extra:
            df = spec.extra(df, ctx)
        return _project(df, spec)

    start = next_key_start(existing) if start is None else start
    new_rows = surrogate_key(enrich(ins, "left"), [LOAD_COL, spec.dwh_key], start=start).drop(LOAD_COL)
    target = new_rows if existing is None else existing.unionByName(new_rows)
    updates = latest_per_key(enrich(upd, spec.update_date_join), [spec.dwh_key], [LOAD_COL])
    return scd1_update(target, updates.drop(LOAD_COL), [spec.dwh_key], spec.set_cols)


CUSTOMER = DimSpec(
    key="CustId", dwh_key="Src_cust_id",
    columns={"Src_cust_id": "CustId", "Fname": "FirstName", "Lname": "LastName",
             "Pmail": "Pmail", "PhoneNo": "PhoneNo"},
    set_cols=["Fname", "Lname", "Pmail", "PhoneNo", "UpdateDt_id"],
    update_date_join="inner")

VENUE = DimSpec(
    key="VenueId", dwh_key="src_Venue_id",
    columns={"src_Venue_id": "VenueId", "venue_name": "VenueName"},
    set_cols=["venue_name", "UpdateDt_id"])

RESELLER = DimSpec(
    key="ResellerId", dwh_key="src_res_id",
    columns={"src_res_id": "ResellerId", "fName": "FirstName", "lName": "LastName"},
    set_cols=["fName", "lName", "UpdateDt_id"])

LOCATION = DimSpec(
    key="LocId", dwh_key="src_loc_id",
    columns={"src_loc_id": "LocId", "Loc_name": "LocName", "StAddress": "StAddress", "City": "City",
             "Province": "Province", "Region": "Region", "Country": "Country", "PstCd": "PstCd"},
    set_cols=["UpdateDt_id", "Loc_name"])


def _event_lookups(df: DataFrame, ctx: dict) -> DataFrame:
    """J-2: location and venue surrogate keys, LEFT."""
    loc = ctx["location"].select(F.col("src_loc_id").alias("_lk"),
                                                   F.col("row_wid").alias("LocKey"))
    vnu = ctx["venue"].select(F.col("src_Venue_id").alias("_vk"),
                                                F.col("row_wid").alias("VenueKey"))
    return left_lookup(left_lookup(df, loc, [("LocId", "_lk")], "EventId"), vnu, [("VenueId", "_vk")], "EventId")


EVENT = DimSpec(
    key="EventId", dwh_key="src_event_id",
    columns={"src_event_id": "EventId", "event_name": "EventName", "event_type": "EventType",
             "ticket_cost": "TicketCost", "LocId": "LocKey", "Venue_id": "VenueKey"},
    set_cols=["UpdateDt_id", "startDt_id", "endDt_id", "event_name"],
    update_date_join="inner",
    roles={"CreateDate": "createDt_id", "UpdateDate": "UpdateDt_id",
           "StartDate": "startDt_id", "EndDate": "endDt_id"},
    extra=_event_lookups)

SPECS = {"customer": CUSTOMER, "venue": VENUE, "reseller": RESELLER, "location": LOCATION, "event": EVENT}
