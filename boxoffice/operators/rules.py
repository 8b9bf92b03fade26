"""Row rules, quarantine and reprocessing for reseller feeds (V-5, V-5b, V-6,
J-7, J-8, K-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.columns import flag
from boxoffice.operators.changes import scd1_update
from boxoffice.operators.hotkeys import spread_join
from boxoffice.operators.lookups import left_lookup, one_per_key
from boxoffice.sources.files import FEED_COLUMNS

# Error comments written to the quarantine table (fixed values of the format).
ERR_EVENT = "invalid_event"
ERR_LOCATION = "invalid_location"
ERR_AMOUNT = "invalid_ticket_amount"
ERR_DATE = "invalid_date"
ERR_RESELLER = "invalid_reseller"

RULE_COLUMNS = ["event_ok", "location_ok", "valid_ticket", "valid_date"]
ERROR_COLUMNS = ["transID", "comment", "reprocessed", "createDt", "updateDt"]


def rule_flags(feed: DataFrame, events: DataFrame, locations: DataFrame, run_date: dt.date,
               resellers: DataFrame | None = None, hot_names: bool = False) -> DataFrame:
    """V-5 / J-8: every feed row with one 0/1 flag per rule.

    Lookups are LEFT joins to lookups reduced to one row per key, in which NULL keys
    are spread; a NULL anywhere in a rule counts as failed. With ``hot_names`` event names are counted
    first (one more scan of the feed) and rows of hot ones are dealt over many tasks.
    ``events`` is (EventName, TicketCost, CreateDate), ``locations`` (LocName),
    ``resellers`` (ResellerId), all current versions.
    """
    ev = one_per_key(events, ["EventName"], ["CreateDate", "TicketCost"]).select(
        F.col("EventName").alias("_ev_name"), F.col("TicketCost").alias("_ev_cost"),
        F.col("CreateDate").alias("_ev_created"))
    loc = locations.select(F.col("LocName").alias("_loc_name")).distinct()
    names = [("eventName", "_ev_name")]
    j = spread_join(feed, ev, names, "left") if hot_names else left_lookup(feed, ev, names, "transID")
    j = left_lookup(j, loc, [("officeLoc", "_loc_name")], "transID")
    flags = [
        flag(F.col("_ev_name").isNotNull()).alias("event_ok"),
        flag(F.col("_loc_name").isNotNull()).alias("location_ok"),
    ]
    if resellers is not None:
        res = resellers.select(F.col("ResellerId").alias("_res_id")).distinct()
        j = left_lookup(j.withColumn("_res_key", F.col("reseller_id").try_cast("bigint")), res, [("_res_key", "_res_id")], "transID")
        flags.append(flag(F.col("_res_id").isNotNull()).alias("reseller_ok"))
    flags += [
        flag(F.col("Amount") == F.col("Purchased_ticket") * F.col("_ev_cost")).alias("valid_ticket"),
        flag(F.col("createDate").between(F.col("_ev_created"), F.lit(run_date))).alias("valid_date"),
    ]
    return j.select(*feed.columns, *flags)


def _rule_cols(flags: DataFrame) -> list[str]:
    return [c for c in ["event_ok", "location_ok", "reseller_ok", "valid_ticket", "valid_date"]
            if c in flags.columns]


def valid_rows(flags: DataFrame) -> DataFrame:
    """V-5b: rows passing every rule, in the feed layout."""
    cond = None
    for c in _rule_cols(flags):
        cond = (F.col(c) == 1) if cond is None else cond & (F.col(c) == 1)
    keep = [c for c in flags.columns if c not in _rule_cols(flags)]
    return flags.filter(cond).select(*keep)


def quarantine(flags: DataFrame, run_date: dt.date) -> DataFrame:
    """V-6: one error row per failed rule, from one scan of the flagged feed:
    the failed rules of a row become an array that is exploded. An unknown event
    also fails the amount and date rules, so it yields three rows."""
    comments = {"event_ok": ERR_EVENT, "location_ok": ERR_LOCATION, "reseller_ok": ERR_RESELLER,
                "valid_ticket": ERR_AMOUNT, "valid_date": ERR_DATE}
    failed = F.array(*[F.when(F.col(c) == 0, F.lit(comments[c])) for c in _rule_cols(flags)])
    return flags.select(
        F.col("transID"),
        F.explode(F.filter(failed, lambda x: x.isNotNull())).alias("comment"),
        F.lit("N").alias("reprocessed"),
        F.lit(run_date).alias("createDt"),
        F.lit(None).cast("date").alias("updateDt"),
    )


def open_errors(errors: DataFrame) -> DataFrame:
    """S-9: ids of errors not yet reprocessed."""
    return errors.filter(F.col("reprocessed") == "N").select("transID")


def reprocess_candidates(feed: DataFrame, errors: DataFrame) -> DataFrame:
    """J-7: feed rows that were rejected before and not yet reprocessed. A
    semi join, so a row with several errors is taken once."""
    return feed.join(open_errors(errors), "transID", "left_semi")


def mark_reprocessed(errors: DataFrame, candidates: DataFrame, run_date: dt.date) -> DataFrame:
    """K-5: set ``reprocessed='Y'`` (and the update date) on the open errors of
    every re-validated row; closed errors stay as they are."""
    ids = candidates.select("transID").distinct().select(
        "transID", F.lit("Y").alias("reprocessed"), F.lit(run_date).alias("updateDt"))
    return scd1_update(errors, ids, ["transID"], ["reprocessed", "updateDt"],
                       target_match=errors["reprocessed"] == "N")


def feed_columns(df: DataFrame) -> list[str]:
    return [c for c in FEED_COLUMNS if c in df.columns]
