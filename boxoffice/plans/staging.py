"""Staging loads: daily change pulls and reseller files into staging tables,
with quarantine of rejected file rows (entries 1 and 2 of the pipeline)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice import fixtures as fx
from boxoffice.functions.columns import date_id
from boxoffice.operators import rules
from boxoffice.sources import files
from boxoffice.sources.tables import LOAD_COL, change_versions, current_lookup
from boxoffice.workspace import Workspace

# entity -> (stand-in builder, natural key)
ENTITIES = {
    "customer": (fx.f_customer, ["CustId"]),
    "event": (fx.f_event, ["EventId"]),
    "location": (fx.f_location, ["LocId"]),
    "reseller": (fx.f_reseller, ["ResellerId"]),
    "venue": (fx.f_venue, ["VenueId"]),
    "commission": (fx.f_commission, ["EvntId", "ResId"]),
    "transaction": (fx.f_platform_transaction, ["TransId"]),
}


def with_batch(df: DataFrame) -> DataFrame:
    """P-6: stamp the batch id (the load day as ``yyyymmdd``)."""
    return df.withColumn("BatchId", date_id(LOAD_COL))


def source(ws: Workspace, entity: str) -> DataFrame:
    """The entity's source table (current state), written once from the
    stand-in definition; pulls filter it with pushed-down predicates, as the
    reference's pulls filter inside the database."""
    make, _ = ENTITIES[entity]
    return ws.parquet(f"source/{entity}", lambda: make(ws.spark, ws.sf_dir))


def sales_source(ws: Workspace) -> DataFrame:
    """All sales of the three channels as one source table."""
    return ws.parquet("source/sale", lambda: fx.f_sale(ws.spark, ws.sf_dir))


def source_versions(ws: Workspace, entity: str) -> DataFrame:
    """Every daily change pull of an entity, derived from its current state."""
    return with_batch(change_versions(source(ws, entity)))


def staged(ws: Workspace, entity: str) -> DataFrame:
    """Staging table of an entity (append-only, partitioned by load day)."""
    return ws.parquet(f"staging/{entity}", lambda: source_versions(ws, entity), partition_by=LOAD_COL)


def current(ws: Workspace, entity: str) -> DataFrame:
    """S-6: current version per key of a staged entity."""
    _, keys = ENTITIES[entity]
    return current_lookup(staged(ws, entity), keys).drop("BatchId")


def snapshot(ws: Workspace, entity: str) -> DataFrame:
    """Current versions of an entity written as one small table, refreshed
    after each staging load; lookups read this instead of re-deriving it
    from every staged day."""
    return ws.parquet(f"current/{entity}", lambda: current(ws, entity))


# ---------------------------------------------------------------- reseller files

#: Feed files of a drop folder. A listed file takes about 1.4 KB of the driver's memory, so
#: folders are listed one after the other.
FILES_A_FOLDER = 16_384


def csv_feed_path(ws: Workspace) -> str:
    def build(p: str) -> None:
        resellers = fx.f_reseller(ws.spark, ws.sf_dir).count()
        files.write_sales_csv(fx.f_csv_sale(ws.spark, ws.sf_dir), p, folders=-(-max(1, resellers) // FILES_A_FOLDER))
    return ws.ensure("feeds/csv", build)


def xml_feed_path(ws: Workspace) -> str:
    """XML is mostly tags and white space: compressed, it takes a tenth of the disk or less."""
    return ws.ensure("feeds/xml", lambda p: files.write_sales_xml(fx.f_xml_sale(ws.spark, ws.sf_dir), p, compression="gzip"))


def weblog_path(ws: Workspace) -> str:
    return ws.ensure("feeds/weblog", lambda p: files.write_weblog(fx.f_weblog(ws.spark, ws.sf_dir), p))


def csv_feed(ws: Workspace) -> DataFrame:
    """S-3: all CSV feed rows, renamed, with the feed file they came from."""
    return files.read_sales_csv(ws.spark, csv_feed_path(ws))


def xml_feed(ws: Workspace) -> DataFrame:
    """S-4 + P-5: all XML feed rows, flattened."""
    return files.flatten_xml(files.read_sales_xml(ws.spark, xml_feed_path(ws)))


def csv_rows(ws: Workspace) -> DataFrame:
    """All rows of ``csv_feed``, landed: the files are read once, one drop folder at a time, so the
    driver never holds the listing of more."""
    def build(p: str) -> None:
        top = csv_feed_path(ws)
        for i, folder in enumerate(ws.folders(f"{top}/drop=*") or [top]):
            files.read_sales_csv(ws.spark, folder).write.mode("append" if i else "overwrite").parquet(p)
    return ws.table(ws.ensure("landed/csv", build))


def xml_rows(ws: Workspace) -> DataFrame:
    """All rows of ``xml_feed``, landed: the files are parsed once."""
    return ws.parquet("landed/xml", lambda: xml_feed(ws))


def file_reseller(source_file: str = "source_file"):
    return F.regexp_extract(F.col(source_file), files.SALES_FILE_PATTERN, 4).try_cast("bigint")


def lookups(ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current events, locations and resellers as the rules read them."""
    return (snapshot(ws, "event").select("EventName", "TicketCost", "CreateDate"),
            snapshot(ws, "location").select("LocName"),
            snapshot(ws, "reseller").select("ResellerId"))


def csv_flags(ws: Workspace, run_date: dt.date = fx.FILE_RUN_DATE) -> DataFrame:
    ev, loc, _ = lookups(ws)
    return rules.rule_flags(csv_rows(ws), ev, loc, run_date)


def xml_flags(ws: Workspace, run_date: dt.date = fx.FILE_RUN_DATE) -> DataFrame:
    ev, loc, res = lookups(ws)
    return rules.rule_flags(xml_rows(ws), ev, loc, run_date, resellers=res)


def _stage_valid_csv(flags: DataFrame, run_date: dt.date) -> DataFrame:
    v = rules.valid_rows(flags)
    return v.select(*rules.feed_columns(v), file_reseller().alias("Reseller_id"),
                    F.lit(run_date).alias(LOAD_COL)).withColumn("BatchId", date_id(LOAD_COL))


def _stage_valid_xml(flags: DataFrame, run_date: dt.date) -> DataFrame:
    v = rules.valid_rows(flags)
    return v.select(*rules.feed_columns(v), F.col("reseller_id").cast("bigint").alias("Reseller_id"),
                    F.lit(run_date).alias(LOAD_COL)).withColumn("BatchId", date_id(LOAD_COL))


def stage_valid(kind: str, flags: DataFrame, run_date: dt.date) -> DataFrame:
    """The valid rows of a flagged feed, ``kind`` csv or xml, as they are staged."""
    return _stage_valid_csv(flags, run_date) if kind == "csv" else _stage_valid_xml(flags, run_date)


def staged_csv(ws: Workspace) -> DataFrame:
    """Staging table of valid CSV sales for the file run date."""
    return ws.parquet("staging/spreadsheet_transaction",
                      lambda: _stage_valid_csv(csv_flags(ws), fx.FILE_RUN_DATE), partition_by=LOAD_COL)


def staged_xml(ws: Workspace) -> DataFrame:
    """Staging table of valid XML sales for the file run date (the valid rows,
    not every row)."""
    return ws.parquet("staging/xml_transaction",
                      lambda: _stage_valid_xml(xml_flags(ws), fx.FILE_RUN_DATE), partition_by=LOAD_COL)


def csv_errors(ws: Workspace) -> DataFrame:
    """Quarantine table of the CSV feed after the file run date."""
    return ws.parquet("errors/csv", lambda: rules.quarantine(csv_flags(ws), fx.FILE_RUN_DATE))


def xml_errors(ws: Workspace) -> DataFrame:
    """Quarantine table of the XML feed after the file run date."""
    return ws.parquet("errors/xml", lambda: rules.quarantine(xml_flags(ws), fx.FILE_RUN_DATE))


def reprocessed(ws: Workspace, kind: str, run_date: dt.date = fx.REPROCESS_DATE) -> tuple[DataFrame, DataFrame]:
    """J-7 for a whole feed: rows rejected before and not yet reprocessed, checked
    again on ``run_date``: what now passes, as staged, and the new error table."""
    feed, errors = (csv_rows(ws), csv_errors(ws)) if kind == "csv" else (xml_rows(ws), xml_errors(ws))
    ev, loc, res = lookups(ws)
    return reprocess(feed, errors, ev, loc, res if kind == "xml" else None, run_date)


def reprocess(feed: DataFrame, errors: DataFrame, events: DataFrame, locations: DataFrame,
              resellers: DataFrame | None, run_date: dt.date) -> tuple[DataFrame, DataFrame]:
    """The rows of ``feed`` to stage for ``run_date``, and the error table with the
    rows' open errors closed and their renewed failures added. XML feeds carry
    their reseller and are checked against ``resellers``; CSV feeds are named
    after theirs."""
    candidates = rules.reprocess_candidates(feed, errors)
    again = rules.rule_flags(candidates, events, locations, run_date, resellers=resellers)
    staged = stage_valid("csv" if resellers is None else "xml", again, run_date)
    marked = rules.mark_reprocessed(errors, candidates, run_date)
    return staged, marked.unionByName(rules.quarantine(again, run_date), allowMissingColumns=True)
