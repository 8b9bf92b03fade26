"""One run date end to end (``run_day``): staging pulls with schema and count
gates and reconciliation, reseller CSV and XML files with quarantine, reprocessing
of rejected rows, dimension loads, the three fact channels, and the warehouse
reconciliation of each dimension and channel, which rolls a day back before failing.
Running a day again leaves the tables as they were.

Tables live under one root (the caller's warehouse folder). Staging tables are
partitioned by load day and appended by dynamic partition overwrite; warehouse
tables are rewritten beside the old copy and swapped in, since Parquet has no
UPDATE. Readers must not overlap with a load of the same table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from boxoffice.functions.columns import date_id
from boxoffice.operators import changes, checks, rules, setdiff
from boxoffice.operators.keys import next_key_start
from boxoffice.plans import dims as dimplans
from boxoffice.plans import facts as factplans
from boxoffice.plans.staging import stage_valid
from boxoffice.sources import files
from boxoffice.sources.calendar import lookup_calendar
from boxoffice.sources.tables import LOAD_COL, by_partition_value, current_lookup, write_staging, writers_per_core

FACT_PART = "create_month"      # fact partitions: yyyymm of the sale's creation day
INTAKE, FIRST_CHECK, LATER_CHECK = "intake", 0, 1     # whether a file row was staged at its first check or a later one

STAGED_KEYS = {"customer": ["CustId"], "event": ["EventId"], "location": ["LocId"], "reseller": ["ResellerId"],
               "venue": ["VenueId"], "commission": ["EvntId", "ResId"], "transaction": ["TransId"]}
DIM_ORDER = ["venue", "reseller", "location", "customer", "event"]


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    #: Dimension tables are partitioned by a hash of their key into so many buckets.
    dim_buckets: int = 64

    @property
    def dim_part(self) -> str:
        return f"key_bucket_of_{self.dim_buckets}"

    def bucket(self, key: str):
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.dim_buckets)).cast("int")

    def path(self, kind: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}/{name}"

    def _fs(self, p: str):
        jvm = self.spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(p)
        return hp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hp

    def exists(self, p: str) -> bool:
        fs, hp = self._fs(p)
        return fs.exists(hp)

    def read(self, kind: str, name: str) -> DataFrame | None:
        """The table, or None when it does not exist or holds no files yet. A
        swap interrupted after the old copy was moved aside is undone first."""
        p = self.path(kind, name)
        fs, hp = self._fs(p)
        _, aside = self._fs(p + ".old")
        if not fs.exists(hp) and fs.exists(aside):
            self._rename(fs, aside, hp)
        _, parts_aside = self._fs(p + ".aside")
        if fs.exists(parts_aside):                  # partitions moved aside by a stopped swap
            for st in fs.listStatus(parts_aside):
                _, ht = self._fs(f"{p}/{st.getPath().getName()}")
                if not fs.exists(ht):
                    self._rename(fs, st.getPath(), ht)
            fs.delete(parts_aside, True)
        if not fs.exists(hp):
            return None
        try:
            return self.spark.read.parquet(p)
        except AnalysisException:
            return None

    def _rename(self, fs, old, new) -> None:
        """A Hadoop rename reports some failures by its result alone."""
        if not fs.rename(old, new):
            raise OSError(f"could not rename {old} to {new}")

    def _swap_in(self, target: str, new: str, aside_path: str | None = None) -> None:
        """Move ``new`` to ``target``: the old copy is renamed aside first and
        removed last, so a stop at any point leaves a complete table."""
        fs, ht = self._fs(target)
        _, hn = self._fs(new)
        _, aside = self._fs(aside_path or target + ".old")
        fs.mkdirs(aside.getParent())
        if fs.exists(aside):
            fs.delete(aside, True)
        if fs.exists(ht):
            self._rename(fs, ht, aside)
        fs.mkdirs(ht.getParent())
        self._rename(fs, hn, ht)
        if fs.exists(aside):
            fs.delete(aside, True)

    def replace(self, kind: str, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write the new state beside the old table, then swap it in."""
        p = self.path(kind, name)
        tmp = p + ".next"
        if partition_by:
            df = by_partition_value(df, partition_by)
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        with writers_per_core(self.spark):
            (w.partitionBy(partition_by) if partition_by else w).parquet(tmp)
        self._swap_in(p, tmp)
        return self.spark.read.parquet(p)

    def replace_partitions(self, kind: str, name: str, df: DataFrame, part_col: str,
                           values: list) -> None:
        """Rewrite only the partitions ``values`` of a partitioned table: the
        new rows of those partitions are written beside the table, then each
        partition folder is swapped in. Other partitions are not touched."""
        p = self.path(kind, name)
        tmp = p + ".next"
        with writers_per_core(self.spark):
            by_partition_value(df, part_col).write.mode("overwrite").option("partitionOverwriteMode", "static") \
                .partitionBy(part_col).parquet(tmp)
        fs, _ = self._fs(p)
        for v in values:
            target, new = f"{p}/{part_col}={v}", f"{tmp}/{part_col}={v}"
            _, hn = self._fs(new)
            _, ht = self._fs(target)
            if fs.exists(hn):
                # the old partition waits outside the table folder, where
                # partition discovery cannot see it
                self._swap_in(target, new, aside_path=f"{p}.aside/{part_col}={v}")
            elif fs.exists(ht):
                fs.delete(ht, True)          # every row of the partition was removed
        _, htmp = self._fs(tmp)
        fs.delete(htmp, True)
        _, haside = self._fs(p + ".aside")
        fs.delete(haside, True)


#: Entities whose current versions later steps look up.
LOOKUPS = ("event", "location", "reseller", "commission")


def stage_changes(wh: Warehouse, sources: dict[str, DataFrame], run_date: dt.date) -> None:
    """Entry 1: each source's rows created or updated on the run date, gated on
    schema, count and keys, appended to its staging table for the day; then the
    current versions of a looked-up entity are refreshed from that day alone."""
    for name, src in sources.items():
        own = changes.incremental_pull(src, run_date)
        declared = StructType([StructField(f.name, f.dataType, f.name not in STAGED_KEYS[name]) for f in src.schema.fields])
        checks.assert_gate(checks.schema_conformance(own, declared), what=f"schema of {name}")
        pulled = own.withColumn(LOAD_COL, F.lit(run_date)).withColumn("BatchId", date_id(LOAD_COL))
        p = wh.path("staging", name)
        write_staging(pulled, p, day=run_date)
        staged = wh.spark.read.schema(pulled.schema).parquet(p).filter(F.col(LOAD_COL) == F.lit(run_date))
        checks.assert_gate(checks.count_gate(own, staged), what=f"staging count {name}")
        checks.assert_gate(checks.reconcile_keys(own, staged, STAGED_KEYS[name]), what=f"staging keys {name}")
        if name in LOOKUPS:
            refresh_current(wh, name, staged)


def refresh_current(wh: Warehouse, name: str, day_rows: DataFrame) -> DataFrame:
    """Current version per key after a day: the previous current table plus
    the day's staged rows, reduced per key. The cost follows the size of the
    current table and the day, not of the whole staging history."""
    new = day_rows.drop(LOAD_COL, "BatchId")
    old = wh.read("current", name)
    both = new if old is None else old.unionByName(new)
    return wh.replace("current", name, current_lookup(both, STAGED_KEYS[name]))


def current(wh: Warehouse, name: str) -> DataFrame | None:
    return wh.read("current", name)


def _lookups(wh: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (current(wh, "event").select("EventName", "TicketCost", "CreateDate"), current(wh, "location").select("LocName"),
            current(wh, "reseller").select("ResellerId"))


def _write_errors(wh: Warehouse, kind: str, errors: DataFrame, run_date: dt.date) -> None:
    write_staging(errors.withColumn(LOAD_COL, F.lit(run_date)), wh.path("errors", kind), day=run_date)


def read_feed(wh: Warehouse, kind: str, drop_dir: str) -> DataFrame:
    return (files.read_sales_csv(wh.spark, drop_dir) if kind == "csv"
            else files.flatten_xml(files.read_sales_xml(wh.spark, drop_dir)))


STAGED_FILES = {"csv": "spreadsheet_transaction", "xml": "xml_transaction"}


def stage_files(wh: Warehouse, kind: str, drop_dir: str, run_date: dt.date) -> None:
    """Entry 2: reseller files of the run date, ``kind`` csv or xml: gates on
    names, columns, types and rows, then rules; valid rows to staging, failures
    to quarantine, and every id must be in one of the two."""
    events, locations, resellers = _lookups(wh)
    if kind == "csv":
        checks.assert_gate(checks.file_name_gate(files.list_files(wh.spark, drop_dir, "*.csv"), current(wh, "reseller"), run_date),
                           what="file name gate")
        checks.assert_gate(checks.column_presence(files.read_headers(wh.spark, drop_dir), files.CSV_SCHEMA), what="column gate")
        checks.assert_gate(checks.schema_conformance(files.read_sales_csv(wh.spark, drop_dir, typed=False), files.CSV_SCHEMA),
                           what="schema gate")
    feed = read_feed(wh, kind, drop_dir)
    if kind == "xml":
        declared = StructType([StructField(f.name, f.dataType, f.name not in ("transID", "eventName", "createDate"))
                               for f in feed.schema.fields])
        checks.assert_gate(checks.schema_conformance(feed, declared), what="schema gate")
    checks.assert_gate(checks.non_empty_gate({kind: feed}), ok_col="has_rows", what="file non-empty gate")
    flags = rules.rule_flags(feed, events, locations, run_date, resellers=resellers if kind == "xml" else None, hot_names=True).persist()
    try:
        staged = stage_valid(kind, flags, run_date).withColumn(INTAKE, F.lit(FIRST_CHECK))
        errors = rules.quarantine(flags, run_date)
        write_staging(staged, wh.path("staging", STAGED_FILES[kind]), day=run_date)
        _write_errors(wh, kind, errors, run_date)
        checks.assert_gate(checks.reconcile_file(feed, _day(wh, "staging", STAGED_FILES[kind], run_date, staged),
                                                 _day(wh, "errors", kind, run_date, errors)), what=f"{kind} file reconciliation")
    finally:
        flags.unpersist()


def stage_csv_files(wh: Warehouse, drop_dir: str, run_date: dt.date) -> None:
    stage_files(wh, "csv", drop_dir, run_date)


def stage_xml_files(wh: Warehouse, drop_dir: str, run_date: dt.date) -> None:
    stage_files(wh, "xml", drop_dir, run_date)


def _day(wh: Warehouse, kind: str, name: str, run_date: dt.date, like: DataFrame | None = None) -> DataFrame | None:
    """A table's rows of one load day (no rows of the shape of ``like``, if the
    table does not exist yet)."""
    t = wh.read(kind, name)
    if t is None:
        return None if like is None else like.limit(0)
    return t.filter(F.col(LOAD_COL) == F.lit(run_date))


def reprocess_files(wh: Warehouse, kind: str, feed: DataFrame, run_date: dt.date) -> None:
    """Rejected rows of earlier days, found again in ``feed``, are checked once
    more: rows that pass join the run date's staging, their open errors are
    closed, and renewed failures open new ones on the run date."""
    errors = wh.read("errors", kind)
    if errors is None:
        return
    earlier = errors.filter(F.col(LOAD_COL) < F.lit(run_date))
    # errors that an earlier try of this day closed are open to this one
    ours = F.coalesce(F.col("updateDt") == F.lit(run_date), F.lit(False))
    earlier = earlier.withColumn("reprocessed", F.when(ours, "N").otherwise(F.col("reprocessed"))) \
        .withColumn("updateDt", F.when(~ours, F.col("updateDt")))
    events, locations, resellers = _lookups(wh)
    candidates = rules.reprocess_candidates(feed, earlier).persist()
    try:
        again = rules.rule_flags(candidates, events, locations, run_date, resellers=resellers if kind == "xml" else None)
        passed = stage_valid(kind, again, run_date).withColumn(INTAKE, F.lit(LATER_CHECK))
        own = _day(wh, "staging", STAGED_FILES[kind], run_date, passed).filter(F.col(INTAKE) == FIRST_CHECK).select(passed.columns)
        closed = rules.mark_reprocessed(earlier, candidates, run_date)
        renewed = rules.quarantine(again, run_date).withColumn(LOAD_COL, F.lit(run_date))
        today = errors.filter(F.col(LOAD_COL) >= F.lit(run_date))
        new_staged = own.unionByName(passed)             # in place of an earlier try's passed rows
        # both are written beside the tables they read, then swapped in
        wh.replace_partitions("staging", STAGED_FILES[kind], new_staged, LOAD_COL, [run_date])
        wh.replace("errors", kind, closed.unionByName(today).unionByName(renewed), partition_by=LOAD_COL)
    finally:
        candidates.unpersist()


def load_dimension_part(wh: Warehouse, name: str, staged: DataFrame, cal: DataFrame, context: dict | None = None) -> DataFrame:
    """Load staged rows into a dimension table, rewriting only the buckets that hold their keys. A key's
    row, old or new, lies in its bucket, so the other buckets cannot change; only their largest
    surrogate key is read. A table of another layout is rewritten whole, once."""
    spec, part = dimplans.SPECS[name], wh.dim_part
    table = wh.read("dwh", name)
    if table is not None and part not in table.columns:
        plain = table.drop(*[c for c in table.columns if c.startswith("key_bucket_of_")])
        table = wh.replace("dwh", name, plain.withColumn(part, wh.bucket(spec.dwh_key)), partition_by=part)
    touched = sorted(r["b"] for r in staged.select(wh.bucket(spec.key).alias("b")).distinct().collect() if r["b"] is not None)
    if touched:
        old = None if table is None else table.filter(F.col(part).isin(touched)).drop(part)
        new = dimplans.load_dimension(staged, cal, spec, existing=old, context=context, start=next_key_start(table))
        wh.replace_partitions("dwh", name, new.withColumn(part, wh.bucket(spec.dwh_key)), part, touched)
        table = wh.read("dwh", name)
    return None if table is None else table.drop(part)


def load_warehouse(wh: Warehouse, run_date: dt.date, calendar_span: tuple[dt.date, dt.date]) -> None:
    """Entry 3: dimensions, then the three fact channels, for the run date."""
    cal = lookup_calendar(wh.spark, *calendar_span)
    loaded: dict[str, DataFrame] = {}
    for name in DIM_ORDER:
        staged = _day(wh, "staging", name, run_date)
        if staged is None:
            loaded[name] = wh.read("dwh", name)
            continue
        ctx = {"location": loaded.get("location"), "venue": loaded.get("venue")}
        loaded[name] = load_dimension_part(wh, name, staged, cal, ctx)
    com = current(wh, "commission")
    if any(loaded[n] is None for n in DIM_ORDER) or com is None:
        return
    d = factplans.Dims(loaded["event"], loaded["customer"], loaded["venue"], loaded["location"],
                       loaded["reseller"], com, cal)
    # The fact table is partitioned by creation month. A day's inserts land in
    # the months its rows were created in, as do its updates, and a file batch
    # loaded before is replaced where it lies. Only those months are rewritten.
    day = int(run_date.strftime("%Y%m%d"))
    old = wh.read("dwh", "transaction")
    tx = _day(wh, "staging", "transaction", run_date)
    feeds = {factplans.SOLD_BY_CSV: _day(wh, "staging", STAGED_FILES["csv"], run_date),
             factplans.SOLD_BY_XML: _day(wh, "staging", STAGED_FILES["xml"], run_date)}
    feeds = {k: v for k, v in feeds.items() if v is not None}
    created = [t.select(F.col(c).alias("d")) for t, c in [(tx, "CreateDate"), *((f, "createDate") for f in feeds.values())]
               if t is not None]
    months = set()
    for t in created:
        months |= {r.m for r in t.select((F.year("d") * 100 + F.month("d")).alias("m")).distinct().collect()}
    if old is not None:
        for sold_by in feeds:
            months |= {r[FACT_PART] for r in old.filter((F.col("sold_by") == sold_by) & (F.col("BatchId") == day))
                       .select(FACT_PART).distinct().collect()}
    months.discard(None)
    if not months:
        return
    fact = None if old is None else old.filter(F.col(FACT_PART).isin(sorted(months))).drop(FACT_PART)
    for sold_by, staged in feeds.items():
        rows = factplans.load_file_fact(staged, d, sold_by)
        fact = rows if fact is None else factplans.without_batch(fact, sold_by, day).unionByName(rows)
    if tx is not None:
        fact = factplans.load_platform_fact(tx, d, existing=fact)
    wh.replace_partitions("dwh", "transaction", fact.withColumn(FACT_PART, (F.col("createDt_id") / 100).cast("int")),
                          FACT_PART, sorted(months))


def reconcile_or_rollback(wh: Warehouse, run_date: dt.date) -> None:
    """V-8: staged keys of the day against warehouse rows of the day, for every
    dimension and channel, right after the load. On a mismatch the day's rows
    of that table or channel are removed, then the run fails."""
    day = int(run_date.strftime("%Y%m%d"))
    failed = []
    for name, spec in dimplans.SPECS.items():
        staged, dim = _day(wh, "staging", name, run_date), wh.read("dwh", name)
        if staged is None or dim is None:
            continue
        touched = dim.filter((F.col("createDt_id") == day) | (F.col("UpdateDt_id") == day))
        bad = checks.reconcile_per_day(staged, date_id(LOAD_COL), [spec.key], touched, ["createDt_id", "UpdateDt_id"]) \
            .filter((F.col("date_dim_id") == day) & ~F.col("ok")).collect()
        if bad:
            buckets = [r[wh.dim_part] for r in touched.select(wh.dim_part).distinct().collect()]
            if buckets:
                wh.replace_partitions("dwh", name, changes.rollback_day(dim.filter(F.col(wh.dim_part).isin(buckets)), day), wh.dim_part, buckets)
            failed.append((name, [r.asDict() for r in bad]))
    fact = wh.read("dwh", "transaction")
    tx = _day(wh, "staging", "transaction", run_date)
    if fact is not None and tx is not None:
        # months of the day's sales, from the small staged day: prunes the fact's folders
        months = [r.m for r in tx.select((F.year("CreateDate") * 100 + F.month("CreateDate")).alias("m")).distinct().collect()]
        touched = fact.filter(F.col(FACT_PART).isin(months) & (F.col("sold_by") == factplans.SOLD_BY_PLATFORM)
                              & ((F.col("createDt_id") == day) | (F.col("UpdateDt_id") == day)))
        rec = checks.reconcile_per_day(tx.withColumn("sold_by", F.lit(factplans.SOLD_BY_PLATFORM)), date_id(LOAD_COL), ["TransId"],
                                       touched, ["createDt_id", "UpdateDt_id"], group_cols=["sold_by"])
        bad = rec.filter((F.col("date_dim_id") == day) & ~F.col("ok")).collect()
        if bad:
            # which sales the two sides do not share, for the message
            differ = setdiff.differing_keys(tx.select("TransId"), touched.select(F.col("src_trans_id").alias("TransId")), [], ["TransId"])
            failed.append(("differing sales", [r.asDict() for r in differ.orderBy("side", "TransId").limit(20).collect()]))
            kept = changes.rollback_day_channel(fact.filter(F.col(FACT_PART).isin(months)), day, factplans.SOLD_BY_PLATFORM)
            wh.replace_partitions("dwh", "transaction", kept, FACT_PART, months)
            failed.append((factplans.SOLD_BY_PLATFORM, [r.asDict() for r in bad]))
    for sold_by, kind in ((factplans.SOLD_BY_CSV, "csv"), (factplans.SOLD_BY_XML, "xml")):
        staged, fact = _day(wh, "staging", STAGED_FILES[kind], run_date), wh.read("dwh", "transaction")
        if staged is None or fact is None:
            continue
        own = fact.filter((F.col("sold_by") == sold_by) & (F.col("BatchId") == day))
        bad = checks.reconcile_batches(staged.select(F.lit(sold_by).alias("sold_by"), "BatchId", F.col("transID").alias("id")),
                                       own.select("sold_by", "BatchId", F.col("src_trans_id").alias("id"))) \
            .filter(~F.col("ok")).collect()
        if bad:
            months = [r[FACT_PART] for r in own.select(FACT_PART).distinct().collect()]
            if months:
                kept = factplans.without_batch(fact.filter(F.col(FACT_PART).isin(months)), sold_by, day)
                wh.replace_partitions("dwh", "transaction", kept, FACT_PART, months)
            failed.append((sold_by, [r.asDict() for r in bad]))
    if failed:
        raise checks.GateError(f"warehouse reconciliation failed for {run_date}: {failed}")


def run_day(wh: Warehouse, sources: dict[str, DataFrame], run_date: dt.date, calendar_span: tuple[dt.date, dt.date],
            drop_dirs: dict[str, str] | None = None, earlier_dirs: dict[str, str] | None = None) -> None:
    """The whole run date. ``drop_dirs``: folder of the day's files by kind (csv,
    xml); ``earlier_dirs``: folder of the files whose rejected rows are due for
    another check."""
    stage_changes(wh, sources, run_date)
    for kind, folder in (drop_dirs or {}).items():
        stage_files(wh, kind, folder, run_date)
    for kind, folder in (earlier_dirs or {}).items():
        reprocess_files(wh, kind, read_feed(wh, kind, folder), run_date)
    load_warehouse(wh, run_date, calendar_span)
    reconcile_or_rollback(wh, run_date)
