import datetime as dt

import pytest

from boxoffice.operators import checks, rules
from boxoffice.sources.files import CSV_SCHEMA

D = dt.date
FEED = ("transID int, eventName string, Purchased_ticket int, Amount double, channel string, "
        "custFirstName string, custLastName string, officeLoc string, createDate date")


@pytest.fixture()
def lookups(spark):
    ev = spark.createDataFrame([("E1", 10.0, D(1999, 1, 1))], "EventName string, TicketCost double, CreateDate date")
    loc = spark.createDataFrame([("Paris",)], "LocName string")
    return ev, loc


def _feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def test_unknown_event_fails_three_rules(spark, lookups):
    ev, loc = lookups
    feed = _feed(spark, [(1, "nope", 2, 20.0, "web", "a", "b", "Paris", D(1999, 6, 1))])
    flags = rules.rule_flags(feed, ev, loc, D(2000, 1, 1))
    errs = sorted(r.comment for r in rules.quarantine(flags, D(2000, 1, 1)).collect())
    assert errs == ["invalid_date", "invalid_event", "invalid_ticket_amount"]


def test_null_amount_fails_amount_rule_and_valid_row_passes(spark, lookups):
    ev, loc = lookups
    feed = _feed(spark, [(1, "E1", 2, None, "web", "a", "b", "Paris", D(1999, 6, 1)),
                         (2, "E1", 2, 20.0, "web", "a", "b", "Paris", D(1999, 6, 1))])
    flags = rules.rule_flags(feed, ev, loc, D(2000, 1, 1))
    byid = {r.transID: r for r in flags.collect()}
    assert byid[1].valid_ticket == 0 and byid[2].valid_ticket == 1
    assert [r.transID for r in rules.valid_rows(flags).collect()] == [2]
    q = rules.quarantine(flags, D(2000, 1, 1)).collect()
    assert [(r.transID, r.comment, r.reprocessed) for r in q] == [(1, "invalid_ticket_amount", "N")]


def test_duplicate_lookup_name_does_not_multiply_rows(spark, lookups):
    _, loc = lookups
    ev = spark.createDataFrame([("E1", 10.0, D(1999, 1, 1)), ("E1", 12.0, D(1999, 1, 2))],
                               "EventName string, TicketCost double, CreateDate date")
    feed = _feed(spark, [(1, "E1", 1, 12.0, "web", "a", "b", "Paris", D(1999, 6, 1))])
    assert rules.rule_flags(feed, ev, loc, D(2000, 1, 1)).count() == 1
    assert checks.duplicate_lookup_keys(ev, ["EventName"]).collect()[0].n == 2


def test_reprocess_marks_open_errors_only(spark):
    errors = spark.createDataFrame([(1, "invalid_date", "N", D(2000, 1, 1), None),
                                    (1, "invalid_event", "Y", D(1999, 1, 1), D(1999, 2, 1)),
                                    (2, "invalid_date", "N", D(2000, 1, 1), None)],
                                   "transID int, comment string, reprocessed string, createDt date, updateDt date")
    feed = spark.createDataFrame([(1,), (3,)], "transID int")
    cand = rules.reprocess_candidates(feed, errors)
    assert [r.transID for r in cand.collect()] == [1]
    out = sorted((r.transID, r.comment, r.reprocessed, r.updateDt)
                 for r in rules.mark_reprocessed(errors, cand, D(2002, 1, 1)).collect())
    assert out == [(1, "invalid_date", "Y", D(2002, 1, 1)), (1, "invalid_event", "Y", D(1999, 2, 1)),
                   (2, "invalid_date", "N", None)]


def test_count_gate_raises_on_mismatch(spark):
    ok = checks.count_gate(spark.range(3), spark.range(3))
    checks.assert_gate(ok)
    bad = checks.count_gate(spark.range(3), spark.range(2))
    with pytest.raises(checks.GateError):
        checks.assert_gate(bad)


def test_reconcile_mismatch_rolls_back_then_raises(spark):
    from boxoffice.operators.changes import rollback_day
    from pyspark.sql import functions as F
    staged = spark.createDataFrame([(1, D(2000, 1, 1)), (2, D(2000, 1, 1))], "k int, load_date date")
    dwh = spark.createDataFrame([(1, 20000101, None), (9, 19991231, None)], "k int, createDt_id int, UpdateDt_id int")
    rec = checks.reconcile_per_day(staged, (F.year("load_date") * 10000 + F.month("load_date") * 100
                                            + F.dayofmonth("load_date")).cast("int"), ["k"],
                                   dwh, ["createDt_id", "UpdateDt_id"])
    bad = rec.filter("not ok").orderBy("date_dim_id").collect()
    assert [(r.date_dim_id, r.src_cnt, r.dst_cnt) for r in bad] == [(19991231, 0, 1), (20000101, 2, 1)]
    kept = rollback_day(dwh, bad[1].date_dim_id)
    assert [r.k for r in kept.collect()] == [9]
    with pytest.raises(checks.GateError):
        checks.assert_gate(rec)


def test_schema_conformance_counts_nulls_and_bad_casts(spark):
    raw = spark.createDataFrame([("1", "E", "2", "x", "web", "a", None, "P", "2000-01-01"),
                                 (None, "E", "zz", "1.5", "web", "a", "b", None, "notadate")],
                                ", ".join(f"`{f.name}` string" for f in CSV_SCHEMA.fields))
    out = {r.column_name: (r.nulls, r.bad_casts) for r in checks.schema_conformance(raw, CSV_SCHEMA).collect()}
    assert out["Transaction ID"] == (1, 0)
    assert out["Number of purchased tickets"] == (0, 1)
    assert out["Total amount"] == (0, 1)
    assert out["Customer last name"] == (0, 0)      # nullable column
    assert out["Created_date"] == (0, 1)


def test_file_name_gate(spark):
    paths = spark.createDataFrame([("file:/x/source_file=DailySales_0825022_111222333.csv/part-0.csv",),
                                   ("file:/x/DailySales_0101000_5.csv",), ("file:/x/other.csv",)], "path string")
    res = spark.createDataFrame([(5,)], "ResellerId bigint")
    out = {r.file_name: r for r in checks.file_name_gate(paths, res, D(2000, 1, 1)).collect()}
    a = out["DailySales_0825022_111222333.csv"]
    assert a.file_date == D(2022, 8, 25) and a.reseller_id == 111222333 and not a.reseller_ok and not a.ok
    b = out["DailySales_0101000_5.csv"]
    assert b.date_ok and b.reseller_ok and b.ok
    odd = out["other.csv"]                               # reported under its own name
    assert len(out) == 3 and odd.file_date is None and not odd.ok


def test_non_empty_gate(spark):
    out = {r.source: r.has_rows for r in
           checks.non_empty_gate({"a": spark.range(2), "b": spark.range(0)}).collect()}
    assert out == {"a": True, "b": False}
