import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxoffice.operators import changes
from boxoffice.operators.keys import surrogate_key
from boxoffice.sources.tables import change_versions

D = dt.date


def test_latest_per_key_prefers_update_and_is_total(spark):
    df = spark.createDataFrame(
        [(1, D(2000, 1, 1), None, "a"), (1, D(2000, 1, 1), D(2000, 2, 1), "b"),
         (2, D(2000, 1, 1), None, "x"), (2, D(2000, 1, 1), None, "y")],
        "k int, CreateDate date, UpdateDate date, v string")
    out = {r.k: r.v for r in changes.latest_per_key(df, ["k"], ["UpdateDate", "CreateDate"]).collect()}
    assert out == {1: "b", 2: "y"}     # NULL update ranks lowest; ties broken by the other columns


def test_latest_per_key_plan_combines_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = changes.latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_distinct_key_count_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert changes.distinct_key_count(df, ["k"]).collect()[0][0] == df.dropDuplicates(["k"]).count() == 3


def test_scd1_update_null_overwrites_and_missing_key_is_noop(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, n int")
    upd = spark.createDataFrame([(1, None, 11), (3, "zz", 30)], "k int, name string, n int")
    out = {r.k: (r.name, r.n) for r in changes.scd1_update(target, upd, ["k"], ["name", "n"]).collect()}
    assert out == {1: (None, 11), 2: ("b", 20)}


def test_scd1_update_target_match_limits_rows(spark):
    target = spark.createDataFrame([(1, "platfrom", "N"), (1, "csv", "N")], "k int, sold_by string, f string")
    upd = spark.createDataFrame([(1, "Y")], "k int, f string")
    out = changes.scd1_update(target, upd, ["k"], ["f"], target_match=target["sold_by"] == "platfrom")
    assert sorted((r.sold_by, r.f) for r in out.collect()) == [("csv", "N"), ("platfrom", "Y")]


def test_rollback_day_keeps_rows_where_predicate_is_null(spark):
    df = spark.createDataFrame([(19980302, None), (None, None), (1, 19980302), (1, 2), (None, 5)],
                               "createDt_id int, UpdateDt_id int")
    left = sorted(repr(tuple(r)) for r in changes.rollback_day(df, 19980302).collect())
    assert left == sorted(repr(t) for t in [(None, None), (1, 2), (None, 5)])


def test_rollback_day_channel(spark):
    df = spark.createDataFrame([(5, None, "platfrom"), (5, None, "csv")], "createDt_id int, UpdateDt_id int, sold_by string")
    assert [r.sold_by for r in changes.rollback_day_channel(df, 5, "platfrom").collect()] == ["csv"]


def test_change_versions_and_rerun_is_idempotent(spark, tmp_dir):
    from boxoffice.sources.tables import LOAD_COL, write_staging
    src = spark.createDataFrame([(1, D(2000, 1, 1), D(2000, 1, 5)), (2, D(2000, 1, 2), None)],
                                "k int, CreateDate date, UpdateDate date")
    v = change_versions(src)
    rows = sorted((r.k, r[LOAD_COL], r.UpdateDate) for r in v.collect())
    assert rows == [(1, D(2000, 1, 1), None), (1, D(2000, 1, 5), D(2000, 1, 5)), (2, D(2000, 1, 2), None)]
    write_staging(v, tmp_dir)
    write_staging(v.filter(F.col(LOAD_COL) == F.lit(D(2000, 1, 1))), tmp_dir)   # rerun one day
    assert spark.read.parquet(tmp_dir).count() == 3


@pytest.mark.parametrize("start", [0, 100])
def test_surrogate_key_equals_row_number(spark, start):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit("x").alias("v"))
    keyed = surrogate_key(df, ["k"], "sk", start=start, num_partitions=7)
    got = sorted((r.k, r.sk) for r in keyed.collect())
    assert got == [(k, k + 1 + start) for k in range(5000)]
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
