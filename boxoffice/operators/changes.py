"""Change capture, de-duplication and set-based update/delete (P-1, P-2, A-2,
A-3, K-4 … K-7)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.columns import changed_on


def incremental_pull(df: DataFrame, day: dt.date, create="CreateDate", update="UpdateDate") -> DataFrame:
    """S-1: rows created or updated on ``day``. On a JDBC or Parquet relation the
    predicate lands in ``PushedFilters``."""
    return df.filter(changed_on(day, create, update))


def insert_update_split(df: DataFrame, update="UpdateDate") -> tuple[DataFrame, DataFrame]:
    """P-2: rows never updated are inserts, the others are updates."""
    return df.filter(F.col(update).isNull()), df.filter(F.col(update).isNotNull())


def tag_insert_update(df: DataFrame, update="UpdateDate", col="branch") -> DataFrame:
    """P-2 in one pass: the branch each row takes, as a column."""
    return df.withColumn(col, F.when(F.col(update).isNull(), F.lit("insert")).otherwise(F.lit("update")))


def created_on_load_day(create="CreateDate", update="UpdateDate", load="load_date") -> Column:
    """Staged versions that bring a new row: never updated, or updated on the
    very day they were created on (the pull then sees only the updated state)."""
    return F.col(update).isNull() | (F.col(create) == F.col(load))


def first_per_key(df: DataFrame, key: str, load="load_date") -> DataFrame:
    """The row of the earliest load day of each key; ``df`` has one per day."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("_k")).agg(F.min_by(row, F.col(load)).alias("_r")).select("_r.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A-3: one row per key, repeatably: the row that is greatest by ``order``
    and then by every other column (NULL ranks lowest).

    ``max(struct(...))`` is an ordinary aggregate, so Spark combines map-side
    before the shuffle: a key holding a third of the rows leaves each map task
    as one partial row, never as one big group.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = list(order) + rest
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ranked)])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    cols = [F.col(k) for k in keys] + [F.col(f"_best._{i}").alias(c) for i, c in enumerate(ranked)]
    return best.select(*cols).select(*df.columns)


def distinct_key_count(df: DataFrame, keys: Sequence[str], alias="n_keys",
                       by: Sequence[str] = ()) -> DataFrame:
    """A-2: ``dropDuplicates(keys).count()`` as one aggregate (per ``by``
    group). A struct of the keys is never NULL, so a NULL key counts once, as
    dropDuplicates keeps it."""
    agg = F.count_distinct(F.struct(*keys)).alias(alias)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def scd1_update(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                set_cols: Sequence[str], target_match: Column | None = None) -> DataFrame:
    """K-4: overwrite ``set_cols`` of target rows whose key is in ``updates``;
    keys not in the target change nothing. ``updates`` must hold one row per key
    (see ``latest_per_key``). A match flag, not ``coalesce``, decides, so an
    update to NULL is applied. ``target_match`` restricts which target rows may
    match (``sold_by = 'platfrom'``)."""
    keys = list(keys)
    u = updates.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                       *[F.col(c).alias(f"_n_{c}") for c in set_cols], F.lit(True).alias("_matched"))
    cond = [target[k] == u[f"_k_{k}"] for k in keys]
    if target_match is not None:
        cond.append(target_match)
    joined = target.join(u, cond, "left")
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col("_matched"), F.col(f"_n_{c}")).otherwise(target[c]).alias(c))
        else:
            out.append(target[c])
    return joined.select(*out)


def rollback_day(target: DataFrame, day_id: int, create="createDt_id", update="UpdateDt_id",
                 extra: Column | None = None) -> DataFrame:
    """K-6: the table after ``DELETE WHERE create = d OR update = d``. Rows where
    the predicate is NULL stay, as DELETE keeps them."""
    pred = (F.col(create) == F.lit(day_id)) | (F.col(update) == F.lit(day_id))
    if extra is not None:
        pred = pred & extra
    return target.filter(~F.coalesce(pred, F.lit(False)))


def rollback_day_channel(target: DataFrame, day_id: int, channel: str, create="createDt_id",
                         update="UpdateDt_id", channel_col="sold_by") -> DataFrame:
    """K-7: K-6 limited to one sales channel."""
    return rollback_day(target, day_id, create, update, extra=F.col(channel_col) == F.lit(channel))
