"""S-8: the calendar dimension ``(date_dim_id, date_actual)``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.columns import date_id
#: Days (16 bytes each) up to which the calendar is broadcast.
BROADCAST_DAYS = 200_000


def calendar_dim(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in ``[start, end]``, generated by ``spark.range`` so it
    is split across tasks instead of exploding one array on one row."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, max(days, 0)).select(date_id(d).alias("date_dim_id"), d.alias("date_actual"))


def lookup_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar ready for joins: its size is known from the span, so it is
    broadcast when the span is under the bound."""
    cal = calendar_dim(spark, start, end)
    return F.broadcast(cal) if (end - start).days + 1 <= BROADCAST_DAYS else cal
