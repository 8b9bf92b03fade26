"""Column expressions shared by the loads. All are built-in Spark functions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text form of a timestamp inside business keys (F-5), fixed so that every
# engine prints the same key.
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(d) -> Column:
    """Calendar surrogate ``yyyymmdd`` as an int."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def changed_on(day: dt.date, create="CreateDate", update="UpdateDate") -> Column:
    """P-1: created or updated on ``day``; a NULL update falls out of its arm."""
    return (_c(create) == F.lit(day)) | (_c(update) == F.lit(day))


def same_day(ts, day: dt.date) -> Column:
    """P-10: ``ts::date = day`` written as a half-open range, so it stays a
    plain comparison on the column and pushes down to the Parquet scan."""
    start = dt.datetime.combine(day, dt.time())
    end = start + dt.timedelta(days=1)
    ts = _c(ts)
    return (ts >= ntz_literal(start)) & (ts < ntz_literal(end))


def ntz_literal(t: dt.datetime) -> Column:
    """A wall-clock timestamp literal, free of session and process time zones."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0: a NULL condition counts as failed."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ipv4_to_long(ip) -> Column:
    """Dotted quad to its 32-bit value as a long (NULL for malformed text)."""
    parts = F.split(_c(ip), r"\.")
    octs = [F.try_element_at(parts, F.lit(i)).try_cast("long") for i in range(1, 5)]
    ok = (F.size(parts) == 4)
    for o in octs:
        ok = ok & o.between(0, 255)
    val = octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3]
    return F.when(F.coalesce(ok, F.lit(False)), val)


def cidr_bounds(network) -> tuple[Column, Column]:
    """``a.b.c.d/len`` to the first and last address of the block (NULL for malformed text)."""
    net = _c(network)
    addr = ipv4_to_long(F.split(net, "/").getItem(0))
    plen = F.try_element_at(F.split(net, "/"), F.lit(2)).try_cast("int")
    plen = F.when(plen.between(0, 32), plen)
    size = F.pow(F.lit(2.0), F.lit(32) - plen).cast("long")
    start = addr - (addr % size)
    return start, start + size - 1


def ipv6_expanded(ip) -> Column:
    """IPv6 text with all of its eight groups written out, in lower case; NULL for malformed
    text (also for a dotted quad as the last two groups)."""
    text = F.lower(_c(ip))
    # "::" at an end stands for one group more, written out first; then as many are missing as colons to eight
    inner = F.regexp_replace(F.regexp_replace(text, r"\A::", "0::"), r"::\z", "::0")
    whole = F.replace(inner, F.lit("::"), F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.lit(8) - F.regexp_count(inner, F.lit(":")))))
    none_missing = r"\A(?=.*::)[^:]+(:+[^:]+){7}\z"
    return F.when(whole.rlike(r"\A[0-9a-f]{1,4}(:[0-9a-f]{1,4}){7}\z") & ~text.rlike(none_missing), whole)


def ipv6_longs(expanded) -> Column:
    """The 128 bits of an expanded address as a struct of two longs, ``hi`` and ``lo``."""
    def half(first: int) -> Column:
        digits = [F.lpad(F.split_part(_c(expanded), F.lit(":"), F.lit(i)), 4, "0") for i in range(first, first + 4)]
        return F.conv(F.concat(*digits), 16, -10).cast("long")

    return F.struct(half(1).alias("hi"), half(5).alias("lo"))


def ipv6_prefix(bits: Column, length) -> Column:
    """``ipv6_longs`` with only the first ``length`` bits left."""
    length = _c(length)

    def kept(half: Column, n: Column) -> Column:
        return F.when(n <= 0, F.lit(0).cast("long")).otherwise(half.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), 64 - F.least(n, F.lit(64)))))

    return F.struct(kept(bits["hi"], length).alias("hi"), kept(bits["lo"], length - 64).alias("lo"))


def business_key(name, ts) -> Column:
    """F-5: ``name || ts`` with the timestamp in a fixed text form; NULL if
    either part is NULL."""
    return F.concat(_c(name), F.date_format(_c(ts), KEY_TS_FORMAT))
