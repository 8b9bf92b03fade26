"""V-9/J-12: keys that occur more than once, shuffling only those that may.

First pass: a key sets one place of a filter of 2^40 places, by hash. The filter is never held as
a whole: each task sorts the places it sets and sends them on as differences of a few bits, by
stretch of the filter, instead of a row a key. Where a stretch comes together, the
places that were set twice are known. Second pass: only rows whose key has such a place are
grouped by key. Two different keys may share a place; the grouping tells them apart."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.scratch import written
from boxoffice.session import ship

PLACE_BITS = 40
#: Keys of a stretch of the filter, on average, and places that a task holds before it sends them on.
STRETCH, HELD = 1 << 20, 1 << 22


def _place(keys: Sequence[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - PLACE_BITS)


def _packed(gaps: np.ndarray) -> bytes:
    """Numbers in seven bits a byte, lowest first; the last byte of each has its high bit unset."""
    size = np.maximum(1, (np.frexp(gaps.astype(np.float64))[1] + 6) // 7)
    end = np.cumsum(size)
    place = np.arange(end[-1]) - np.repeat(end - size, size)
    seven = (np.repeat(gaps, size) >> (7 * place)) & 127
    seven[np.delete(np.arange(end[-1]), end - 1)] |= 128
    return seven.astype(np.uint8).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    last = np.flatnonzero(b < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((b & 127) << (7 * place), first)


def stretches(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(stretch, places): the places that the keys set, packed, by their first ``bits``; what the
    first pass shuffles."""
    shift = PLACE_BITS - bits

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        places = np.sort(np.concatenate(held))
        # two of a place say as much as more
        places = places[np.concatenate([[True, True][:len(places)], places[2:] != places[:-2]])]
        top = places >> shift
        cuts = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
        parts = [_packed(np.diff(p, prepend=p[0] >> shift << shift)) for p in np.split(places, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(top[cuts]), pa.array(parts, pa.binary())], ["stretch", "places"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b.column(0).to_numpy())
                n += b.num_rows
            if n >= HELD:
                yield from send(held)
                held, n = [], 0
        if n:
            yield from send(held)

    return df.select(_place(keys).alias("place")).mapInArrow(run, "stretch long, places binary")


def repeated_places(sent: DataFrame, bits: int) -> DataFrame:
    """(place): places that were set twice or more. ``bits`` as the stretches were cut by."""
    shift = PLACE_BITS - bits

    def twice(table: pa.Table) -> pa.Table:
        low = table["stretch"][0].as_py() << shift
        places = np.sort(np.concatenate([np.cumsum(_unpacked(p)) for p in table["places"].to_pylist()]))
        return pa.table({"place": np.unique(places[1:][places[1:] == places[:-1]]) + low})

    return sent.groupBy("stretch").applyInArrow(twice, "place long")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, n): keys of more than one row; NULL keys compare as equal to each other."""
    keys = list(keys)
    ship(df.sparkSession)
    slim = df.select(*keys)
    bits = max(0, (slim.count() // STRETCH).bit_length())
    # as few as the repeated keys: Spark broadcasts them if their files prove small
    places = written(repeated_places(stretches(slim, keys, bits), bits), "repeated")
    some = slim.withColumn("_place", _place(keys)).join(places.withColumnRenamed("place", "_place"), "_place", "left_semi")
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
