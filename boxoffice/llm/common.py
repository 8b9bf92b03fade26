"""Helpers shared by the operators: folders for written intermediates, and NumPy views of Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.session import shared_root, ship  # noqa: F401 (operators take ship from here)

#: Text bytes that NumPy code works on at a time; its temporary arrays are about 100 times as large.
CHUNK_BYTES = 1 << 20

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name for an intermediate table under the shared checkpoint folder."""
    return f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Folders that the open ``cleaned`` blocks will delete.
_OPEN: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage,
    and a lost executor costs only the tasks it was running."""
    path = scratch(df.sparkSession, name)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` in this block are deleted when it ends (also by an error), so only
    results that were written before it, or plans that do not read them, may outlive it.
    Spark removes the shuffle files of finished plans when the driver's memory is tidied up,
    which is asked for here."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            delete(spark, path)
        spark.sparkContext._jvm.System.gc()


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text",
                 limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes (a longer text alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size, dtype=np.int64) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few, and freed memory given back after each
    batch that Spark sent: workers live on, and their next task has other needs."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
        del batch
        pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and each row's bounds in them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15  # any odd number
_P_INV = pow(_P, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs without ASCII white space, A-Z lower-cased)
    of all rows, and the bounds of each row's words in them."""
    data, bounds = text_bytes(column)
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    word = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    start = np.flatnonzero(word & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    end = np.flatnonzero(word & (~after | first[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(_P, n), dtype=np.uint64, out=sums[1:])
    hashes = mix64((sums[end] - sums[start]) * _powers(_P_INV, n)[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(start, bounds)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's ``size``-word shingles (one of all its words, if it has
    fewer; none without words), and the row of each."""
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(counts)), np.where(counts >= size, counts - size + 1, counts > 0))
    if len(rows) == 0:
        return np.zeros(0, np.uint64), rows
    firsts = np.cumsum(np.where(counts >= size, counts - size + 1, counts > 0))
    at = bounds[rows] + np.arange(len(rows)) - np.concatenate([[0], firsts])[rows]
    last = bounds[rows + 1]
    out = np.zeros(len(rows), np.uint64)
    for k in range(size):
        there = at + k < last
        out = out * np.uint64(_P) + np.where(there, words[np.minimum(at + k, len(words) - 1)], np.uint64(0))
    return mix64(out), rows
