"""Document fingerprints: a threshold-scaled sketch.

A text's sketch keeps every distinct five-word shingle hash below a fixed fraction
of the 64-bit range. The threshold is the same for all texts, so sketches of any
length can be compared, merged by union, and give containment of a short text in a
long one without bias: |A and B| / |A| over the kept hashes.

A fingerprint is text: number of shingles, digest of the words, then the kept hashes
in ascending order (16 hex digits each). Texts that differ only in ASCII case or white
space have equal fingerprints. Texts with few shingles may keep no hash; then likeness
is 1 for equal digests and else 0.

Defined results: a null text counts as empty; an empty text has fingerprint ``0::`` and
equals other empty texts; texts of one to four words are one shingle; repeated rows each
get their row; a null id sorts before all others; of rows with equal ids the one with the
smaller text comes first (null: empty); other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

#: Words in a shingle, and the fraction of hashes kept (one in so many).
SHINGLE = 5
SCALE = 8
#: Rows a range of ids should have, and most ranges: ranges are read as streams, so larger ones cost no memory.
RANGE_ROWS, MOST_RANGES = 8192, 4096


def sketches(column: pa.Array) -> list[tuple[str, np.ndarray]]:
    """Per text: its fingerprint, and the kept hashes in ascending order."""
    words, bounds = common.word_hashes(column)
    hashes, rows = common.shingle_hashes(words, bounds, SHINGLE)
    counts = np.bincount(rows, minlength=len(column))
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * at, dtype=np.uint64)])
    plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words, dtype=np.uint64)])
    # sum of hash x (place in the text), whatever the text's place in the batch
    whole = (sums[bounds[1:]] - sums[bounds[:-1]]) - (plain[bounds[1:]] - plain[bounds[:-1]]) * bounds[:-1].astype(np.uint64)
    whole = common.mix64(whole + np.diff(bounds).astype(np.uint64))
    kept = hashes < np.uint64((1 << 64) // SCALE)
    hashes, rows = hashes[kept], rows[kept]
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    cuts = np.searchsorted(rows, np.arange(len(column) + 1))
    out = []
    for i in range(len(column)):
        own = hashes[cuts[i]:cuts[i + 1]]
        text = f"{counts[i]:x}:{int(whole[i]):016x}:" if counts[i] else "0::"
        out.append((text + own.astype(">u8").tobytes().hex(), own))
    return out


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """Estimated share of a's shingles that b has too (0 to 1)."""
    if a[0] == b[0]:
        return 1.0
    if len(a[1]) == 0 or len(b[1]) == 0:
        return float(a[0].split(":", 2)[:2] == b[0].split(":", 2)[:2])
    at = np.searchsorted(b[1], a[1])
    return float((b[1][np.minimum(at, len(b[1]) - 1)] == a[1]).mean())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's (id, fingerprint); needs no shuffle."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.text_batches(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([s[0] for s in sketches(b["text"])], pa.string())],
                                             ["doc_id", "fingerprint"])

    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, sentinel, doc_id, text), sorted in each partition so that the row after
    a document is the next one by ascending id: ids are cut into ranges, and the first
    row of each range is also dealt, as a sentinel, to the end of the range before
    (that of the first range to the last). One id a range reaches the driver, of ``MOST_RANGES`` at most."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))
    n = ids.count()
    ranges = max(1, min(MOST_RANGES, -(-n // RANGE_ROWS)))
    cuts = [] if ranges == 1 else ids.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0]
    cuts = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("long")
    def range_of(x):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, x.to_numpy(np.int64), side="right"))

    firsts = sorted(tuple(r) for r in ids.groupBy(range_of("id").alias("k")).agg(F.min("id").alias("id")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b["doc_id"].fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            again = [i for i, x in enumerate(own.tolist()) if x in before]
            bucket = np.searchsorted(cuts, own, side="right")
            take = np.concatenate([np.arange(len(own)), np.array(again, np.int64)])
            bucket = np.concatenate([bucket, np.array([before[int(own[i])] for i in again], np.int64)])
            sentinel = np.repeat([0, 1], [len(own), len(again)])
            taken = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(sentinel), taken["doc_id"], taken["text"]],
                                             ["bucket", "sentinel", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "bucket long, sentinel long, doc_id long, text string")
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 4)
    return dealt.repartition(wide, "bucket").sortWithinPartitions("bucket", "sentinel", "doc_id", "text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last floor(n/2) code
    points are replaced by the first as many (or all) of the next document, and the
    likeness of the text's fingerprint to the edited and the next text's."""
    common.ship(docs.sparkSession)

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for b in batches:
            for bucket, sentinel, doc, text in zip(*(b[c].to_pylist() for c in ("bucket", "sentinel", "doc_id", "text"))):
                if held is not None and held[0] == bucket and not held[1]:
                    yield held[2], held[3], text or ""
                held = (bucket, sentinel, doc, text or "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            edited = [t[:len(t) - len(t) // 2] + nxt[:len(t) // 2] for _, t, nxt in part]
            own = sketches(pa.array([t for _, t, _ in part] + [part[-1][2]], pa.string()))
            other = sketches(pa.array(edited, pa.string()))
            after = [*own[1:]]
            for i in range(len(part) - 1):  # the next pair may begin another range
                if part[i][2] is not part[i + 1][1] and part[i][2] != part[i + 1][1]:
                    after[i] = sketches(pa.array([part[i][2]], pa.string()))[0]
            return pa.RecordBatch.from_arrays([
                pa.array([p[0] for p in part], pa.int64()), pa.array([len(p[1]) for p in part], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([s[0] for s in own[:-1]], pa.string()), pa.array([s[0] for s in other], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for p in pairs(batches):
            part.append(p)
            size += len(p[1])
            if size >= common.CHUNK_BYTES:
                yield done()
                part, size = [], 0
        if part:
            yield done()

    return with_next(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def op3_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
