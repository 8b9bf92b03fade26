"""Spelling variant grouping by dynamic programming over sorted word lists.

Words that occur often enough are joined to their near words, those that differ by
exactly one inserted, deleted or replaced code point. Two near words differ at one place,
so they agree before and after the segment that holds it: a word is cut into segments, and
for each one keyed by all that lies outside. Words of equal key meet in one short list, each
with its own middle. A list is scanned once, sorted by middle: every middle's row of the
edit matrix, of which only the band of one edit around the diagonal is kept, goes on from
the row at its common prefix with the middle before (their LCP), for all asking words at
once; words whose row exceeds one edit drop out, and when none is left, all middles that share
the prefix are skipped.

Words are first cut into two halves. A key that more than ``CROWD`` words share is cut again
for each single place, which leaves lists no longer than the alphabet squared: a hot key costs
more rows, never a long list, and no words are dropped. A pair is taken only in the segment
that holds the end of its common prefix, so it is found once.

Each task counts its own words before anything is shuffled; forms are followed to roots by
doubling steps, each written.

Defined results: a null text has no words and a null id counts as the empty text; repeated
rows count again; ties go to the smallest word in code-point order; no texts give no rows;
other columns are ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

#: One run in so many loses a code point.
EVERY = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form occurs at least so many times as often.
RATIO = 5
#: Words of one key that are scanned as one list.
CROWD = 4096
#: Distinct words a task holds before it passes them on.
HELD = 500_000
#: Text bytes read at a time.
BATCH_BYTES = 4 << 20


def words(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``least_length`` code points that occur ``least_count`` times."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def rows_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in common.text_batches(batches, limit=BATCH_BYTES):
            for ident, text in zip(b["id"].to_pylist(), b["text"].to_pylist()):
                if not text:
                    continue
                # bytes.lower knows A-Z alone
                found = Counter(runs.findall(text.encode().lower().decode()))
                held.update(found)
                start = zlib.crc32(f"{ident}:".encode())
                for w, n in found.items():
                    h = zlib.crc32(w.encode(), start)
                    if h % every == 0:
                        held[w] -= n
                        at = h % len(w)
                        held[w[:at] + w[at + 1:]] += n
            if len(held) > HELD:
                yield rows_of(held)
                held.clear()
        if held:
            yield rows_of(held)

    counted = rows.mapInArrow(run, "word string, n long").where(F.length("word") >= least_length)
    return common.written(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "words")


def _keys(vocabulary: DataFrame, places) -> DataFrame:
    """A row for each word, base length b (its own, or one less) and segment [s, e) of b."""
    cut = vocabulary.withColumn("b", F.explode(F.expr("array(length(word), length(word) - 1)"))).where("b > 0")
    cut = cut.withColumn("at", F.explode(places(F.col("b")))).select("word", "n", "b", "at.s", "at.e")
    # what follows the segment is as long for the longer word of a pair
    return cut.selectExpr("word", "n", "b", "s", "e", "substr(word, 1, s) as head", "right(word, b - e) as tail",
                          "substr(word, s + 1, length(word) - s - (b - e)) as middle")


def _halves(b):
    half = F.floor(b / 2).cast("int")
    return F.array(F.struct(F.lit(0).alias("s"), half.alias("e")), F.struct(half.alias("s"), b.alias("e")))


def _single(b):
    return F.transform(F.sequence(F.lit(0), b - 1), lambda i: F.struct(i.alias("s"), (i + 1).alias("e")))


KEY = ["b", "s", "e", "head", "tail"]


def scan(middles: list[bytes], base: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, common prefix) for middles of one sorted list at edit distance 1, i of length
    ``base`` and j of ``base`` or ``base`` + 1. Cell k of a row at depth t is the distance of
    the list's prefix of length t to the asker's of length t + k - 1."""
    asking = np.flatnonzero([len(m) == base for m in middles])
    if len(asking) == 0 or len(middles) < 2:
        return
    # askers padded by a byte that no word holds
    text = np.zeros((len(asking), base + 4), np.uint8)
    for r, i in enumerate(asking):
        text[r, 2:2 + base] = np.frombuffer(middles[i], np.uint8)
    rows = [np.tile(np.array([2, 0, 1], np.int8), (len(asking), 1))]
    alive = [np.arange(len(asking))]
    before, j = b"", 0
    while j < len(middles):
        m = middles[j]
        lcp = 0
        while lcp < min(len(m), len(before), len(rows) - 1) and m[lcp] == before[lcp]:
            lcp += 1
        del rows[lcp + 1:], alive[lcp + 1:]
        for t in range(lcp, len(m)):
            who, row = alive[t], rows[t]
            own = text[who, t + 1:t + 4] != m[t]             # asker's places t - 1, t, t + 1
            new = np.full(row.shape, 2, np.int8)
            new[:, 0] = np.minimum(row[:, 0] + own[:, 0], row[:, 1] + 1)
            new[:, 1] = np.minimum(np.minimum(row[:, 1] + own[:, 1], row[:, 2] + 1), new[:, 0] + 1)
            new[:, 2] = np.minimum(row[:, 2] + own[:, 2], new[:, 1] + 1)
            near = np.flatnonzero(new.min(axis=1) <= 1)
            alive.append(who[near])
            rows.append(new[near])
            if len(near) == 0:
                break
        before = m[:len(rows) - 1]
        if len(rows) - 1 == len(m) and len(m) in (base, base + 1):
            cell = rows[-1][:, base - len(m) + 1]
            for r in alive[-1][cell == 1]:
                a = middles[asking[r]]
                p = 0
                while p < base and a[p] == m[p]:
                    p += 1
                yield int(asking[r]), j, p
        j += 1
        if len(alive[-1]) == 0:
            while j < len(middles) and middles[j].startswith(before):
                j += 1


def _group(sorted_rows: list[tuple], out: dict[str, list]) -> None:
    """Adds to ``out`` the near pairs of one key's (middle, word, n, b, s, e)."""
    _, _, _, b, s, e = sorted_rows[0]
    last = e == b

    def add(word: str, near: str, n: int) -> None:
        found = out.get(word)
        if found is None:
            out[word] = [1, n, near]
        else:
            found[0] += 1
            if (-n, near) < (-found[1], found[2]):
                found[1:] = n, near

    for i, j, p in scan([r[0] for r in sorted_rows], e - s):
        if p < e - s or last:
            (_, u, nu, *_), (_, v, nv, *_) = sorted_rows[i], sorted_rows[j]
            if len(u) < len(v):
                add(v, u, nu)                                # equal lengths meet both ways round
            add(u, v, nv)


def near_words(vocabulary: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n_near, best_n, best): for every word with a near word, how many it has and the
    one of largest n. ``vocabulary`` is (word, n), written."""
    halves = _keys(vocabulary, _halves)
    size = common.written(halves.groupBy(*KEY).agg(F.count("*").alias("size")).where("size > 1"), "key-sizes")
    lists = halves.join(size, KEY).where(F.col("size") <= crowd).drop("size")
    # a pair of a crowded half meets at the single place where it differs
    crowded = halves.join(size.where(F.col("size") > crowd), KEY).select("word", "n", "b", F.col("s").alias("from"), F.col("e").alias("to"))
    single = _keys(vocabulary.join(crowded.select("word").distinct(), "word", "left_semi"), _single)
    single = single.join(crowded.select("word", "b", "from", "to"), ["word", "b"]).where("s >= from and s < to").select(lists.columns)
    rows = lists.unionByName(single).select(*KEY, F.encode("middle", "ISO-8859-1").alias("middle"), "word", "n")
    rows = rows.repartition(*KEY).sortWithinPartitions(*KEY, "middle")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], {}

        def flush() -> pa.RecordBatch:
            columns = list(zip(*((w, *v) for w, v in out.items()))) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                                              ["word", "n_near", "best_n", "best"])

        for batch in batches:
            for b, s, e, head, tail, middle, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (b, s, e, head, tail):
                    if len(held) > 1:
                        _group(held, out)
                    key, held = (b, s, e, head, tail), []
                held.append((middle, word, n, b, s, e))
            if len(out) > HELD:
                yield flush()
        if len(held) > 1:
            _group(held, out)
        yield flush()

    parts = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each word's chain of forms ends. ``forms`` is (word, form); a form
    occurs ``RATIO`` times as often, so chains are short; each step doubles what it follows."""
    now = common.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        now = common.written(step, "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = RATIO, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n)."""
    vocabulary = words(docs, every, least_length, least_count, id_col, text_col)
    near = vocabulary.join(near_words(vocabulary, crowd), "word", "left")
    has = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    known = common.written(near.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                       F.when(has, F.col("best_n")).alias("form_n")), "variants")
    last = roots(known.where("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
