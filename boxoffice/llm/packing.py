"""Packing: first-fit decreasing with a tournament tree of bin capacities, run
independently in randomised groups.

Texts become token ids where they are read; only (id, start, length, checksum) rows are
written. A document longer than a sequence is cut into full sequences, which need no packing,
and a rest. The rests are dealt at random into groups of about ``GROUP`` pieces, each of which is
packed alone: longest piece first, into the first bin that has room. The tree's leaves
are the bins' free places and each inner node holds the larger of its two, so the first
bin with room is found by one descent.

Defined results: a null or empty text is its end token alone; repeated rows are packed
as documents of their own; a null id stays null; ties go by id and start; no rows give
no rows; other columns are ignored."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

TOKENIZER = "word_bpe_49k.json"
SEQUENCE = 4096
END = 2
#: Pieces a group has on average, and its seed.
GROUP = 16384
SEED = 20

#: Words that a worker remembers.
REMEMBERED = 600_000
#: Text bytes tokenised at a time.
BATCH_BYTES = 4 << 20

# White space to Python, but not to the tokenizer (or not by all its rules).
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ASCII_SPACE = re.compile("[ \t\n\x0b\f\r]+")
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


class WordTokenizer:
    """Ids of whole texts, as little-endian 32-bit bytes. The tokenizer drops white space
    and treats the words between independently, so each distinct word is encoded once
    and remembered as bytes, and a text's ids are its words' joined; words of letters are
    encoded many at a time and told apart by their end-of-word tokens."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(file)
        self.ends = np.zeros(self.inner.get_vocab_size(), bool)
        self.ends[[i for t, i in self.inner.get_vocab().items() if t.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.inner.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, texts: list[list[str]]) -> None:
        """Remember the words of ``texts`` (each a list of words)."""
        known, parts = self.words, self.parts
        words = set().union(*texts)
        if len(known) + len(words) > REMEMBERED:
            known.clear()
        fresh = words.difference(known)
        if len(parts) + 2 * len(fresh) > REMEMBERED:
            parts.clear()
        # lists of texts alone: the garbage collector has nothing to follow in them
        names: list[str] = []
        cores: list[str] = []
        tails: list[str] = []
        other: list[str] = []
        for w in fresh:
            core = w.rstrip(_SIGNS)
            if w.isascii():
                low = core.lower()
                fine = low.isalpha()
            else:
                low = core
                fine = core.isalpha() and core.lower().isalpha()  # some capitals become a letter and a mark
            if fine:
                names.append(w)
                cores.append(low)
                tails.append(w[len(core):])
            else:
                other.append(w)
        for tail in set(tails):
            if tail not in parts:
                parts[tail] = self.whole(tail).tobytes() if tail else b""
        todo = [p for p in set(cores) if p not in parts]
        for i in range(0, len(todo), 512):
            some = todo[i:i + 512]
            ids = self.whole(" ".join(some))
            cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            if len(cuts) == len(some) + 1:
                raw = ids.tobytes()
                parts.update((p, raw[a:b]) for p, a, b in zip(some, cuts, cuts[1:]))
            else:
                parts.update((p, self.whole(p).tobytes()) for p in some)
        part = parts.__getitem__
        known.update(zip(names, map(bytes.__add__, map(part, cores), map(part, tails))))
        for w in other:
            known[w] = self.whole(w).tobytes()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; ``texts`` are few enough to have few distinct words."""
        split = [_ASCII_SPACE.split(t) if _ODD.search(t) else t.split() for t in texts]
        self.learn(split)
        for words in split:
            yield b"".join(map(self.words.__getitem__, words))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(file: str) -> WordTokenizer:
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = WordTokenizer(file)
    return _TOKENIZERS[file]


class FirstBin:
    """Tournament tree over the free places of bins; bins open from left to right."""

    def __init__(self, capacity: int, bins: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first bin with room for ``length``, and the room it had."""
        free, i = self.free, 1
        while i < self.leaves:
            i *= 2
            if free[i] < length:
                i += 1
        had = free[i]
        free[i] = had - length
        bin_ = i - self.leaves
        i >>= 1
        while i:
            best = max(free[2 * i], free[2 * i + 1])
            if free[i] == best:
                break
            free[i] = best
            i >>= 1
        return bin_, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; longest first, equals in the order given."""
    tree = FirstBin(capacity, len(lengths))
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bin_, had = tree.place(lengths[i])
        out[i] = bin_, capacity - had
    return out


def pieces(docs: DataFrame, file: str | None = None, sequence: int = SEQUENCE,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenised pieces of at most ``sequence`` ids; no shuffle. ``row`` is the place
    of the document in its task, for dealing repeated rows apart."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, row = tokenizer(file or public_tokenizers.path(TOKENIZER)), 0
        for b in common.text_batches(batches, limit=BATCH_BYTES):
            out: list[list] = [[] for _ in names]
            for doc, ids in zip(b["doc_id"].to_pylist(), tok.ids([t or "" for t in b["text"].to_pylist()])):
                raw = memoryview(ids + END.to_bytes(4, "little"))
                total, row = len(raw) // 4, row + 1
                for start in range(0, total, sequence):
                    length = min(sequence, total - start)
                    for column, x in zip(out, (doc, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), total, row)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def pack(docs: DataFrame, file: str | None = None, sequence: int = SEQUENCE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    every = common.written(pieces(docs, file, sequence, id_col, text_col), "pieces")
    full, rest = every.where(F.col("length") == sequence), every.where(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // GROUP))
    dealt = rest.withColumn(
        "part", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "start", "ids_crc32", "row"), F.lit(groups)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("row", "ascending")])
        placed = np.array(first_fit_decreasing(table["length"].to_pylist(), sequence), np.int64).reshape(-1, 2)
        first = table["part"][0].as_py() << 32
        return pa.Table.from_arrays([*(table[n] for n in names[:5]), pa.array(placed[:, 0] + first), pa.array(placed[:, 1])], names)

    packed = dealt.groupBy("part").applyInArrow(fill, ", ".join(f"{n} long" for n in names))
    alone = full.select(*names[:5], (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(alone)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
