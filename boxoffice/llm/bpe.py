"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split by a pattern; the bytes of each match are merged by rank: the pair of
neighbouring parts whose joined bytes have the lowest rank goes first, the leftmost of
equals before others. Parts form a linked list. The queue has one bucket of list
positions per rank; a tree of 64-bit words marks the buckets in use, so the next rank
is found by a find-first-set per level, and a merge costs a few steps however long the
match is. Positions whose pair has changed since they were queued are skipped.

Matches repeat, so each Python worker remembers those it met last (bounded; when full, those of the present batch stay).

Defined results: null and empty texts have no ids and decode to no bytes; special
tokens' strings are ordinary text; repeated rows each get their row; other columns are
ignored."""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words and matches that a worker remembers, together.
REMEMBERED = 600_000
#: Text bytes encoded at a time.
BATCH_BYTES = 8 << 20


class RankQueue:
    """Buckets of positions by rank; ``open`` empties the one of the lowest rank."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while True:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * ranks)
            if ranks == 1:
                break

    def fill(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        for words in self.levels:
            i = rank >> 6
            word = words[i]
            words[i] = word | 1 << (rank & 63)
            if word:
                return
            rank = i

    def open(self) -> tuple[int, list[int]]:
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        i = rank
        for words in self.levels:
            words[i >> 6] &= ~(1 << (i & 63))
            if words[i >> 6]:
                break
            i >>= 6
        return rank, self.buckets.pop(rank)


class Codec:
    def __init__(self, file: str):
        with open(file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        # the tokens' bytes end to end, for decoding by one gather
        size = max(self.tokens) + 1
        self.token_size = np.array([len(self.tokens.get(i, b"")) for i in range(size)])
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)
        self.decimals = {i: str(i) for i in self.tokens}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.queue = RankQueue(max(self.tokens) + 1)
        #: rank of two neighbouring parts, by their ids (left id << 32 | right id)
        self.pairs = {a << 32 | b: i for t, i in self.ranks.items() for k in range(1, len(t))
                      if (a := self.ranks.get(t[:k])) is not None and (b := self.ranks.get(t[k:])) is not None}
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)])
        self.byte_pairs = np.array([[self.pairs.get(a << 32 | b, -1) for b in self.bytes.tolist()]
                                    for a in self.bytes.tolist()])
        #: ids of words and matches, as little-endian 32-bit bytes and as decimals joined by commas
        self.words: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches end to end, and where each match's begin and end. The matches lie end to end in one list, with no pair
        across a border, so they share the queue."""
        whole = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(whole)
        borders = np.cumsum([len(p) for p in pieces])
        now_ = np.full(n, -1)  # rank of the pair that begins here
        now_[:-1] = self.byte_pairs[whole[:-1], whole[1:]]
        now_[borders - 1] = -1
        ids, now = self.bytes[whole].tolist(), now_.tolist()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[borders - 1] = before[np.concatenate([[0], borders[:-1]])] = -1
        after, before = after.tolist(), before.tolist()
        queue, pairs = self.queue, self.pairs
        buckets, fill = queue.buckets, queue.fill
        order = np.argsort(now_, kind="stable")
        order = order[np.searchsorted(now_[order], 0):]
        for some in np.split(order, np.flatnonzero(np.diff(now_[order])) + 1):
            if len(some):
                fill(int(now_[some[0]]), some.tolist())
        while buckets:
            rank, positions = queue.open()
            positions.sort()
            for k, i in enumerate(positions):
                if now[i] != rank:
                    continue  # stale
                lowest = rank
                gone = after[i]
                now[gone] = ids[gone] = -1
                ids[i] = rank
                after[i] = follows = after[gone]
                if follows >= 0:
                    before[follows] = i
                    now[i] = fresh = pairs.get(rank << 32 | ids[follows], -1)
                    if fresh >= 0:
                        if fresh in buckets:
                            buckets[fresh].append(i)
                        else:
                            fill(fresh, [i])
                        if fresh < lowest:
                            lowest = fresh
                else:
                    now[i] = -1
                left = before[i]
                if left >= 0:
                    now[left] = fresh = pairs.get(ids[left] << 32 | rank, -1)
                    if fresh >= 0:
                        if fresh in buckets:
                            buckets[fresh].append(left)
                        else:
                            fill(fresh, [left])
                        if fresh < lowest:
                            lowest = fresh
                if lowest < rank and k + 1 < len(positions):  # a lower rank goes first
                    if rank in buckets:
                        buckets[rank] += positions[k + 1:]
                    else:
                        fill(rank, positions[k + 1:])
                    break
        ids = np.array(ids)
        left = ids >= 0
        return ids[left], np.concatenate([[0], np.cumsum(left)[borders - 1]])

    def learn(self, texts: list[list[str]]) -> None:
        """Remember the words of ``texts`` (each a list of words)."""
        every = set().union(*texts)
        if len(self.words) + len(every) > REMEMBERED:  # these come again soonest
            self.words = {w: self.words[w] for w in every if w in self.words}
            self.texts = {w: self.texts[w] for w in self.words}
        words, decimals = self.words, self.texts
        # all words' matches end to end, and how many each has: one list instead of one a word
        fresh, flat, sizes, find = list(every.difference(words)), [], [], self.pattern.findall
        for w in fresh:
            ms = find(w)
            flat += ms
            sizes.append(len(ms))
        todo = sorted(set(flat).difference(words))
        if todo:
            ids, bounds = self.merge([m.encode() for m in todo])
            raw, some, bounds = ids.astype("<u4").tobytes(), list(map(self.decimals.__getitem__, ids.tolist())), bounds.tolist()
            for m, a, b in zip(todo, bounds, bounds[1:]):
                words[m], decimals[m] = raw[4 * a:4 * b], ",".join(some[a:b])
        at = 0
        for w, n in zip(fresh, sizes):
            if n > 1:
                words[w] = b"".join(map(words.__getitem__, flat[at:at + n]))
                decimals[w] = ",".join(map(decimals.__getitem__, flat[at:at + n]))
            at += n

    def coded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, and the same as decimals joined by commas; ``texts`` are few
        enough to have few distinct words."""
        split = [_words(t) for t in texts]
        collects = gc.isenabled()
        gc.disable()  # many small objects, no cycles among them
        try:
            self.learn(split)
        finally:
            if collects:
                gc.enable()
        ids, decimals = self.words.__getitem__, self.texts.__getitem__
        for words in split:
            yield np.frombuffer(b"".join(map(ids, words)), "<u4"), ",".join(map(decimals, words))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for ids, _ in self.coded(texts):
            yield ids.tolist()

    def decode(self, ids: Sequence[int]) -> bytes:
        ids = np.asarray(ids, np.int64)
        size = self.token_size[ids]
        end = np.cumsum(size)
        if len(ids) == 0:
            return b""
        return self.token_bytes[np.repeat(self.token_start[ids] - end + size, size) + np.arange(end[-1])].tobytes()


_BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _words(text: str) -> list[str]:
    """The text in parts whose matches are independent. A match never goes on over a
    single space or line feed between two characters that are not white space, but begins
    with it (or is the line feed); white space of any other form keeps its words together."""
    return _BORDER.split(text) if text else []


_CODECS: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    if file not in _CODECS:
        _CODECS[file] = Codec(file)
    return _CODECS[file]


def encode_decode(docs: DataFrame, file: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Every row's id, number of token ids, SHA-256 of the ids (decimal, joined by
    commas) and of the bytes they decode to; ``with_ids`` adds the ids themselves."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(file or public_tokenizers.path(RANKS))
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
        for b in common.text_batches(batches, limit=BATCH_BYTES):
            n, coded, decoded, every = [], [], [], []
            for ids, decimals in coder.coded([t or "" for t in b["text"].to_pylist()]):
                n.append(len(ids))
                coded.append(hashlib.sha256(decimals.encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    every.append(ids)
            columns = [b["doc_id"], pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(every, pa.list_(pa.int32()))] * with_ids, names)

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                           + ", ids array<int>" * with_ids)


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
