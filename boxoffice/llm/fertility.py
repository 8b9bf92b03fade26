"""Quality rules by tokeniser fertility.

Two public vocabularies measure every text: a byte-level one and one of pieces that falls
back to bytes. A text's measures are its characters per token in each, the share of
tokens that are bytes, and the entropy of its tokens as a share of the largest that so
many tokens can have. Prose of a language keeps each of these within a narrow band; what
is no prose, or is in another language than it says, costs more tokens, falls back to
bytes, or repeats few tokens.

Bands belong to a language, or to the dominant script of texts without one, and to the
text's length (its tokens' power of two, since entropy depends on it). They come from the
quartiles over all different texts that pass the base rules: copies count once, so a
large group of copies cannot narrow a band. A band reaches ``REACH`` quartile distances
beyond the quartiles, and at least as far as the measure's ``LEAST``.

Words are runs without ASCII white space; each is measured alone, as if after a space, in
pieces of at most ``LONGEST`` code points, and remembered by the worker, so a very long
word takes time in proportion.

Defined results: null and empty texts have no words, so they fail the base rules; a text
whose measure cannot be compared (no band) is kept; repeated rows each get their row; a
null id stays null; no rows give no rows; other columns are ignored."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

BYTES, PIECES = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
LEAST_WORDS, REPEATED = 50, 0.5
REACH = 1.5
#: How far each measure's band reaches at least below and above the quartiles: shares of
#: the median, and (for the byte share, whose median is 0) as such.
LEAST = {"byte_fertility": (0.12, 0.2, 0.0), "piece_fertility": (0.18, 0.25, 0.0), "fallback": (0.0, 0.0, 0.05), "evenness": (0.08, 0.2, 0.0)}
LONGEST = 64
#: Words that a worker remembers (fewer than 2^21 with those of a batch).
REMEMBERED = 400_000
BATCH_BYTES = 2 << 20

# Scripts by their first and last letters' code points (fixed values of the character set).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
NAMES = [*SCRIPTS, "none"]
_LOWS, _HIGHS, _WHICH = (np.array(x) for x in zip(*sorted((a, b, i) for i, s in enumerate(SCRIPTS) for a, b in SCRIPTS[s])))
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


class Words(dict):
    """Numbers of words (as bytes), with each word's measures by number. A word that is not
    known yet gets the next number and is measured by ``measure``."""

    def __init__(self, bytes_file: str, pieces_file: str):
        import sentencepiece
        import tiktoken

        with open(bytes_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_level = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        n = self.pieces.vocab_size()
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(n)])
        self.starts = np.array([self.pieces.id_to_piece(i).startswith("\u2581") for i in range(n)])
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for t, i in ranks.items() if t.startswith(b" ")]] = True
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.new: list[bytes] = []
        # code points, symbols, script, letters of it, first token, tokens, pieces, pieces that are bytes
        self.about = np.zeros((0, 8), np.int64)
        self.tokens = np.zeros(0, np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def byte_tokens(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all parts, each after a space, and how many each has. A match of the
        pattern never goes on over a space, so all are encoded at once and a token that
        begins with a space begins a part."""
        ids = self.byte_level.encode_to_numpy(" " + " ".join(parts), disallowed_special=())
        first = np.flatnonzero(self.spaced[ids])
        if len(first) == len(parts):
            return ids, np.diff(np.append(first, len(ids)))
        each = [self.byte_level.encode_ordinary(" " + p) for p in parts]
        return np.fromiter((x for p in each for x in p), np.uint32), np.array(list(map(len, each)))

    def piece_tokens(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.pieces.encode(" ".join(parts)), np.int64)
        first = np.flatnonzero(self.starts[ids])
        if len(first) == len(parts):
            return ids, np.diff(np.append(first, len(ids)))
        each = self.pieces.encode(parts, num_threads=1)
        return np.fromiter((x for p in each for x in p), np.int64), np.array(list(map(len, each)))

    def measure(self) -> None:
        """The measures of words met since the last call."""
        if not self.new:
            return
        joined = b" ".join(self.new).decode() + " "
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(points == 32)
        size = np.diff(ends, prepend=-1) - 1
        n = len(size)
        owner = np.repeat(np.arange(n), size + 1)
        rows = np.zeros((n, 8), np.int64)
        rows[:, 0] = size
        rows[:, 1] = np.bincount(owner[_SYMBOLS[np.minimum(points, 255)]], minlength=n)
        at = np.searchsorted(_LOWS, points, "right") - 1
        letter = (at >= 0) & (points <= _HIGHS[at])
        counts = np.bincount(owner[letter] * len(SCRIPTS) + _WHICH[at[letter]], minlength=n * len(SCRIPTS)).reshape(n, -1)
        rows[:, 2], rows[:, 3] = counts.argmax(axis=1), counts.max(axis=1)
        parts, cut = joined[:-1].split(" "), np.ones(n, np.int64)
        for i in np.flatnonzero(size > LONGEST)[::-1].tolist():
            w = parts[i]
            parts[i:i + 1] = [w[k:k + LONGEST] for k in range(0, len(w), LONGEST)]
            cut[i] = -(-len(w) // LONGEST)
        owner = np.repeat(np.arange(n), cut)
        ids, lengths = self.byte_tokens(parts)
        rows[:, 5] = np.bincount(owner, weights=lengths, minlength=n)
        rows[:, 4] = len(self.tokens) + np.cumsum(rows[:, 5]) - rows[:, 5]
        self.tokens = np.concatenate([self.tokens, ids.astype(np.int32)])
        ids, lengths = self.piece_tokens(parts)
        rows[:, 6] = np.bincount(owner, weights=lengths, minlength=n)
        rows[:, 7] = np.bincount(np.repeat(owner, lengths), weights=self.fallback[ids], minlength=n)
        self.about = np.concatenate([self.about, rows])
        self.new = []


_WORDS: dict[tuple[str, str], Words] = {}


def known_words(bytes_file: str, pieces_file: str) -> Words:
    key = bytes_file, pieces_file
    if key not in _WORDS:
        _WORDS[key] = Words(*key)
    return _WORDS[key]


def repeated(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row of words, how many lie in a window of three that its row has twice or more."""
    n = len(words)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    covered = np.zeros(n, bool)
    at = np.flatnonzero(rows[:-2] == rows[2:]) if n > 2 else np.zeros(0, np.int64)
    if len(at):
        if words.max() >= 1 << 21:
            pairs = np.unique(words[at] << 32 | words[at + 1], return_inverse=True)[1]
            key = np.unique(pairs << 32 | words[at + 2], return_inverse=True)[1]
        else:
            key = words[at] << 42 | words[at + 1] << 21 | words[at + 2]
        order = np.argsort(key, kind="stable")
        a, b = order[:-1], order[1:]
        same = (key[a] == key[b]) & (rows[at[a]] == rows[at[b]])
        for i in (a[same], b[same]):
            for k in range(3):
                covered[at[i] + k] = True
    return np.bincount(rows[covered], minlength=len(bounds) - 1)


def entropies(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of entropy of each row's tokens."""
    rows = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    key = np.sort(rows << 32 | tokens)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    sums = np.bincount(key[first] >> 32, weights=count * np.log2(count), minlength=len(bounds) - 1)
    total = np.maximum(1, np.diff(bounds))
    return np.maximum(0, np.log2(total) - sums / total)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_byte_tokens", "n_piece_tokens", "n_fallback"]


def measures(docs: DataFrame, bytes_file: str | None = None, pieces_file: str | None = None, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, the counts, entropy, script, text_hash) of every row."""
    common.ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash"))
    names = ["doc_id", "lang", "text_hash", *COUNTS, "entropy", "script"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words(bytes_file or public_tokenizers.path(BYTES), pieces_file or public_tokenizers.path(PIECES))
        for b in common.text_batches(batches, limit=BATCH_BYTES):
            if len(known) > REMEMBERED:
                known.clear()
            numbers, size, twice = [], [], []
            for t in b["text"].to_pylist():
                raw = t.encode()
                found = raw.split()
                numbers.extend(map(known.__getitem__, found))
                size.append(len(found))
                lines = [x for x in raw.split(b"\n") if x.strip()]
                twice.append(len(lines) - len(set(lines)))
            known.measure()
            numbers, n = np.array(numbers, np.int64), b.num_rows
            bounds = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            doc = np.repeat(np.arange(n), size)
            about = known.about[numbers]
            total = np.zeros((9, len(numbers) + 1), np.int64)
            np.cumsum(about.T, axis=1, out=total[:8, 1:])
            sums = total[:, bounds[1:]] - total[:, bounds[:-1]]
            where = np.repeat(about[:, 4] - total[5, :-1], about[:, 5]) + np.arange(total[5, -1])
            entropy = entropies(known.tokens[where], total[5, bounds])
            letters = np.bincount(doc * len(NAMES) + about[:, 2], weights=about[:, 3], minlength=n * len(NAMES)).reshape(n, -1)
            script = np.where(letters.max(axis=1) > 0, letters.argmax(axis=1), len(NAMES) - 1)
            columns = [np.array(size, np.int64), sums[0], sums[1], np.array(twice, np.int64), repeated(numbers, bounds), sums[5], sums[6], sums[7]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["lang"], b["text_hash"], *map(pa.array, columns), pa.array(entropy),
                                              pa.array([NAMES[i] for i in script], pa.string())], names)

    return rows.mapInArrow(run, "doc_id long, lang string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS) + ", entropy double, script string")


def judged(measured: DataFrame, least_words: int = LEAST_WORDS, share: float = REPEATED) -> DataFrame:
    """Adds base_failed, the class a text's bands belong to, and its four measures."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return (measured.withColumn("base_failed", (F.col("n_words") < least_words) | (F.col("n_repeat_words") > share * F.col("n_words")))
            .withColumn("kind", F.coalesce("lang", F.concat(F.lit("script:"), "script")))
            .withColumn("size", F.when(F.col("n_byte_tokens") > 0, F.floor(F.log2("n_byte_tokens"))).cast("int"))
            .withColumn("byte_fertility", ratio("word_chars", "n_byte_tokens")).withColumn("piece_fertility", ratio("word_chars", "n_piece_tokens"))
            .withColumn("fallback", ratio("n_fallback", "n_piece_tokens"))
            .withColumn("evenness", F.when(F.col("n_byte_tokens") > 1, F.col("entropy") / F.log2("n_byte_tokens"))))


def bands(texts: DataFrame, reach: float = REACH) -> DataFrame:
    """(kind, size, low and high of each measure) from the quartiles over different texts. ``texts`` are rows of ``judged``."""
    once = texts.where("not base_failed").groupBy("kind", "size", "text_hash").agg(*[F.first(m).alias(m) for m in LEAST])
    quartiles = once.groupBy("kind", "size").agg(*[F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in LEAST])
    out = []
    for m, (below, above, least) in LEAST.items():
        q = [F.col(m)[i] for i in range(3)]
        wide = [F.greatest(reach * (q[2] - q[0]), share * q[1], F.lit(least)) for share in (below, above)]
        out += [(q[0] - wide[0]).alias(f"{m}_low"), (q[2] + wide[1]).alias(f"{m}_high")]
    return quartiles.select("kind", "size", *out)


def rules(docs: DataFrame, bytes_file: str | None = None, pieces_file: str | None = None, reach: float = REACH,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the counts, base_failed, kept, its class and measures."""
    measured = judged(common.written(measures(docs, bytes_file, pieces_file, id_col, text_col, lang_col), "fertility"))
    # a row for each class: Spark broadcasts it if its files prove small
    limits = common.written(bands(measured, reach), "bands")
    inside = F.lit(True)
    for m in LEAST:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
    return measured.join(limits, ["kind", "size"], "left").select(
        "doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & inside).alias("kept"), "kind", *COUNTS[5:], "entropy", *LEAST)


def op12_quality_rules(spark, sf_dir: str) -> DataFrame:
    return rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
