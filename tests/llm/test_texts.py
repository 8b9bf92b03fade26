"""Fingerprints, packing and byte-level BPE against brute force, with odd rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from boxoffice.llm import bpe, fingerprints, packing

ODD = [None, "", " \n\t", "word", "Two words", "a  b\n\n c\t", "x" * 5000, "é🙂 日本語 don't 123 " * 50, "\x1c \x85 İ! <|endoftext|>",
       " ".join(f"w{i % 977}" for i in range(30_000)), "same text of more than five words here", "same text of more than five words here"]


def docs(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "f", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, bucket int, row int")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_library(library):
    coder, rnd = bpe.codec(P.path(bpe.RANKS)), random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "'s", "1", "23", "!", "🙂", "\x1c", "the", "ing", "  \n ", "\xa0"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    texts += [t or "" for t in ODD] + ["".join(rnd.choice("abcdeth") for _ in range(20_000)), "ab" * 5000, "a" * 9999]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids == library.encode_ordinary(text), text[:80]
        assert coder.decode(ids) == text.encode()


def test_bpe_merges_no_word_again_that_stays(library, monkeypatch):
    """A full memory keeps the present batch's words; a line feed joins no two words to a new one."""
    coder, merged = bpe.Codec(P.path(bpe.RANKS)), []
    merge = coder.merge
    monkeypatch.setattr(bpe, "REMEMBERED", 30)
    monkeypatch.setattr(coder, "merge", lambda pieces: merged.extend(pieces) or merge(pieces))
    texts = ["x " + " ".join(f"{a}ork" for a in letters) for letters in ("bcdefgh", "bcdefgijklm", "bcdefgnopqr", "bcdefgstuvy")]
    for text in texts * 3:
        assert [*coder.encode([text, "bork cork\ndork"])] == [library.encode_ordinary(t) for t in (text, "bork cork\ndork")]
    assert merged.count(b" cork") == merged.count(b" eork") == 1
    assert len(coder.words) <= 30 and not any("\n" in w[1:] for w in coder.words)


def test_rank_queue_goes_by_rank():
    queue, rnd = bpe.RankQueue(50_000), random.Random(1)
    ranks = rnd.sample(range(50_000), 3000)
    for r in ranks:
        queue.fill(r, [r])
    assert [queue.open() for _ in ranks] == [(r, [r]) for r in sorted(ranks)]
    assert not any(any(words) for words in queue.levels)


def test_bpe_query_rows(spark, library):
    got = bpe.encode_decode(docs(spark, ODD, [0] * len(ODD))).collect()
    want = []
    for t in ODD:
        ids = library.encode_ordinary(t or "")
        want.append((0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
    assert bpe.encode_decode(docs(spark, [])).count() == 0


def test_words_tokenise_as_whole_texts():
    tok, lib, rnd = packing.tokenizer(P.path(packing.TOKENIZER)), Tokenizer.from_file(P.path(packing.TOKENIZER)), random.Random(5)
    parts = ["a", " ", "\n", "é", "日本", "'s", "1", "!", "🙂", "\x1c", "İ", "İ!", "ẞ", "Σ", "word's", "x!!", "<|endoftext|>", "ñ", "̃", "\x85", "\xa0", "(see)"]
    texts = [t or "" for t in ODD] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    for text, ids in zip(texts, tok.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_first_fit_decreasing_against_plain_search():
    rnd = random.Random(2)
    for n in (0, 1, 2, 37, 400):
        lengths = [rnd.randint(1, 100) for _ in range(n)]
        free, want = [], [None] * n
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
            free += [100] * (k == len(free))
            want[i] = k, 100 - free[k]
            free[k] -= lengths[i]
        assert packing.first_fit_decreasing(lengths, 100) == want


def test_packing_covers_each_id_once(spark, monkeypatch):
    lib = Tokenizer.from_file(P.path(packing.TOKENIZER))
    texts = ODD + ["one two three " * k for k in range(1, 40)]
    rows = packing.pack(docs(spark, texts)).collect()
    seqs = {}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [packing.END]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        for r in own:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in seqs.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
        assert sum(n for _, n in pieces) <= packing.SEQUENCE
    assert packing.pack(docs(spark, [])).count() == 0
    assert packing.pack(docs(spark, ["same"] * 50, [None] * 50)).count() == 50


def shingles(text, size=5):
    words = (text or "").split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_sketches_estimate_containment():
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(20_000)]
    long, short = " ".join(words), " ".join(words[3000:6000])
    a, b = fingerprints.sketches(pa.array([short, long]))
    assert fingerprints.likeness(a, b) == 1.0  # contained, though far shorter
    share = len(shingles(short)) / len(shingles(long))
    assert abs(fingerprints.likeness(b, a) - share) < 0.05
    joined = fingerprints.sketches(pa.array([short + " " + long]))[0][1]  # sketches merge by union
    assert set(a[1].tolist()) | set(b[1].tolist()) <= set(joined.tolist())
    # the same text has the same fingerprint wherever it stands in a batch
    assert fingerprints.sketches(pa.array(["x y", None, long, short]))[3][0] == a[0]


@pytest.mark.parametrize("rows", [3, 8192])
def test_edited_fingerprints_against_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", rows)
    texts = ODD + [f"text number {i} with some words of its own {i * 7} and {i * 13}" for i in range(20)]
    ids = list(range(0, 3 * len(texts), 3))
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs(spark, texts, ids)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        own, other, after = fingerprints.sketches(pa.array([t, edited, nxt]))
        r = got[ids[i]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own[0], other[0])
        assert r["near_edited"] == fingerprints.likeness(own, other) and r["near_next"] == fingerprints.likeness(own, after)


def test_fingerprints_of_few_rows(spark):
    assert fingerprints.edited_fingerprints(docs(spark, [])).count() == 0
    one = fingerprints.edited_fingerprints(docs(spark, ["a b c d e f g"])).first()
    assert one["near_next"] == 1.0
    assert fingerprints.edited_fingerprints(docs(spark, ["a", "b", "b"], [5, 5, None])).count() == 3
    same = {r["fingerprint"] for r in fingerprints.fingerprint(docs(spark, ODD[-2:])).collect()}
    assert len(same) == 1
