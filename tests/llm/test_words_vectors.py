"""Spelling variants, quality rules and centroid clustering against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from boxoffice.llm import centroids, fertility, spelling

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ spelling variants

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def brute_variants(rows, every=199, length=6, count=5, ratio=5):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w if h % every else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    words = {w: k for w, k in n.items() if len(w) >= length and k >= count}
    out = {}
    for w, k in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= ratio * k else None
        out[w] = [w, form, w, k, len(near), form and words[form]]
    for row in out.values():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()), key=repr)


def got_variants(df, *args):
    return sorted(map(tuple, spelling.variants(df, *args).collect()), key=repr)


def test_a_list_scan_finds_each_near_pair():
    rng = random.Random(1)
    for _ in range(300):
        base = rng.randint(1, 5)
        some = sorted({bytes(rng.choices(b"abc", k=rng.choice([base, base + 1]))) for _ in range(rng.randint(2, 40))})
        want = {(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if len(a) == base and one_edit(a, b)}
        found = list(spelling.scan(some, base))
        assert len(found) == len(want) and {f[:2] for f in found} == want


@pytest.mark.parametrize("crowd", [4096, 3])
def test_variants_equal_brute_force(spark, crowd):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcABC é×", k=400))) for i in range(40)]
    rows += [(None, None), (None, "bbbaaa " * 30), (7, ""), (7, "zzzzzzz " * 9), (7, "zzzzzzz " * 9), (8, "a" * 50_000 + " abcabc")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string")
    want = brute_variants(rows, 7, 2, 2, 2)
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)
    assert got_variants(df, 7, 2, 2, 2, crowd) == want


def test_op11_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, spelling.op11_spelling_variants(spark, SF).collect()), key=repr) == brute_variants(rows)


def test_no_documents_have_no_variants(spark):
    assert got_variants(spark.createDataFrame([], "doc_id long, text string")) == []


# ------------------------------------------------------------------ quality rules

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), failed)


def brute_measures(text, known):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    parts = [w[k:k + 64] for w in words for k in range(0, len(w), 64)]
    coded = [t for p in parts for t in known.byte_level.encode_ordinary(" " + p)]
    pieces = [t for p in parts for t in known.pieces.encode(p)]
    share = [c / len(coded) for c in Counter(coded).values()]
    chars = sum(map(len, words))
    bits = -sum(x * math.log2(x) for x in share)
    return (chars / len(coded) if coded else None, chars / len(pieces) if pieces else None,
            sum(map(known.pieces.is_byte, pieces)) / len(pieces) if pieces else None, bits / math.log2(len(coded)) if len(coded) > 1 else None)


def odd_texts():
    rng = random.Random(3)
    letters = "abé,%ñ漢字я　 !.0\U0001f600"
    out = [None, "", " \n\t", "a", "x " * 60, "one two three " * 40, "\n".join(["same line", "same line", "", "other"] * 20), "w" * 100_000]
    return out + ["".join(rng.choices(letters + " \n\r", k=rng.randint(1, 900))) for _ in range(60)]


def test_counts_and_measures_equal_brute_force(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts)] + [(None, "b", "en", 1)],
                               "doc_id long, text string, lang string, n_words int")
    known = fertility.known_words(*map(fertility.public_tokenizers.path, (fertility.BYTES, fertility.PIECES)))
    rows = {r.doc_id: r for r in fertility.rules(df).collect()}
    assert len(rows) == len(texts) + 1 and not rows[None].kept
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(t), i
        for a, b in zip((r.byte_fertility, r.piece_fertility, r.fallback, r.evenness), brute_measures(t, known)):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
    assert rows[0].kind == "script:none" and rows[3].kind == "script:latin"


def test_words_beyond_the_packed_numbers():
    words = np.array([5, 6, 7, 5, 6, 7, 1, 5, 6], np.int64)
    bounds = np.array([0, 9, 9])
    assert fertility.repeated(words, bounds).tolist() == fertility.repeated(words + (1 << 21), bounds).tolist() == [6, 0]
    assert fertility.repeated(np.tile(words[:3], 2), np.array([0, 3, 6])).tolist() == [0, 0]      # not across rows


def test_bands_reject_junk_and_keep_prose(spark):
    docs, labels = spark.read.parquet(f"{SF[:-5]}0.01/documents.parquet"), spark.read.parquet(f"{SF[:-5]}0.01/labels.parquet")
    rows = fertility.rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(not r.kept for r in bad) >= 0.5 * len(bad)


def test_copies_do_not_narrow_a_band(spark):
    rng = random.Random(4)
    prose = [" ".join("".join(rng.choices("etaoin shrdlu".replace(" ", ""), k=rng.randint(2, 9))) for _ in range(200)) for _ in range(60)]
    rows = [(i, t, "en") for i, t in enumerate(prose)] + [(1000 + i, prose[0], "en") for i in range(500)]
    assert fertility.rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("not kept").count() == 0


def test_no_documents_have_no_rules(spark):
    assert fertility.rules(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


# ------------------------------------------------------------------ centroid clustering

def brute_clusters(rows, k=16, rounds=3, d=64):
    most = 1 << 27
    kept = [(i, [int(max(min(math.floor(64 * x) if abs(x) < 1e300 else math.copysign(most, x), most), -most)) for x in v])
            for i, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cents = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            own = [v for (_, v), g in zip(kept, got) if g[1] == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    got, cap = assign(), (1 << 63) - 1
    total = Counter()
    for dist, j in got:
        total[j] += dist
    return sorted(((i, j, dist, min(cap, total[j]), min(cap, sum(total.values())), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for (i, _), (dist, j) in zip(kept, got)), key=repr)


def got_clusters(df):
    return sorted(map(tuple, centroids.cluster(df).collect()), key=repr)


def test_clusters_equal_brute_force_on_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(120)]
    rows += [(None, [0.25] * 64), (3, [0.0] * 64), (3, [0.0] * 64), (3, [0.5] * 64), (500, [1e200] * 64), (501, [-1e200] * 32 + [1e-200] * 32),
             (502, None), (503, []), (504, [1.0] * 63), (505, [1.0] * 65), (506, [None] + [1.0] * 63), (507, [float("nan")] + [1.0] * 63),
             (508, [float("inf")] + [1.0] * 63)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    assert got_clusters(df) == brute_clusters(rows)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(i, [float(i % 2)] * 64) for i in range(5)]
    assert got_clusters(spark.createDataFrame(few, schema)) == brute_clusters(few)
    assert got_clusters(spark.createDataFrame([], schema)) == []


def test_bounds_skip_pairs_but_lose_none(spark):
    rng = np.random.default_rng(6)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    x = np.floor(64 * rng.normal(size=(2000, 64)) * np.geomspace(8, 0.05, 64) @ axes).astype(np.int64)
    c = x[:16]
    mean = x.mean(axis=0)
    turn = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    best, distance, verified = centroids.nearest(x, *centroids.project(x, mean, turn, 16), c, *centroids.project(c, mean, turn, 16))
    full = ((x[:, None] - c) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert verified < 0.3 * full.size


def test_op13_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as from '{SF}/embeddings.parquet'")
    want = con.execute(centroids.OP13_SQL).fetchall()
    assert sorted(map(tuple, centroids.op13_centroid_clustering(spark, SF).collect())) == sorted(want) and len(want) > 16


# ------------------------------------------------------------------ earlier operators at their limits

def test_neighbours_of_very_large_and_very_small_vectors(spark):
    from boxoffice.llm import ann
    rng = np.random.default_rng(7)
    scales = [1e200, 1e-200, 1.0, 1.0, 1e150, 1e-120, 1e90]
    rows = [(i, (rng.normal(size=8) * scales[i % 7]).tolist()) for i in range(140)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.common.written(ann.codes(df), "codes")
    got = {}
    for r in ann.search(index, index.where("id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 140, 20))
    v = {i: np.array(x) for i, x in rows}
    for q, found in got.items():
        exact = {i: float(ann.products(x[None], v[q])[0]) for i, x in v.items() if i != q}
        want = sorted(exact, key=lambda i: (-exact[i], i))[:20]
        assert [i for i, _ in found] == want and [s for _, s in found] == [exact[i] for i in want]


def test_next_document_of_repeated_ids_goes_by_text(spark):
    from boxoffice.llm import fingerprints
    rows = [(5, "b " * 20), (5, "a " * 20), (5, None), (6, "c " * 20), (4, "z " * 20)]
    want, ordered = set(), sorted(((i, t or "") for i, t in rows))
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        want.add((i, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]).encode()).hexdigest()))
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got.collect()} == want


def test_full_pieces_need_no_packing(spark):
    from boxoffice.llm import packing
    rows = [(i, "word " * n) for i, n in enumerate([1, 5, 40, 200, 64, 63, 0])]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), sequence=16).collect()
    used, pieces_of = {}, {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces_of.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
    for parts in pieces_of.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total
    assert len(pieces_of) == 7


def test_every_language_is_learned(spark, monkeypatch):
    from boxoffice.llm import langid
    words = {f"l{k:02d}": "".join(chr(97 + (k * 7 + j * 3) % 26) for j in range(5)) for k in range(70)}
    rows = [(k * 10 + j, " ".join([w] * (5 + j)), lang) for k, (lang, w) in enumerate(words.items()) for j in range(4)]
    monkeypatch.setattr(langid, "MAX_ROWS", 140)
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    learned = {x for names in model.members for x in names}
    have = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert learned == have and len(have) > 64
    none = langid.identify(spark.createDataFrame([], "doc_id long, text string"), model)
    assert none.count() == 0
