"""Toxicity by maximum-scoring segments.

Token scores are log-odds ratios between toxic and clean labelled documents under an
informative Dirichlet prior (the tokens' share in both), pulled towards zero by
``SIGMAS`` standard errors, so rare tokens score nothing. All other tokens score a small
negative drift. One linear scan per text finds every maximal scoring segment. Segments
of chance follow an extreme-value law: in clean text of n tokens about
K n exp(-lambda S) of them reach a score of S. lambda solves the law's equation for the
token scores of clean documents, K is fitted to their best segments, and the evidence of
a document is the sum of lambda S - ln(K n) over its significant segments, those for
which this is above 0 (ln(K n) taken as 0 at least). A logistic curve in the logarithm of 1 + evidence gives a probability; it is fitted on labelled
documents that the token scores have not seen.

Only labelled documents whose crc32(doc_id) mod 5 is not 0 are learned from: 1 to 3 give
token scores, 4 gives the calibration, at most ``MAX_TRAIN`` of each class and part (those
with the smallest hashes of their ids); where that leaves documents out, each one taken weighs as
many as its class and part has for each taken, so the share of toxic ones stays that of all labels,
whatever the size of the table. Every
text is scored whole, and from its text alone.

Defined results: null, empty and word-less texts have no segment, so no evidence; repeated rows each get their row; a null id counts as the empty text for
its fold; documents with several labels count as toxic if any says so; without toxic or
without clean labels every score is the share of toxic labels (0 without labels); other
columns are passed on in ``row`` or ignored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm import common

FOLDS = 5
MAX_TRAIN = 10_000
#: Documents that the prior weighs as much as; standard errors taken off a log-odds ratio.
PRIOR = 500.0
SIGMAS = 2.0
DRIFT = 0.05

_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


@dataclass
class Model:
    scores: dict[str, float]
    lam: float
    k: float
    slope: float
    bias: float
    base: float  # share of toxic labels

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        chance = max(0.0, math.log(self.k * max(1, n)))
        return sum(max(0.0, self.lam * s - chance) for _, _, s in segments)

    def probability(self, evidence: float) -> float:
        z = self.slope * math.log1p(evidence) + self.bias
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def segments(words: list[str], scores: dict[str, float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first token, end, score), in order. The scan
    holds a list of disjoint candidates; each knows the nearest one to its left that
    begins at a lower running total, so the list is never searched twice."""
    found: list[list] = []  # first, end, total before, total after, link
    total, at = 0.0, 0
    for i, w in enumerate(words):
        score = scores.get(w)
        if score is None:
            continue
        total -= drift * (i - at)
        at = i + 1
        before, total = total, total + score
        if score <= 0:
            continue
        first, low = i, before
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append([first, i + 1, low, total, j])
                break
            first, low = found[j][0], found[j][2]
            link = found[j][4]
            del found[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _lambda(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of mean(exp(lambda x score)) = 1."""
    share = counts / counts.sum()
    if not ((values > 0) & (share > 0)).any():
        return 1.0
    f = lambda x: float(np.sum(share * np.exp(np.minimum(x * values, 600)))) - 1
    low, high = 1e-9, 1e-3
    if f(low) >= 0:
        return 1e-3  # the scores do not fall on average: no law to hold to
    while f(high) < 0 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton steps; both classes weigh as they occur in all labels, each
    with one pseudo-count at its mean so that separable data stay finite."""
    toxic, clean = float((weight * y).sum()), float((weight * (1 - y)).sum())
    center, scale = float(x.mean()), float(x.std()) or 1.0
    z = (x - center) / scale
    target = np.where(y > 0, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    w, b = 0.0, math.log((toxic + 1) / (clean + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w * z + b, -30, 30)))
        g = np.array([np.sum(weight * (p - target) * z) + 1e-3 * w, np.sum(weight * (p - target))])
        v = weight * p * (1 - p) + 1e-9
        h = np.array([[np.sum(v * z * z) + 1e-3, np.sum(v * z)], [np.sum(v * z), np.sum(v)]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        w, b = w - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return w / scale, b - w * center / scale


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit on the bounded sample described above."""
    spark = docs.sparkSession
    common.ship(spark)
    labelled = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
                .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
                .withColumn("fold", common.crc_mod(F.col("doc_id"), FOLDS)).where("fold != 0"))
    part = F.when(F.col("fold") == FOLDS - 1, 1).otherwise(0)
    # labels of a (class, part) for each one taken
    weigh = {(r["y"], r["cal"]): max(1.0, r["n"] / MAX_TRAIN)
             for r in labelled.groupBy("y", part.alias("cal")).agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        for cal in (0, 1):
            some = (labelled.where((F.col("y") == y) & (part == cal)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
                    .select("doc_id", "y", F.lit(cal).alias("cal")))
            picked = some if picked is None else picked.union(some)
    sample = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(picked), "doc_id"))  # at most 4 x MAX_TRAIN ids

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()
        for b in batches:
            for text, y in zip(b["text"].to_pylist(), b["y"].to_pylist()):
                seen[y].update(set(tokens(text)))
                seen[y][""] += 1  # documents
            if len(seen[0]) + len(seen[1]) > 300_000:
                yield _rows(seen)
                seen = Counter(), Counter()
        yield _rows(seen)

    def _rows(seen) -> pa.RecordBatch:
        words = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[0][w] for w in words], pa.int64()),
                                           pa.array([seen[1][w] for w in words], pa.int64())], ["token", "clean", "toxic"])

    table = (sample.where("cal = 0").mapInArrow(count, "token string, clean long, toxic long")
             .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    table = common.written(table, "toxicity-tokens")
    n = table.where("token = ''").first()
    clean, toxic = (int(n["clean"]), int(n["toxic"])) if n else (0, 0)
    per_clean, per_toxic = (weigh.get((y, 0), 1.0) for y in (0, 1))
    every = per_clean * clean + per_toxic * toxic
    base = per_toxic * toxic / max(1, every)
    if not clean or not toxic:
        return Model({}, 1.0, 1.0, 0.0, math.log(base / (1 - base)) if 0 < base < 1 else (30.0 if base else -30.0), base)
    prior = F.lit(PRIOR) * (per_clean * F.col("clean") + per_toxic * F.col("toxic")) / F.lit(every)
    odds = (F.log((F.col("toxic") + prior) / (F.lit(toxic + PRIOR) - F.col("toxic") - prior + 1))
            - F.log((F.col("clean") + prior) / (F.lit(clean + PRIOR) - F.col("clean") - prior + 1)))
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    score = F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - SIGMAS * error)
    # the tokens of a bounded sample whose odds are beyond their error
    top = table.where("token != ''").select("token", score.alias("score")).where("score != 0").collect()
    scores = {r["token"]: r["score"] - DRIFT for r in top}

    def calibrate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(len(w := tokens(t)), [s for _, _, s in segments(w, scores)], Counter(s for x in w if (s := scores.get(x)) is not None))
                     for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b["y"], pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.float64())),
                pa.array([list(f[2]) for f in found], pa.list_(pa.float64())),
                pa.array([list(f[2].values()) for f in found], pa.list_(pa.int64()))], ["y", "n", "segments", "values", "counts"])

    cal = common.written(sample.where("cal = 1").mapInArrow(
        calibrate, "y int, n long, segments array<double>, values array<double>, counts array<long>"), "toxicity-calibration")
    law = cal.where("y = 0").select(F.explode(F.arrays_zip("values", "counts")).alias("v")).groupBy("v.values").agg(F.sum("v.counts").alias("c")).collect()
    rows = cal.select("y", "n", "segments").collect()  # at most 2 x MAX_TRAIN
    values, counts = np.array([r["values"] for r in law] + [-DRIFT]), np.array([r["c"] for r in law] + [0.0])
    counts[-1] = max(1.0, sum(r["n"] for r in rows if r["y"] == 0) - counts.sum())
    model = Model(scores, _lambda(values, counts), 1.0, 1.0, 0.0, base)
    reach = [max(1, r["n"]) * math.exp(-model.lam * max([0.0, *r["segments"]])) for r in rows if r["y"] == 0]
    model.k = 1 / max(1e-9, float(np.mean(reach))) if reach else 1.0
    y = np.array([r["y"] for r in rows], float)
    if 0 < y.sum() < len(y):
        x = np.array([model.evidence(r["n"], [(0, 0, s) for s in r["segments"]]) for r in rows])
        # evidence has a long tail, in which a few wrong labels would weigh more than all others
        model.slope, model.bias = _logistic(np.log1p(x), y, np.where(y > 0, weigh[1, 1], weigh[0, 1]))
        if model.slope <= 0:
            model.slope, model.bias = 0.0, math.log(base / (1 - base))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False,
          passages: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row, in one pass without a shuffle.
    ``keep_row`` adds the whole input row as struct ``row``; ``passages`` adds the
    significant segments as (first token, end token, score)."""
    common.ship(docs.sparkSession)
    cols = [F.col(id_col).cast("long").alias("doc_id"), (common.crc_mod(F.col(id_col), FOLDS) == 0).alias("held_out"),
            # the text goes to Python once, among the row's columns if these are kept
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if keep_row else F.col(text_col).cast("string").alias("text")]
    rows = docs.select(*cols)
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    if passages:
        out.add("passages", T.ArrayType(T.StructType().add("first", "long").add("end", "long").add("score", "double")))
    if keep_row:
        out.add(rows.schema["row"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.small_batches(batches):
            p, where = [], []
            for text in (b["row"].field(text_col).cast(pa.string()) if keep_row else b["text"]).to_pylist():
                words = tokens(text)
                found = segments(words, model.scores)
                p.append(model.probability(model.evidence(len(words), found)))
                if passages:
                    chance = max(0.0, math.log(model.k * max(1, len(words))))
                    where.append([{"first": a, "end": e, "score": s} for a, e, s in found if model.lam * s > chance])
            columns = [b["doc_id"], b["held_out"], pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())]
            if passages:
                columns.append(pa.array(where, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))))
            if keep_row:
                columns.append(b["row"])
            yield pa.RecordBatch.from_arrays(columns, out.fieldNames())

    return rows.mapInArrow(run, out)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
