"""Language identification by hierarchical discrimination.

A text's features are the shares of hashed character bigrams and trigrams over its
lower-cased letters (all else is a word border). A multinomial logistic model predicts
the language family; within it, one-versus-one linear support vector machines vote
between its languages (most votes, then the largest sum of margins). Both are trained by
Spark on a bounded sample of the documents whose crc32(doc_id) mod 4 is not 2: ``MAX_ROWS`` are
shared out evenly among all languages, at most ``MAX_PER_LANGUAGE`` to each (those with
the smallest hashes of their ids); every language is learned.
Prediction reads whole texts and nothing else; all models are linear in the shares, so
a text of any length costs one look-up per character and model.

Defined results: null texts and texts without a letter are ``und`` with score 0; without
any labelled document all are ``und``; a language outside the family table is its own
family; repeated rows each get their row; a null id counts as the empty text for its
fold; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm import common

FOLDS, HELD_OUT = 4, 2
MAX_PER_LANGUAGE = 1000
MAX_ROWS = 64_000
DIMENSIONS = 1 << 13
SCALE = 100.0

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv ms tl",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], lang)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def features(text: str | None) -> np.ndarray:
    """Hashed places of the text's bigrams and trigrams (none: no letter)."""
    points = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one border after each word
    keep[0] = True
    code = np.where(letter, points, 32)[keep].astype(np.uint64)
    two = code[:-1] * np.uint64(0x9E3779B1) + code[1:]
    three = two[:-1] * np.uint64(0x85EBCA77) + code[2:]
    both = np.concatenate([two, three]) * np.uint64(0x9E3779B97F4A7C15)
    return (both >> np.uint64(64 - 13)).astype(np.int64)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    members: list[list[str]] = field(default_factory=list)
    family_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS + 1)))
    #: by family: (first member, second member, weights; positive for the first)
    pairs: list[list[tuple[int, int, np.ndarray]]] = field(default_factory=list)

    def predict(self, text: str | None) -> tuple[str, float]:
        places = features(text)
        if len(places) == 0 or not self.families:
            return "und", 0.0
        share = np.bincount(places, minlength=DIMENSIONS) * (SCALE / len(places))
        z = self.family_weights[:, :-1] @ share + self.family_weights[:, -1]
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        names = self.members[best]
        votes, margins, sure = np.zeros(len(names)), np.zeros(len(names)), np.ones(len(names))
        for a, b, w in self.pairs[best]:
            m = float(w[:-1] @ share + w[-1])
            votes[a if m >= 0 else b] += 1
            margins[a] += m
            margins[b] -= m
            q = 1 / (1 + np.exp(-2 * np.clip(m, -30, 30)))
            sure[a], sure[b] = min(sure[a], q), min(sure[b], 1 - q)
        one = max(range(len(names)), key=lambda i: (votes[i], margins[i], -i))
        return names[one], float(min(1.0, p[best] * sure[one]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       common.crc_mod(F.col(id_col), FOLDS).alias("fold"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("fold") != HELD_OUT) & F.col("doc_id").isNotNull())
    # a row for each language: Spark broadcasts them if their files prove small
    sizes = common.written(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    n_langs = sizes.count()
    if not n_langs:
        return Model()
    quota = max(1, min(MAX_PER_LANGUAGE, MAX_ROWS // n_langs))
    # hashes below a bound that lets through about four times the quota, of which the smallest count
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    some = known.withColumn("place", place).join(sizes, "lang").where(F.col("place") * F.col("n") <= 4.0 * quota + 100)
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    sample = some.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= quota).select("doc_id", "text", "lang")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, shares, lang = [], [], []
            for text, name in zip(b["text"].to_pylist(), b["lang"].to_pylist()):
                places = features(text)
                if len(places):
                    n = np.bincount(places, minlength=DIMENSIONS)
                    at.append(np.flatnonzero(n).tolist())
                    shares.append((n[n > 0] * (SCALE / len(places))).tolist())
                    lang.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(shares, pa.list_(pa.float64()))], ["lang", "at", "shares"])

    vector = F.udf(lambda at, shares: Vectors.sparse(DIMENSIONS, at, shares), VectorUDT())  # the bounded sample only
    data = common.written(sample.mapInArrow(count, "lang string, at array<int>, shares array<double>"), "langid")
    found = sorted(r["lang"] for r in data.select("lang").distinct().collect())
    if not found:
        return Model()
    families = sorted({family(x) for x in found})
    members = [[x for x in found if family(x) == f] for f in families]
    index = F.create_map(*[F.lit(x) for lang in found for x in (lang, float(families.index(family(lang))))])
    data = data.select("lang", vector("at", "shares").alias("features"), index[F.col("lang")].alias("label")).repartition(
        3).cache()
    model = Model(families, members, np.zeros((len(families), DIMENSIONS + 1)), [[] for _ in families])
    if len(families) > 1:
        fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=20).fit(data)
        model.family_weights = np.hstack([fit.coefficientMatrix.toArray(), fit.interceptVector.toArray()[:, None]])
    for f, names in enumerate(members):
        for a in range(len(names)):
            for b in range(a + 1, len(names)):
                two = data.where(F.col("lang").isin(names[a], names[b])).withColumn(
                    "label", F.when(F.col("lang") == names[a], 1.0).otherwise(0.0))
                fit = LinearSVC(regParam=1e-3, maxIter=20).fit(two)
                model.pairs[f].append((a, b, np.append(fit.coefficients.toArray(), fit.intercept)))
    data.unpersist()
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row; no shuffle."""
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by languages x DIMENSIONS
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       (common.crc_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.text_batches(batches):
            found = [shared.value.predict(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array([x[0] for x in found], pa.string()),
                                              pa.array([x[1] for x in found], pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(docs))
