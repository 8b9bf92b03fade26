"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is normalised, rotated by one random orthogonal matrix (fixed seed) and kept
as the signs of its components, packed, with two scalars: its length, and the inner
product of the rotated unit vector with its own code vector (signs / sqrt(d)). For a
query q the inner product with a vector o is estimated as |o| <q, code> / <o, code>; the
error is below |o||q| sqrt((1 - <o, code>^2) / <o, code>^2) E / sqrt(d - 1) with a
probability that grows fast with E. A vector is reranked by its exact inner product if
its upper bound reaches the k-th largest lower bound of the query, so the bounds, not a
fixed number, choose how many are reranked. Estimates are of vectors of usual size: those with
a largest component beyond ``USUAL``, whose products may leave the range of doubles,
are compared exactly with all.

Queries and candidates are dealt into blocks by hashes of their ids; each pair of blocks
is one task group of bounded size, which scans packed codes and returns its best k for
each query; these are merged by query.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part; a query meets only vectors of its own length; a null id takes no part; repeated
ids are candidates each, but never of their own id's query; a repeated query id counts
once (the vector first in order); ties go to the smaller id; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm import common

K = 20
EVERY = 20
#: Multiple of the error's scale that a bound allows for.
BOUND = 4.0
SEED = 9
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
#: Largest components whose squares and products are doubles of full precision.
USUAL = 1e-100, 1e100

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    if d not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(SEED + d).standard_normal((d, d)))
        _ROTATIONS[d] = q * np.sign(np.diag(r))
    return _ROTATIONS[d]


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths, and inner products of unit vectors with their codes."""
    unit = vectors / np.abs(vectors).max(axis=1)[:, None]
    size = np.sqrt((unit * unit).sum(axis=1))
    turned = (unit / size[:, None]) @ rotation(vectors.shape[1])
    with np.errstate(over="ignore"):
        length = np.abs(vectors).max(axis=1) * size
    return np.packbits(turned >= 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def usual(vectors: np.ndarray) -> np.ndarray:
    most = np.abs(vectors).max(axis=1, initial=0)
    return (most >= USUAL[0]) & (most <= USUAL[1])


def products(o: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision; where a sum leaves the range, of vectors scaled to it."""
    with np.errstate(over="ignore", invalid="ignore"):
        exact = (o * q).sum(axis=1)
        odd = np.flatnonzero(~np.isfinite(exact))
        if len(odd):
            a, b = np.abs(o[odd]).max(axis=1), np.abs(q).max()
            exact[odd] = ((o[odd] / a[:, None]) * (q / b)).sum(axis=1) * a * b
    return exact


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, d, vector, code, length, own): the index, over every valid vector."""
    common.ship(vectors.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(F.coalesce(
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0),
        F.lit(False)))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.diff(b["vector"].offsets.to_numpy())
            flat = b["vector"].flatten().to_numpy()
            at = np.cumsum(size) - size
            n = b.num_rows
            code, length, own = [None] * n, np.zeros(n), np.zeros(n)
            for d in np.unique(size):
                some = np.flatnonzero(size == d)
                c, length[some], own[some] = encode(flat[at[some, None] + np.arange(d)])
                for i, x in zip(some.tolist(), c):
                    code[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(size.astype(np.int64)), b["vector"], pa.array(code, pa.binary()),
                                              pa.array(length), pa.array(own)], ["id", "d", "vector", "code", "length", "own"])

    return rows.mapInArrow(run, "id long, d long, vector array<double>, code binary, length double, own double")


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, d) if len(column) else np.zeros((0, d))


def best(queries: pa.Table, candidates: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's best k of the block and any tied with them."""
    d = queries["d"][0].as_py()
    q, o = _matrix(queries["vector"], d), _matrix(candidates["vector"], d)
    qid, oid = queries["id"].to_numpy(), candidates["id"].to_numpy()
    length, own = candidates["length"].to_numpy(), np.maximum(candidates["own"].to_numpy(), 1e-12)
    packed = np.frombuffer(b"".join(candidates["code"].to_pylist()), np.uint8).reshape(len(oid), -1)
    signs = np.unpackbits(packed, axis=1, count=d).astype(np.float32) * 2 - 1
    plain, asked = usual(o), usual(q)
    length = np.where(plain, length, 0.0)
    # a query's own scale does not change the order of its products
    own_q = np.where(asked[:, None], q, 0.0)
    own_q = own_q / np.maximum(np.abs(own_q).max(axis=1, initial=0), USUAL[0])[:, None]
    turned = (own_q @ rotation(d)).astype(np.float32)
    qlength = np.sqrt((own_q * own_q).sum(axis=1))
    spread = length * np.sqrt(np.maximum(0, 1 - own * own)) / own * (BOUND / np.sqrt(max(1, d - 1)))
    # rounding of the 32-bit products
    spread = spread + length * 1e-5 * np.sqrt(d) / own
    out: list[tuple] = []
    for i in range(0, len(qid), 64):
        estimate = (turned[i:i + 64] @ signs.T) * (length / (own * np.sqrt(d)))
        error = qlength[i:i + 64, None] * spread
        error[:, ~plain] = np.inf
        error[~asked[i:i + 64]] = np.inf
        other = qid[i:i + 64, None] != oid[None, :]
        low = np.where(other, estimate - error, -np.inf)
        kth = np.partition(low, len(oid) - k, axis=1)[:, len(oid) - k] if len(oid) > k else np.full(len(low), -np.inf)
        near = (estimate + error >= kth[:, None]) & other
        for r in range(len(low)):
            at = np.flatnonzero(near[r])
            exact = products(o[at], q[i + r])
            order = np.lexsort((oid[at], -exact))[:k]
            out.append((np.full(len(order), qid[i + r]), oid[at[order]], exact[order]))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by inner product.
    ``queries`` are rows of ``index``."""
    queries = queries.select("id", "d", "vector").groupBy("id").agg(F.min_by(F.struct("d", "vector"), F.struct("d", "vector")).alias("v"))
    queries = queries.select("id", "v.*")
    n, m = index.count(), queries.count()
    across, down = max(1, -(-m // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(across)))
         .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(down - 1)).cast("array<long>"))))
    c = (index.withColumn("cb", F.pmod(F.xxhash64("id", "vector"), F.lit(down)))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(across - 1)).cast("array<long>"))))
    names = ["query_id", "vec_id", "score"]

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        return pa.table(list(map(pa.array, best(left, right, k))), names=names)

    found = q.groupBy("qb", "cb", "d").cogroup(c.groupBy("qb", "cb", "d")).applyInArrow(pair, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def op9_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    index = common.written(codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "codes")
    return search(index, index.where(F.col("id") % EVERY == 0))
