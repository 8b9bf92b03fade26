"""Centroid clustering by PCA-rotated filtering, in exact integers.

A vector's components x become integers floor(64 x). One pass over all vectors sums their
covariance, whose eigenvectors rotate the space so that the first coordinates carry most
of the distance. The index, written once, stores for every vector its integers, its
leading rotated coordinates and the norm of the rest. For a centroid c the squared distance
is at least the squared distance of the leading coordinates plus the squared difference
of the two residual norms, so only centroids whose bound does not exceed the exact
distance to the most promising one are verified, in 64-bit integers. The rotation decides
how many are verified, never the result: bounds are lowered by more than their rounding.

Each round is one pass over the index. A task adds up its own vectors by cluster before
anything is shuffled; k times d sums reach the driver. No group is ever held together.

Defined results: vectors that are null, of another length or that hold null or non-finite
components take no part; components beyond +-2^27 after scaling count as +-2^27, so that
squared distances fit 64 bits; a null id counts as the empty text in the starting order and
stays null; repeated rows are vectors each; equal hashes go by components; fewer vectors
than k give as many centroids; ties go to the smaller number; inertias beyond 64 bits are the
largest 64-bit integer; no vectors give no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common

K, ROUNDS, D, SCALE = 16, 3, 64, 64
SEED = "1:"
#: Leading rotated coordinates that are stored.
LEADING = 16
#: Largest component after scaling.
LARGEST = 1 << 27
#: Rows that are compared with all centroids at a time.
ROWS = 4096
MOST = (1 << 63) - 1


def kept(vectors: DataFrame, d: int = D, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): the vectors that take part, as integers."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.coalesce(
        (F.size("x") == d) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False)))
    most = F.lit(float(LARGEST))
    return rows.select("id", F.transform("x", lambda c: F.floor(F.greatest(F.least(c * scale, most), -most)).cast("int")).alias("v"))


def starting(vectors: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes; a sorted limit, of which each task keeps k rows."""
    h = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["v"] for r in vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()], np.int64)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def rotation(vectors: DataFrame, d: int = D) -> tuple[np.ndarray, np.ndarray]:
    """Mean and eigenvectors (largest first) of the covariance of all vectors."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for b in batches:
            x = np.hstack([_matrix(b["v"], d), np.ones((b.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    sums = np.zeros((d + 1, d + 1))
    parts = vectors.select("v").mapInArrow(run, "i long, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    for r in parts.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        sums[r["i"], r["j"]] = r["x"]
    n = max(1.0, sums[d, d])
    mean = sums[d, :d] / n
    values, axes = np.linalg.eigh(sums[:d, :d] / n - np.outer(mean, mean))
    return mean, axes[:, np.argsort(-values)]


def project(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the others."""
    turned = (x - mean) @ axes
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))


def index(vectors: DataFrame, mean: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> DataFrame:
    """(id, v, lead, rest) of every vector, written."""
    d = len(mean)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead, rest = project(_matrix(b["v"], d), mean, axes, leading)
            at = pa.array(np.arange(0, lead.size + 1, lead.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b["id"], b["v"], pa.ListArray.from_arrays(at, pa.array(lead.ravel())), pa.array(rest)],
                                             ["id", "v", "lead", "rest"])

    return common.written(vectors.mapInArrow(run, "id long, v array<int>, lead array<double>, rest double"), "vectors")


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray,
            c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each row's nearest centroid, and how many pairs were verified."""
    own, theirs = (lead ** 2).sum(axis=1) + rest ** 2, (c_lead ** 2).sum(axis=1) + c_rest ** 2
    bound = own[:, None] + theirs - 2 * (lead @ c_lead.T + np.outer(rest, c_rest))
    # the products are rounded in proportion to the norms
    bound -= 1e-10 * (own[:, None] + theirs) + 1e-3
    first = bound.argmin(axis=1)
    rows = np.arange(len(x))
    exact = np.full(bound.shape, MOST, np.int64)
    exact[rows, first] = ((x - centroids[first]) ** 2).sum(axis=1)
    bound[rows, first] = np.inf
    r, c = np.nonzero(bound <= exact[rows, first][:, None])
    exact[r, c] = ((x[r] - centroids[c]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[rows, best], len(x) + len(r)


def _blocks(batches, d: int, leading: int):
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            part = b.slice(i, ROWS)
            yield part, _matrix(part["v"], d).astype(np.int64), _matrix(part["lead"], leading), part["rest"].to_numpy()


def moved(rows: DataFrame, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> np.ndarray:
    """The centroids after one round."""
    k, d = centroids.shape
    c_lead, c_rest = project(centroids, mean, axes, leading)

    def run(batches) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for _, x, lead, rest in _blocks(batches, d, leading):
            best, _, _ = nearest(x, lead, rest, centroids, c_lead, c_rest)
            count += np.bincount(best, minlength=k)
            np.add.at(sums, best, x)
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(count[there]), pa.array(sums[there].tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    parts = rows.mapInArrow(run, "cluster long, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("j", "x"))
    out = centroids.copy()
    # k times d rows
    for r in parts.groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        out[r["cluster"], r["j"]] = int(r["x"]) // r["n"]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> DataFrame:
    """(vec_id, cluster, distance) of every vector, written."""
    d = centroids.shape[1]
    c_lead, c_rest = project(centroids, mean, axes, leading)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, x, lead, rest in _blocks(batches, d, leading):
            best, distance, _ = nearest(x, lead, rest, centroids, c_lead, c_rest)
            yield pa.RecordBatch.from_arrays([part["id"], pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return common.written(rows.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, d: int = D, scale: int = SCALE, seed: str = SEED,
            leading: int = LEADING, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: its cluster, squared distance, both inertias, and the digest of its centroid."""
    spark = vectors.sparkSession
    common.ship(spark)
    ints = kept(vectors, d, scale, id_col, vector_col)
    centroids = starting(ints, k, seed)
    names = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if len(centroids) == 0:
        return spark.createDataFrame([], names)
    mean, axes = rotation(ints, d)
    rows = index(ints, mean, axes, leading)
    for _ in range(rounds):
        centroids = moved(rows, centroids, mean, axes, leading)
    found = assigned(rows, centroids, mean, axes, leading)
    # one row per centroid
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = min(MOST, sum(sums.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(i, min(MOST, sums.get(i, 0)), total, h) for i, h in enumerate(digest)],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(*[c.split()[0] for c in names.split(", ")])


def op13_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """The same rounds by plain comparison with every centroid."""
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    ctes = [f"""vectors as (select row_number() over () as rid, vec_id, list_transform(embedding,
        lambda x: cast(floor(greatest(least(cast(x as double) * {SCALE}, {LARGEST}), -{LARGEST})) as bigint)) as v from embeddings
    where len(embedding) = {D} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {D})""",
            f"""c0 as (select row_number() over (order by sha256('{SEED}' || coalesce(cast(vec_id as varchar), '')), v) - 1 as cluster, v as c
    from vectors qualify cluster < {K})"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} as (select rid, vec_id, v, cluster, {far} as distance from vectors, c{i}
    qualify row_number() over (partition by rid order by distance, cluster) = 1)""")
        if i < ROUNDS:
            ctes.append(f"""m{i} as (select cluster, list((s - ((s % n) + n) % n) // n order by j) as c from (
        select cluster, j, sum(x) as s, count(*) as n from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as j from a{i})
        group by cluster, j) group by cluster),
    c{i + 1} as (select c{i}.cluster, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} using (cluster))""")
    return "with " + ",\n".join(ctes) + f"""
select vec_id, cast(a.cluster as integer) as cluster, cast(distance as bigint) as distance,
    cast(sum(distance) over (partition by a.cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
    sha256(array_to_string(c, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} using (cluster)"""


OP13_SQL = _sql()
