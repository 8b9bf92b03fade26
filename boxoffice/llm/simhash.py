"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: words are runs of bytes other than ASCII white space, A-Z lower-cased; each
three-word shingle (repeats counted; fewer words make one shingle) is hashed by XXH64
with seed 42, and a bit is set if it is set in over half of the hashes. No words: zero.

Links join fingerprints at most three bits apart. The 64 bits are grouped into
partitions of 32 so that correlated bits lie together (correlations over all distinct
fingerprints). If thresholds t1 + t2 = 3 - 1 for the two partitions, two fingerprints
within three bits are within t_i bits in some partition i (a threshold of -1 leaves a
partition out). Each fingerprint allots its own thresholds by dynamic programming over
the number of candidates estimated for every partition and threshold, plus the number of
keys to probe, so a partition value that many fingerprints share is probed at a smaller
radius and the other at a larger one. It then probes all values within its thresholds,
and candidates are verified on all bits.

Exact copies share a fingerprint and are joined as one node from the start; components
follow links through any number of steps.

Defined results: null, empty and word-less texts have fingerprint zero, linked like any
other; repeated rows each get their row; a component's id is its smallest non-null
doc_id (null, if it has none); other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm import common
from boxoffice.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
#: Bits in a partition, and in the histograms that candidate counts are estimated from.
WIDTH = 32
PART = 16

_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_BYTE_AT = np.arange(8) * 256


def simhash(text: str | None) -> int:
    """The fingerprint of one text."""
    words = text.encode().translate(_FOLD).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b"%b %b %b" % s, SEED) for s in zip(words, words[1:], words[2:])]
    split = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(2048, np.int64)
    for i in range(0, len(split), 1 << 20):
        ones += np.bincount((split[i:i + (1 << 20)] + _BYTE_AT).ravel(), minlength=2048)
    ones = (ones.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """(doc_id, fp) per row; fp holds the 64 bits as a long. No shuffle. ``keep_row``
    adds the whole input row as struct ``row``."""
    common.ship(docs.sparkSession)
    cols = [F.col(id_col).cast("long").alias("doc_id"),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if keep_row else F.col(text_col).cast("string").alias("text")]
    out = T.StructType().add("doc_id", "long").add("fp", "long")
    if keep_row:
        out.add("row", docs.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.small_batches(batches):
            texts = b["row"].field(text_col).cast(pa.string()) if keep_row else b["text"]
            fps = np.array([simhash(t) for t in texts.to_pylist()], np.uint64)
            rest = [b["row"]] if keep_row else []
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fps.view(np.int64)), *rest], out.fieldNames())

    return docs.select(*cols).mapInArrow(run, out)


def bit_groups(nodes: DataFrame, width: int = WIDTH) -> list[list[int]]:
    """Bits in groups of ``width``, correlated ones together: beginning with the bit of
    the strongest correlations, a group takes the bit most correlated with it until
    it is full."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros((BITS + 1, BITS), np.int64)
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 1 << 16):
                bits = ((fps[i:i + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                pairs[:BITS] += (bits.T @ bits).astype(np.int64)
                pairs[BITS, 0] += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(pairs.size)), pa.array(pairs.ravel())], ["cell", "n"])

    cells = nodes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros((BITS + 1) * BITS)
    for r in cells:
        pairs[r["cell"]] = r["n"]
    pairs = pairs.reshape(BITS + 1, BITS)
    n = max(1.0, pairs[BITS, 0])
    share = np.diag(pairs) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    near = np.abs(pairs[:BITS] / n - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(near, 0)
    left, groups = list(range(BITS)), []
    while left:
        group = [max(left, key=lambda i: (near[i, left].sum(), -i))]
        left.remove(group[0])
        while left and len(group) < width:
            group.append(max(left, key=lambda i: (near[i, group].sum(), -i)))
            left.remove(group[-1])
        groups.append(group)
    return groups


def project(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group``, packed."""
    out = np.zeros(len(fps), np.uint64)
    for k, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _around(share: np.ndarray, radius: int) -> np.ndarray:
    """For each value, the share of fingerprints at exactly 0..radius bits from it."""
    shells = [share]
    polynomial = [share, *[np.zeros_like(share) for _ in range(radius)]]
    for bit in range(PART):
        flipped = [p.reshape(-1, 2, 1 << bit)[:, ::-1].reshape(-1) for p in polynomial]
        polynomial = [polynomial[0], *[polynomial[t] + flipped[t - 1] for t in range(1, radius + 1)]]
    shells = polynomial
    return np.stack(shells)


def allot(fps: np.ndarray, groups: list[list[int]], around: np.ndarray, n: float, keys: list[int]) -> np.ndarray:
    """Thresholds of each fingerprint for each partition, at the least estimated cost:
    dynamic programming over the partitions and the sum of thresholds + 1 spent."""
    best = np.full((len(fps), DISTANCE + 2), np.inf)
    best[:, 0] = 0
    chosen = []
    for g, group in enumerate(groups):
        value = project(fps, group)
        parts = [around[g * (WIDTH // PART) + h][:, (value >> np.uint64(PART * h)).astype(np.int64) & ((1 << PART) - 1)]
                 for h in range(WIDTH // PART)]
        shells = parts[0]
        for p in parts[1:]:  # parts taken as independent
            shells = np.stack([sum(shells[s] * p[t - s] for s in range(t + 1)) for t in range(DISTANCE + 1)])
        cost = np.concatenate([np.zeros((1, len(fps))), n * np.cumsum(shells, axis=0) + np.array(keys)[:, None]])
        spent, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for total in range(DISTANCE + 2):
            for t in range(total + 1):  # t stands for threshold t - 1
                c = best[:, total - t] + cost[t]
                better = c < spent[:, total]
                spent[better, total], pick[better, total] = c[better], t
        best = spent
        chosen.append(pick)
    total = np.full(len(fps), DISTANCE + 1)  # sum of (t_i + 1) = distance + 1
    out = np.zeros((len(fps), len(groups)), np.int64)
    for g in range(len(groups) - 1, -1, -1):
        out[:, g] = chosen[g][np.arange(len(fps)), total]
        total = total - out[:, g]
    return out - 1


def links(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints in ``nodes`` (fp) at most three bits apart."""
    spark = nodes.sparkSession
    groups = bit_groups(nodes)
    n = float(nodes.count())

    def halves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(groups) * WIDTH // PART, 1 << PART), np.int64)
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for g, group in enumerate(groups):
                value = project(fps, group)
                for h in range(WIDTH // PART):
                    counts[g * (WIDTH // PART) + h] += np.bincount(
                        (value >> np.uint64(PART * h)).astype(np.int64) & ((1 << PART) - 1), minlength=1 << PART)
        cell = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts.ravel()[cell])], ["cell", "n"])

    counts = np.zeros(len(groups) * WIDTH // PART << PART)
    # at most 4 x 65,536 cells, whatever the number of documents
    for r in nodes.select("fp").mapInArrow(halves, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    around = np.stack([_around(c / max(1.0, n), DISTANCE) for c in counts.reshape(-1, 1 << PART)]).astype(np.float32)
    shared = spark.sparkContext.broadcast(around)  # 4 x 4 x 65,536 floats
    masks = [np.array([0], np.uint64)]
    for _ in range(DISTANCE):  # all values of exactly 1, 2, 3 bits
        one = np.uint64(1) << np.arange(WIDTH, dtype=np.uint64)
        more = (masks[-1][:, None] | one[None, :]).ravel()
        masks.append(np.unique(more[np.bitwise_count(more) == len(masks)]))
    balls = np.cumsum([len(m) for m in masks])
    within = np.concatenate(masks)

    def probes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(every), 4096):
                fps = every[i:i + 4096]
                thresholds = allot(fps, groups, shared.value, n, balls.tolist())
                for g, group in enumerate(groups):
                    value = project(fps, group)
                    for t in range(DISTANCE + 1):
                        own = np.flatnonzero(thresholds[:, g] == t)
                        step = max(1, (1 << 18) // int(balls[t]))
                        for k in range(0, len(own), step):
                            some = own[k:k + step]
                            key = (value[some, None] ^ within[None, :balls[t]]) | np.uint64(g << WIDTH)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(fps[some].view(np.int64), balls[t]))], ["key", "a"])

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for g, group in enumerate(groups):
                yield pa.RecordBatch.from_arrays([pa.array((project(fps, group) | np.uint64(g << WIDTH)).view(np.int64)),
                                                  pa.array(fps.view(np.int64))], ["key", "b"])

    probing = nodes.select("fp").mapInArrow(probes, "key long, a long")
    indexed = nodes.select("fp").mapInArrow(index, "key long, b long")
    return (probing.join(indexed.hint("shuffle_hash"), "key")
            .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
            .select("a", "b").distinct())


def grouped(nodes: DataFrame) -> DataFrame:
    """(fp, root) for each distinct fingerprint; root is one of its component's."""
    return (nodes.select("fp").join(components(links(nodes)).withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row."""
    prints = common.written(fingerprints(docs, id_col, text_col), "simhash")
    nodes = common.written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = common.written(grouped(nodes).join(nodes, "fp"), "simhash-roots")
    lowest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(lowest, "root").select("fp", "component_id")
    return (prints.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each component: that of the smallest doc_id (null
    last), of rows with the same id the first read."""
    rows = common.written(fingerprints(docs, id_col, text_col, keep_row=True)
                          .withColumn("at", F.monotonically_increasing_id()), "simhash-rows")
    roots = common.written(grouped(rows.select("fp").distinct()), "simhash-roots")
    keep = (rows.select("fp", "doc_id", "at").join(roots, "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "at")).alias("m")).select(F.col("m.at").alias("at")))
    return rows.join(keep, "at", "left_semi").select("row.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
