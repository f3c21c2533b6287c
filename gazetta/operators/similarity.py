"""Similar vectors and how far groups of vectors have moved.

Targets are a stated query set. They are compared, in blocks of bounded size, with batches of
all candidates: products of matrices, of which only rows over the threshold, and
of each batch only the k best for each target, go on. No pair frame is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions.vectors import TINY, cosine

#: Targets that are compared at once: every task holds so many vectors, and the driver no more.
BLOCK = 4096


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, "f8")
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(n > TINY, x / np.maximum(n, TINY), 0.0)


def _best(ids: np.ndarray, targets: np.ndarray, batch: pa.RecordBatch, least: float, k: int) -> pa.RecordBatch:
    """The k best candidates of a batch for each target."""
    own = np.array(batch.column("id").to_pylist(), "i8")
    s = targets @ _unit(batch.column("vector").to_pylist()).T
    s[ids[:, None] == own[None, :]] = -2
    t, c = np.nonzero(s > least)
    order = np.lexsort((own[c], -np.round(s[t, c], 12), t))
    t, c = t[order], c[order]
    first = np.searchsorted(t, t)  # where each target's rows begin
    best = np.arange(len(t)) - first < k
    t, c = t[best], c[best]
    return pa.RecordBatch.from_arrays([pa.array(ids[t]), pa.array(own[c]), pa.array(s[t, c])], names=["unique_id", "similar_id", "similarity"])


def _batch_best(batches: Iterator[pa.RecordBatch], shared, least: float, k: int) -> Iterator[pa.RecordBatch]:
    ids, targets = shared.value
    for batch in batches:
        if batch.num_rows:
            yield _best(ids, targets, batch, least, k)


def _block_best(batches: Iterator[pa.RecordBatch], least: float, k: int) -> Iterator[pa.RecordBatch]:
    """As _batch_best, of rows that come by (block, part), the block's targets first."""
    key, ids, vectors, units = None, [], [], None
    for batch in batches:
        names = [(x, y) for x, y in zip(*(batch.column(c).to_pylist() for c in ("block", "part")), strict=True)]
        targets = np.array(batch.column("target").to_pylist())
        edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1] or targets[i] != targets[i - 1]]
        for a, b in zip(edges, [*edges[1:], len(names)], strict=True):
            if names[a] != key:
                key, ids, vectors, units = names[a], [], [], None
            rows = batch.slice(a, b - a)
            if targets[a]:
                ids += rows.column("id").to_pylist()
                vectors += rows.column("vector").to_pylist()
            elif ids:
                units = _unit(vectors) if units is None else units
                yield _best(np.array(ids, "i8"), units, rows, least, k)


def similar_topk(targets: DataFrame, candidates: DataFrame, least: float = 0.8, k: int = 5) -> DataFrame:
    """unique_id, similar_id, similarity: the k most similar candidates over `least` of each target, itself excluded.

    Both frames: id (long), vector (null vectors are left out). Ties go to the smaller id. Up to BLOCK
    targets are broadcast; more are dealt into blocks of about that many, and candidates into parts,
    and each pair of block and part is one group, so no task or driver holds more than a block.
    """
    filled = candidates.where("vector is not null").select("id", "vector")
    targets = targets.where("vector is not null").select("id", "vector")
    schema = "unique_id long, similar_id long, similarity double"
    n = targets.count()
    if n <= BLOCK:
        rows = targets.collect()
        shared = targets.sparkSession.sparkContext.broadcast((np.array([r.id for r in rows], "i8"), _unit([r.vector for r in rows]) if rows else np.empty((0, 0))))
        found = filled.mapInArrow(lambda batches: _batch_best(batches, shared, least, k), schema) if rows else targets.sparkSession.createDataFrame([], schema)
    else:
        blocks, parts = -(-n // BLOCK), max(1, filled.rdd.getNumPartitions())
        group = lambda names, total: F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias(names)
        own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
        left = targets.select(F.lit(True).alias("target"), own, group("part", parts), "id", "vector")
        right = filled.select(F.lit(False).alias("target"), group("block", blocks), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "vector")
        dealt = left.unionByName(right).repartition("block", "part").sortWithinPartitions("block", "part", F.desc("target"))
        found = dealt.mapInArrow(lambda batches: _block_best(batches, least, k), schema)
    order = Window.partitionBy("unique_id").orderBy(F.desc(F.round("similarity", 12)), "similar_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def grouped(pairs: DataFrame) -> DataFrame:
    """unique_id, similar_articles: ids, the most similar first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("minus"), "similar_id")))
    return pairs.groupBy("unique_id").agg(F.transform(ordered, lambda x: x["similar_id"]).alias("similar_articles"))


def _batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each key of a batch the sum of its vectors and their number."""
    for batch in batches:
        keys, at = np.unique(np.array(batch.column("key").to_pylist(), object).astype(str), return_inverse=True)
        rows = batch.column("vector").to_pylist()
        first = {int(k): i for i, k in reversed([*enumerate(at)])}
        sizes = sorted({len(r) for r in rows})
        for size in sizes:  # vectors of one length are added up at once
            own = np.array([i for i, r in enumerate(rows) if len(r) == size])
            sums = np.zeros((len(keys), size))
            np.add.at(sums, at[own], np.array([rows[i] for i in own], "f8"))
            n = np.bincount(at[own], minlength=len(keys))
            used = np.flatnonzero(n)
            names = batch.column("key").take(pa.array([first[int(k)] for k in used]))
            yield pa.RecordBatch.from_arrays([names, pa.array(list(sums[used]), pa.list_(pa.float64())), pa.array(n[used], pa.int64())], names=["key", "sums", "n"])


def centroids(rows: DataFrame, key: str) -> DataFrame:
    """key, centroid of the vectors of each key; null keys and vectors are left out. Batches add up their vectors first."""
    kind = rows.schema[key].dataType.simpleString()
    filled = rows.where(F.col(key).isNotNull() & F.col("vector").isNotNull()).select(F.col(key).alias("key"), "vector")
    sums = filled.mapInArrow(lambda batches: _batch_sums(batches), f"key {kind}, sums array<double>, n long")
    dims = sums.select("key", "n", F.posexplode("sums").alias("d", "x")).groupBy("key", "d").agg((F.sum("x") / F.sum("n")).alias("x"))
    return dims.groupBy(F.col("key").alias(key)).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda e: e["x"]).alias("centroid"))


def novelty(window: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """key, novelty: 1 - mean cosine of the window's vectors to the baseline's centroid."""
    near = window.join(centroids(baseline, key), key)
    return near.groupBy(key).agg((1 - F.avg(cosine(F.col("vector"), F.col("centroid")))).alias("novelty"))
