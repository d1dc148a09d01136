"""Approximate nearest neighbours by a forest of hash prefixes (Bawa, Condie and Ganesan, "LSH Forest", 2005).

Every tree is a sorted array of long hash strings, the signs of random projections. A query descends in each
tree to its longest matching prefix and then ascends in all trees at once, one bit at a time, until the runs
that share the prefix hold enough candidates; those are compared exactly.

The rows are dealt over shards of bounded size, each with its own forest, and the queries visit the shards in
blocks; the best of all shards are merged. Largest inner products become smallest angles by one more
dimension that gives all vectors of a shard one length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsignal.llm.common import batches, grouped, staged

#: Vectors in a shard and queries in a block, about.
SHARD = 1 << 14
BLOCK = 1 << 12
TREES = 48
BITS = 24
#: Part of a shard's vectors that the ascent gathers at least. Neighbours of evenly spread vectors are hardly
#: nearer than others, so a recall of 0.9 needs many; clustered vectors need far fewer.
GATHER = 0.45
#: Places in runs that the ascent gathers at least, over all trees.
LEAST = 3000


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _hashes(vectors: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings as numbers, tree x vector; the same planes for all shards."""
    planes = np.random.default_rng(10).standard_normal((vectors.shape[1], trees * bits)).astype(np.float32)
    signs = (vectors.astype(np.float32) @ planes > 0).reshape(len(vectors), trees, bits)
    weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint32)
    return (signs * weights).sum(axis=2, dtype=np.uint32).T


def build(ids: np.ndarray, vectors: np.ndarray, trees: int, bits: int) -> dict:
    """A shard's forest: sorted hash strings per tree and the vectors behind them."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    squares = (vectors**2).sum(axis=1)
    more = np.sqrt(np.maximum(squares.max() - squares, 0))
    hashes = _hashes(np.column_stack((vectors, more)), trees, bits)
    at = np.argsort(hashes, axis=1, kind="stable").astype(np.int32)
    return {
        "n": len(ids),
        "ids": ids.astype(np.int64).tobytes(),
        "vectors": vectors.astype(np.float64).tobytes(),
        "hashes": np.take_along_axis(hashes, at, axis=1).tobytes(),
        "at": at.tobytes(),
    }


def search(forest: dict, own: np.ndarray, queries: np.ndarray, k: int, trees: int, bits: int, gather: float) -> tuple[np.ndarray, ...]:
    """``query, vec_id, score`` of the best ``k`` candidates of every query in a shard, but for the query itself."""
    n = forest["n"]
    ids = np.frombuffer(forest["ids"], np.int64)
    vectors = np.frombuffer(forest["vectors"], np.float64).reshape(n, -1)
    hashes = np.frombuffer(forest["hashes"], np.uint32).reshape(trees, n)
    at = np.frombuffer(forest["at"], np.int32).reshape(trees, n)
    keys = _hashes(np.column_stack((queries, np.zeros(len(queries)))), trees, bits)
    target = min(trees * n, max(LEAST, int(np.ceil(gather * n))))
    low, high = np.zeros((trees, len(queries)), np.int64), np.full((trees, len(queries)), n)
    open_ = np.arange(len(queries))
    for length in range(bits, -1, -1):  # the ascent: all trees give up the same bit
        step = np.uint32(bits - length)
        for tree in range(trees):
            prefix = (keys[tree, open_] >> step).astype(np.uint64)
            low[tree, open_] = np.searchsorted(hashes[tree], (prefix << np.uint64(step)).astype(np.uint32))
            high[tree, open_] = n - np.searchsorted(-hashes[tree][::-1].astype(np.int64), -((prefix + np.uint64(1)) << np.uint64(step)).astype(np.int64) + 1)
        open_ = open_[(high - low)[:, open_].sum(axis=0) < target]
        if not len(open_):
            break
    out_query, out_id, out_score = [], [], []
    near = np.zeros(n, bool)
    for q in range(len(queries)):
        near[:] = False
        for tree in range(trees):
            near[at[tree, low[tree, q] : high[tree, q]]] = True
        found = np.flatnonzero(near)
        found = found[ids[found] != own[q]]
        score = vectors[found] @ queries[q]
        if len(found) > 4 * k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            keep = score >= least - 1e-9
            found, score = found[keep], score[keep]
        # The order of sums in a product of many rows may differ, so scores are made one by one.
        score = np.array([float(np.sum(vectors[f] * queries[q])) for f in found])
        best = np.lexsort((ids[found], -score))[:k]
        out_query.append(np.full(len(best), own[q]))
        out_id.append(ids[found[best]])
        out_score.append(score[best])
    return np.concatenate(out_query), np.concatenate(out_id), np.concatenate(out_score)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, trees: int = TREES, bits: int = BITS, gather: float = GATHER) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every row that ``queries`` marks.

    ``vectors`` has ``vec_id`` and ``embedding``; nearness is the inner product in double precision, ties go to
    the smaller ``vec_id``. Null ids and unusable vectors take no part, nor do vectors of another length than most
    have (the shorter of two equally common). Rows that repeat an id and vector count once; of different vectors
    under one id the smallest counts. Fewer than ``k`` others give fewer rows; an empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), queries.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = staged(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("asks").alias("asks")), "vectors")
    lengths = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("embedding") == lengths.length)
    shards = max(1, -(-lengths["count"] // SHARD))

    def forests(pdf: pd.DataFrame) -> pd.DataFrame:
        forest = build(pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"].to_numpy()), trees, bits)
        return pd.DataFrame({"shard": pdf["shard"][:1], **{name: [value] for name, value in forest.items()}})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    index = staged(grouped(dealt, "shard", forests, "shard long, n long, ids binary, vectors binary, hashes binary, at binary"), "forests")

    def blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        return pd.DataFrame({"own": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "asked": [asked.tobytes()]})

    asking = rows.filter("asks")
    count = max(1, -(-asking.count() // BLOCK))
    asking = grouped(asking.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(count))), "block", blocks, "own binary, asked binary")
    visits = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(index, "shard")

    def visit(parts):
        for part in parts:
            for row in part.to_pylist():
                own = np.frombuffer(row["own"], np.int64)
                asked = np.frombuffer(row["asked"], np.float64).reshape(len(own), -1)
                found = search(row, own, asked, k, trees, bits, gather)
                yield pa.record_batch([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    found = batches(visits.select("own", "asked", "n", "ids", "vectors", "hashes", "at"), visit, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
