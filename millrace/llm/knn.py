"""Exact top-k by integer inner product, with a KD-tree in every shard (operator 5).

Vectors are dealt into shards of bounded size. A shard builds a tree by median splits on the widest side and keeps a tight box for
each node. The largest inner product that a box allows is the sum of max(q * low, q * high); a query takes nodes best first by it and
stops when it falls below the kth score it has. That score starts from a bounded sample of all vectors, so every shard begins
with a kth score that holds for the whole table. Queries come in blocks of bounded size, each against all shards.

Defined results: vectors that are null or hold null, NaN or infinite components, and rows without an id, take no part; an empty vector
scores 0; a shorter vector counts as filled up with zeros. Rows of the query's own id are never its candidates; any other
repeated row is a candidate of its own, and a query id is asked once. Scores outside 64 bits are cut to their range.
Without queries there are no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

SCALE = 256
LEAF = 128
SHARD_ROWS = 1 << 14
QUERY_BLOCK = 1 << 13
SEED_ROWS = 1 << 10
EXACT = float(1 << 53)

FOUND = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, ok)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Scaled and rounded down, filled up with zeros to ``width``."""
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.floor(SCALE * np.asarray(vectors.flatten(), np.float64))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products of all queries (first) and rows: in floats where every sum stays below 2^53, else in Python's integers."""
    most = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(1, rows.shape[1])
    if most < EXACT:
        return queries @ rows.T
    whole = [[sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows] for query in queries]
    return np.array([[max(-(1 << 63), min((1 << 63) - 1, x)) for x in line] for line in whole], np.int64)


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[:len(vector)] = vector
    return out


class Tree:
    """Nodes in arrays: tight boxes, children (-1 at a leaf), and the range of ``order`` that each holds."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        low, high, self.left, self.right, self.range = [], [], [], [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = points[self.order[a:b]]
            node = len(low)
            low.append(own.min(0))
            high.append(own.max(0))
            self.left.append(-1)
            self.right.append(-1)
            self.range.append((a, b))
            if parent >= 0:
                (self.left, self.right)[side][parent] = node
            width = high[-1] - low[-1]
            if b - a > LEAF and width.max(initial=0) > 0:
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, int(width.argmax())], middle)]
                todo += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, no less than the inner product of the query and any point of the node."""
        found = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        return found + np.abs(found) * 1e-9

    def best(self, query: np.ndarray, bounds: np.ndarray, ids: np.ndarray, own: int, k: int, kth: float,
             exact: bool) -> list[tuple]:
        """The k highest (score, -id), and none that is below ``kth``; equal scores keep the smaller id."""
        top: list[tuple[int, int]] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.order[slice(*self.range[node])]
            own_points = self.points[rows]
            scores = own_points @ query if exact else products(own_points, query[None])[0]
            good = np.flatnonzero((scores >= kth) & (ids[rows] != own))
            for at in good:
                item = (int(scores[at]), -int(ids[rows[at]]))
                if len(top) < k:
                    heapq.heappush(top, item)
                elif item > top[0]:
                    heapq.heapreplace(top, item)
            if len(top) == k:
                kth = max(kth, top[0][0])
        return top


def _searcher(query_ids: np.ndarray, queries: list[np.ndarray], kths: np.ndarray, k: int
              ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # a shard
        if not sum(p.num_rows for p in parts):
            return
        table = pa.Table.from_batches(parts)
        vectors, ids = table.column("vector").combine_chunks(), table.column("vec_id").to_numpy()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = pa.concat_arrays(vectors.chunks)
        width = max([len(q) for q in queries] + [int(np.diff(np.asarray(vectors.offsets)).max(initial=0))])
        tree = Tree(_matrix(vectors, width))
        asked, found = padded(queries, width), []
        exact = np.abs(tree.points).max(initial=0) * np.abs(asked).max(initial=0) * max(1, width) < EXACT
        for first in range(0, len(asked), 256):
            block = asked[first:first + 256]
            bounds = tree.bounds(block)
            for n, query in enumerate(block):
                own = int(query_ids[first + n])
                for score, vec_id in tree.best(query, bounds[n], ids, own, k, kths[first + n], exact):
                    found.append((own, -vec_id, score))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                             names=["query_id", "vec_id", "score"])
    return search


def _first_kths(query_ids: np.ndarray, queries: list[np.ndarray], ids: np.ndarray, seeds: list[np.ndarray], k: int) -> np.ndarray:
    """For each query a score that its k best rows reach: the kth best of the seeds, less its own row."""
    width = max([0, *map(len, queries), *map(len, seeds)])
    scores = products(padded(seeds, width), padded(queries, width)).astype(np.float64)
    scores[query_ids[:, None] == ids] = -np.inf
    return np.sort(scores, 1)[:, -k] if scores.shape[1] >= k else np.full(len(queries), -np.inf)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of (vec_id, vector) that ``is_query`` holds for, its k best others."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    shards = rows.repartition(max(1, -(-rows.count() // SHARD_ROWS)))
    scaled = lambda r: np.floor(SCALE * np.array(r.vector, np.float64))
    seeds = [(r.vec_id, scaled(r)) for r in rows.limit(SEED_ROWS).collect()]
    seed_ids, seed_rows = np.array([s[0] for s in seeds], np.int64), [s[1] for s in seeds]
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id")
    asked, found = queries.toLocalIterator(), []
    while block := list(islice(asked, QUERY_BLOCK)):
        ids, own = np.array([r.vec_id for r in block], np.int64), [scaled(r) for r in block]
        kths = _first_kths(ids, own, seed_ids, seed_rows, k)
        found.append(shards.mapInArrow(_searcher(ids, own, kths, k), FOUND))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
