"""Exact top-k by inner product with M-trees and best-first search.

Vectors are quantized to integers, floor(64 x). Inner products become distances by one more coordinate: rows get
sqrt(M^2 - |x|^2), queries 0, so d^2 = |q|^2 + M^2 - 2 <q, x>, and the best are the nearest. Rows are dealt by hash into
pages of bounded size; each page becomes an M-tree: routing objects chosen farthest-first, each with a covering radius
and its distance to the routing object above, and leaves whose objects keep their distance to the leaf's. A batch of
queries goes through a tree best first: the node with the smallest lower bound of any query comes next. Stored
distances avoid computations: |d(q, parent) - d(o, parent)| bounds d(q, o) from below, so nodes and objects that no
query of the batch needs are never compared. All bounds keep ties, scores are exact integers.

Queries are broadcast in blocks of at most `QUERY_BLOCK` (64 dimensions: 26 MB as float64). A larger query set takes a
pass over the rows for every block, one after the other, each written before the next. There are as many tasks as shuffle
partitions at most, however many pages; a task keeps the best k of each query of the block over all its pages, so what is
shuffled is tasks x queries x k rows.

Edge cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids; vectors without
components are alike (score 0). Fewer than k candidates: all. Ties: smaller vec_id. Rows of a query's own id are no
candidates for it; other repeated rows are candidates each. Rows of one id and vector are one query, rows of one id and
different vectors are queries of their own, so that the id has several lists of ranks. Vectors of other lengths than the
query's are no candidates. Scores are exact below 2^53. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions_for

PAGE, LEAF, BATCH = 8192, 96, 256
QUERY_BLOCK = 50_000
#: Rounding of distances, as a share of the largest norm: squares are exact, mixed products are within a few units in the last place.
_SLACK = 1e-7


class Node:
    """A leaf (rows) or an inner node (children), with a routing object and a covering radius."""

    __slots__ = ("center", "radius", "to_parent", "children", "rows", "to_center")

    def __init__(self, center, radius, children=None, rows=None, to_center=None):
        self.center, self.radius, self.children, self.rows, self.to_center = center, radius, children, rows, to_center
        self.to_parent = 0.0


class MTree:
    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.vectors = vectors
        square = (vectors * vectors).sum(axis=1)
        self.top = float(square.max())
        self.more = np.sqrt(self.top - square)
        self.leaf = leaf
        self.root = self._grow(np.arange(len(vectors)))

    def _between(self, rows: np.ndarray, center: int) -> np.ndarray:
        dot = self.vectors[rows] @ self.vectors[center] + self.more[rows] * self.more[center]
        return np.sqrt(np.maximum(0.0, 2 * self.top - 2 * dot))

    def _grow(self, rows: np.ndarray, center: int | None = None) -> Node:
        center = int(rows[0]) if center is None else center
        away = self._between(rows, center)
        if len(rows) <= self.leaf:
            return Node(center, float(away.max()), rows=rows, to_center=away)
        fan = min(12, -(-len(rows) // self.leaf))
        picked, near, owner = [], np.full(len(rows), np.inf), np.zeros(len(rows), dtype=np.int64)
        at = int(away.argmax())
        for k in range(fan):
            picked.append(int(rows[at]))
            d = self._between(rows, picked[-1])
            closer = d < near
            owner[closer], near[closer] = k, d[closer]
            at = int(near.argmax())
        parts = [(rows[owner == k], c) for k, c in enumerate(picked) if (owner == k).any()]
        if len(parts) == 1:  # equal vectors: any cut will do
            parts = [(p, int(p[0])) for p in np.array_split(rows, fan)]
        children = []
        for part, c in parts:
            child = self._grow(part, c)
            child.to_parent = float(self._between(np.array([c]), center)[0])
            children.append(child)
        return Node(center, float(away.max()), children=children)

    def search(self, queries: np.ndarray, visit, limit) -> None:
        """visit(rows, query numbers, scores) for what may enter a query's best; limit(): the scores to reach, by query."""
        square = (queries * queries).sum(axis=1)
        base = square + self.top
        slack = _SLACK * float(np.sqrt(base.max() + 1))

        def distance(center: int, who: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, base[who] - 2 * (queries[who] @ self.vectors[center])))

        def reach(who: np.ndarray) -> np.ndarray:
            least = limit()[who]
            return np.where(np.isfinite(least), np.sqrt(np.maximum(0.0, base[who] - 2 * least)), np.inf) + slack

        everyone = np.arange(len(queries))
        d = distance(self.root.center, everyone)
        heap, tick = [(0.0, 0, self.root, everyone, d)], 0
        while heap:
            _, _, node, who, d = heapq.heappop(heap)
            r = reach(who)
            go = d - node.radius <= r
            who, d, r = who[go], d[go], r[go]
            if not len(who):
                continue
            if node.children is None:
                near = np.abs(d[:, None] - node.to_center[None, :]) <= r[:, None]
                rows = node.rows[near.any(axis=0)]
                if len(rows):
                    visit(rows, who, queries[who] @ self.vectors[rows].T)
                continue
            for child in node.children:
                go = np.abs(d - child.to_parent) - child.radius <= r
                if go.any():
                    own = who[go]
                    dc = distance(child.center, own)
                    bound = np.maximum(0.0, dc - child.radius)
                    go = bound <= r[go]
                    if go.any():
                        tick += 1
                        heapq.heappush(heap, (float(bound[go].min()), tick, child, own[go], dc[go]))


class Best:
    """The best k of each query so far: scores and ids, best first."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.score = np.full((len(query_ids), k), -np.inf)
        self.id = np.full((len(query_ids), k), np.iinfo(np.int64).max)

    def add(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        hit = (scores >= self.score[who, -1:]) & (ids[None, :] != self.query_ids[who][:, None])
        rows, cols = np.nonzero(hit)
        if not len(rows):
            return
        touched, at = np.unique(rows, return_inverse=True)
        width = np.bincount(at)
        new_s, new_i = np.full((len(touched), width.max()), -np.inf), np.full((len(touched), width.max()), np.iinfo(np.int64).max)
        place = np.arange(len(rows)) - (np.cumsum(width) - width)[at]
        new_s[at, place], new_i[at, place] = scores[rows, cols], ids[cols]
        q = who[touched]
        s, i = np.hstack([self.score[q], new_s]), np.hstack([self.id[q], new_i])
        order = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[q], self.id[q] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _task(block, k: int, page: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(ids, tags, vectors, Best(ids, k)) for ids, tags, vectors in block.value]

        def search(ids: np.ndarray, vectors: np.ndarray) -> None:
            for _, _, queries, best in groups:
                if queries.shape[1] == vectors.shape[1]:
                    tree = MTree(vectors)
                    for at in range(0, len(queries), BATCH):
                        part = slice(at, at + BATCH)
                        tree.search(queries[part], lambda rows, who, s, at=at: best.add(who + at, ids[rows], s), lambda p=part: best.score[p, -1])

        held: dict[int, list] = {}
        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.asarray(v.values, dtype=np.float64)
                own = held.setdefault(len(x), [])
                own.append((vec_id, x))
                if len(own) >= page:
                    search(np.array([i for i, _ in own]), np.stack([x for _, x in own]))
                    held[len(x)] = []
        for own in held.values():
            if own:
                search(np.array([i for i, _ in own]), np.stack([x for _, x in own]))
        for query_ids, tags, _, best in groups:
            ok = np.isfinite(best.score)
            who = np.repeat(np.arange(len(query_ids)), k).reshape(ok.shape)[ok]
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[who]), pa.array(tags[who]), pa.array(best.id[ok]), pa.array(best.score[ok].astype(np.int64))], ["query_id", "tag", "vec_id", "score"])

    return run


def quantized(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * 64).cast("double"))
    return rows.where(v.isNotNull() & finite & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def top_k(rows: DataFrame, queries: DataFrame, *, k: int = 20, page: int = PAGE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """`query_id, rank, vec_id, score` of `vec_id, v` tables: the k rows of the largest inner product for every query."""
    spark = rows.sparkSession
    queries = queries.select("vec_id", "v", F.xxhash64("v").alias("tag")).distinct()
    n, blocks = rows.count(), -(-queries.count() // query_block)
    dealt = rows.repartition(max(1, min(-(-n // page), partitions_for(spark))), "vec_id")
    schema, out = "query_id long, tag long, vec_id long, score long", []
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id", "tag").collect()
        block = []
        for size in sorted({len(r["v"]) for r in own}):
            alike = [r for r in own if len(r["v"]) == size]
            block.append((np.array([r["vec_id"] for r in alike]), np.array([r["tag"] for r in alike]), np.array([r["v"] for r in alike], dtype=float).reshape(len(alike), size)))
        shared = spark.sparkContext.broadcast(block)
        found = dealt.mapInArrow(_task(shared, k, page), schema)
        if blocks > 1:  # one block at a time is held and worked on
            found = materialize(found)
            shared.destroy()
        out.append(found)
    found = reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)
    first = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


# ---------------------------------------------------------------- query


def op9_mtree_search(spark, sf_dir):
    rows = quantized(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(rows, rows.where(F.col("vec_id") % 20 == 0))


QUERIES = {"op9_mtree_search": op9_mtree_search}

ORACLE = {
    "op9_mtree_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
}
