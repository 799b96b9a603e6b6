"""Embedding near-dedup: randomly rotated binary codes with correction factors, estimates with bounds, exact verification.

A unit vector x is rotated at random; its code keeps the signs, i.e. the nearest of the vectors (+-1, ..., +-1) / sqrt(d), and
its correction factor f is the inner product of the two. For any unit vector y, <code, y> / f estimates <x, y> without
bias; the error's standard deviation is sqrt((1 - <x, y>^2) (1 - f^2) / (d - 1)) / f. A pair whose estimate lies more than
`BOUND` deviations (4.5: a chance of 3e-6) below what the threshold would give is dropped; only the rest is computed
exactly, in double precision, so no link is below the threshold.

Pairs are compared only in buckets: rows of one label whose codes agree in `bits` places of one of several tables; bits
come from further rotations. Two unit vectors at the threshold angle agree in one place with probability 1 - angle / pi
(0.88 at 0.93), so the number of tables follows from the bits and the chance `MISS` of no shared bucket. Bits grow with
the logarithm of a label's rows, so buckets of unlike vectors keep their size and the work grows as n^1.2. Labels of up to
`BLOCK` distinct vectors are one bucket.

Equal vectors of a label are one class, which goes on with its number of copies, so copies make no pairs. A bucket larger
than `BLOCK` is cut into blocks by hash, and each pair of blocks is one unit of work, in whatever task. Units put out no
pairs but, for each row, how many vectors it links with there, and a spanning forest of the links. A pair that shares several
buckets counts in the first of them only. Components come from the forests.

Limits: a group of n distinct near copies has n^2 / 2 links, each of which is verified, and its rows are sent to n / BLOCK
units. Recall is a matter of chance, 1 - MISS at the threshold, more above it.

Edge cases: null labels, null vectors, zero vectors, vectors without components or with null or non-finite ones, and null
ids link with nothing: 0 links, a component of their own (null for a null id), kept. Vectors of different lengths don't
link. Rows that repeat an id are vectors of their own in n_links, and one node in components if they are equal. Very large
or small components are scaled by a power of two first. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_copies, materialize, scramble, unused
from .components import connected_components

BLOCK, BOUND, MISS = 1024, 4.5, 1e-4
#: Numbers rotated at a time; they bound a worker's memory.
CELLS = 1 << 22


def bits_and_tables(rows: int, threshold: float, block: int = BLOCK, miss: float = MISS) -> tuple[int, int]:
    """Bits of a key and number of keys for a label of so many distinct vectors."""
    bits = max(0, ceil(log2(max(1, rows) / block)))
    same = (1 - acos(threshold) / pi) ** bits
    return bits, 1 if bits == 0 else ceil(log(miss) / log(1 - same))


class Rotations:
    """Random rotations of one dimension, made from a seed as they are needed, so that all tasks have the same."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed, self.made = dim, seed, []

    def __getitem__(self, k: int) -> np.ndarray:
        while len(self.made) <= k:
            rng = np.random.default_rng([self.seed, self.dim, len(self.made)])
            q, r = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))
            self.made.append(q * np.sign(np.diag(r)))  # uniform among rotations
        return self.made[k]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1."""
    _, power = np.frexp(np.abs(x).max(axis=1))
    x = np.ldexp(x, -power[:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def code(u: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs (bool) of the rotated rows and the correction factors."""
    turned = u @ rotation
    return turned >= 0, np.abs(turned).sum(axis=1) / u.shape[1] ** 0.5


def bucket_keys(u: np.ndarray, rotations: Rotations, bits: int, tables: int) -> np.ndarray:
    """A 64-bit key for each row and table, from the signs under the rotations after the first."""
    out = np.zeros((len(u), tables), dtype=np.uint64)
    dim, at, signs = u.shape[1], 0, None
    for t in range(tables):
        key = np.full(len(u), np.uint64(t + 1), dtype=np.uint64)
        for _ in range(bits):
            if at % dim == 0:
                signs = u @ rotations[1 + at // dim] >= 0
            key = (key << np.uint64(1)) | signs[:, at % dim].astype(np.uint64)
            at += 1
        out[:, t] = scramble(key)
    return out


def _encode(threshold: float, seed: int, block: int):
    """(node, salt, n, v) to (node, salt, keys): a row's buckets in the tables its label's size calls for."""
    known: dict[int, Rotations] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy(zero_copy_only=False)
            size = np.array([len(v) for v in batch.column(3)])
            keys = [None] * batch.num_rows
            for dim, rows in {(d, c) for d, c in zip(size.tolist(), n.tolist())}:
                bits, tables = bits_and_tables(rows, threshold, block)
                rotations = known.setdefault(dim, Rotations(dim, seed))
                all_ = np.flatnonzero((size == dim) & (n == rows))
                step = max(1, CELLS // dim)
                for at in range(0, len(all_), step):
                    own = all_[at : at + step]
                    x = batch.column(3).take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim)
                    for i, row in zip(own.tolist(), bucket_keys(unit(x), rotations, bits, tables).view(np.int64)):
                        keys[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], ["node", "salt", "keys"])

    return run


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, rotation: np.ndarray, bound: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of unit vectors with cosine >= threshold: codes of x decide which are computed exactly."""
    dim = x.shape[1]
    signs, factor = code(x, rotation)
    estimate = (np.where(signs, 1.0, -1.0).astype(np.float32) @ (y @ rotation).astype(np.float32).T) / (factor * dim**0.5).astype(np.float32)[:, None]
    spread = np.sqrt((1 - threshold**2) * np.maximum(0.0, 1 - factor**2) / max(1, dim - 1)) / factor
    p, q = np.nonzero(estimate >= (threshold - bound * spread - 1e-5).astype(np.float32)[:, None])
    keep = []
    for at in range(0, len(p), 1 << 16):
        part = slice(at, at + (1 << 16))
        keep.append(np.einsum("ij,ij->i", x[p[part]], y[q[part]]) >= threshold)
    ok = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
    return p[ok], q[ok]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the links (a, b) between n rows make a spanning forest."""
    root = list(range(n))
    keep = np.zeros(len(a), dtype=bool)
    left = n - 1
    for i, (u, v) in enumerate(zip(a.tolist(), b.tolist())):
        while root[u] != u:
            root[u] = u = root[root[u]]
        while root[v] != v:
            root[v] = v = root[root[v]]
        if u != v:
            root[max(u, v)] = min(u, v)
            keep[i] = True
            left -= 1
            if not left:
                break
    return keep


def _compare(threshold: float, seed: int):
    """Rows `salt, key, i, j, block, node, keys, copies, v`, sorted by unit of work (salt, key, i, j), to (node, n, other): n more links of a
    node, or a link with another node."""
    known: dict[int, Rotations] = {}

    def unit_of_work(t: pa.Table) -> pa.RecordBatch:
        key, i, j, block, copies = (t.column(c).to_numpy() for c in ("key", "i", "j", "block", "copies"))
        node, dim = t.column("node"), len(t.column("v")[0])
        u = unit(t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))
        keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = linked_pairs(u[left], u[right], threshold, known.setdefault(dim, Rotations(dim, seed))[0])
        a, b = left[a], right[b]
        if i[0] == j[0]:
            a, b = a[a < b], b[a < b]
        same = keys[a] == keys[b]
        first = keys[a, same.argmax(axis=1)] == key[a]
        a, b = a[first], b[first]
        n = np.bincount(a, weights=copies[b], minlength=len(key)) + np.bincount(b, weights=copies[a], minlength=len(key))
        tree = _forest(a, b, len(key))
        some = np.flatnonzero(n)
        ends = pa.concat_arrays([node.combine_chunks().take(pa.array(x)) for x in (some, a[tree])])
        others = pa.concat_arrays([pa.nulls(len(some), node.type), node.combine_chunks().take(pa.array(b[tree]))])
        counts = pa.array(np.concatenate([n[some], np.zeros(int(tree.sum()))]).astype(np.int64))
        return pa.RecordBatch.from_arrays([ends, counts, others], ["node", "n", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            unit_key = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = np.flatnonzero((np.diff(unit_key, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if b == a:
                    continue
                now = tuple(unit_key[a])
                if now != last and held:
                    yield unit_of_work(pa.Table.from_batches(held))
                    held = []
                last = now
                held.append(batch.slice(a, b - a))
        if held:
            yield unit_of_work(pa.Table.from_batches(held))

    return run


def near_vectors(rows: DataFrame, *, threshold: float = 0.93, seed: int = 13, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    takes_part = F.coalesce(sound & F.col(label_col).isNotNull() & F.col(id_col).isNotNull(), F.lit(False))
    own = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"), takes_part.alias("sound"))
    members = own.where("sound").select("vec_id", "label", "v")
    kind = members.schema["vec_id"].dataType.simpleString()

    classes = members.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    node = F.struct(F.col("rep").alias("id"), F.xxhash64("label", "v").alias("tag")).alias("node")
    classes = materialize(classes.select(node, "label", F.size("v").alias("dim"), "v", "copies"))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sized = join_copies(classes, sizes, ["label", "dim"], "n").select("node", F.xxhash64("label", "dim").alias("salt"), "n", "v")
    keyed = materialize(sized.mapInArrow(_encode(threshold, seed, block), f"node struct<id: {kind}, tag: bigint>, salt bigint, keys array<bigint>"))

    # buckets of several classes, cut into blocks; their rows get the blocks they are compared with
    met = keyed.select("node", "salt", F.explode("keys").alias("key"))
    buckets = materialize(met.groupBy("salt", "key").agg(F.count("*").alias("c")).where("c > 1"))
    dealt = join_copies(met, buckets, ["salt", "key"], "c")
    blocks = F.ceil(F.col("c") / block).cast("int")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("salt", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")
    whole = dealt.join(keyed.drop("salt"), "node").join(classes.select("node", "copies", "v"), "node").select("salt", "key", "i", "j", "block", "node", "keys", "copies", "v")
    units = whole.repartition("salt", "key", "i", "j").sortWithinPartitions("salt", "key", "i", "j")
    found = materialize(units.mapInArrow(_compare(threshold, seed), f"node struct<id: {kind}, tag: bigint>, n bigint, other struct<id: {kind}, tag: bigint>"))

    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))).select(F.col("id").alias("node"), F.col("component.id").alias("component_id"))
    known = classes.join(counts, "node", "left").join(parts, "node", "left")
    known = known.select("label", "v", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "node.id").alias("component_id"))
    linked = join_copies(members, materialize(known), ["label", "v"], "copies").select("vec_id", "n_links", "component_id")
    alone = own.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def drop_near_vectors(rows: DataFrame, *, id_col: str = "vec_id", **params) -> DataFrame:
    """rows without those that are not the smallest id of their component."""
    own = unused("dropped_id", rows)
    gone = near_vectors(rows, id_col=id_col, **params).where("not kept").select(F.col("vec_id").alias(own)).distinct()
    return rows.join(materialize(gone), rows[id_col] == F.col(own), "left_anti")


# ---------------------------------------------------------------- query


def op13_rotated_codes(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op13_rotated_codes": op13_rotated_codes}

#: Exact: all pairs of a label, and the smallest id reachable.
ORACLE = {
    "op13_rotated_codes": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x),
r AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.y, r.c FROM r JOIN l ON r.id = l.x WHERE r.c < l.y),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(m.c, e.vec_id) AS component_id, coalesce(m.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.x LEFT JOIN m ON e.vec_id = m.id
"""
}
