"""Benchmark decontamination by greedy string tiling (running Karp-Rabin).

Documents and benchmark items are words: ASCII-lower-cased, punctuation stripped at the ends, hashed. Seeds are hashes
of `seed` (5) words; a document joins an item on shared seeds. An item's words under shared seeds bound what tiles can
cover, so items below the threshold are dropped there, exactly. For the rest, maximal common runs are found from the
places where the words beside a shared seed differ, and the longest run is marked as a tile, again and again; what a tile covers is lost to other runs, which are cut
to what is left, until no run of `seed` words remains. The covered share of the item's words is compared with the
threshold, so passages in another order are caught as well as whole ones. Items with fewer words than a seed match as a whole.

The benchmark is cut to blocks of about `BLOCK_WORDS` words, and a block is broadcast (32 bytes a word). A larger
benchmark takes a pass over the documents for every block, one after the other; documents are never gathered.

Edge cases: null or blank text, on either side: no match. Repeated items or documents: a row for each pair. Ties among
runs: first in the item, then in the document. Empty tables: no rows. Ids keep their type, null ids stay null. Very long
and very repetitive texts: a repeated word or phrase costs one run for each occurrence. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_ids, materialize, shingle_hashes, text_words, word_hashes

SEED, THRESHOLD = 5, 0.5
BLOCK_WORDS = 1_000_000
_ENDS = b".,;:!?\"'()[]{}<>*"


def tokens(text: str | None) -> np.ndarray:
    if not text:
        return np.zeros(0, np.uint64)
    words = [w for w in (x.strip(_ENDS) for x in text.encode("utf-8", "surrogatepass").lower().split()) if w]
    return word_hashes(words)


def _differing(item: np.ndarray, doc: np.ndarray, beside_item: np.ndarray, beside_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with equal seeds whose neighbours differ.

    Pairs with equal neighbours are never listed, so repetitions cost a pair for each occurrence, not for each two.
    """
    seeds, at = np.unique(np.concatenate([item, doc]), return_inverse=True)
    beside, near = np.unique(np.concatenate([beside_item, beside_doc]), return_inverse=True)
    both = at * len(beside) + near
    order = np.argsort(both[: len(item)], kind="stable")
    seed_of, both_of = at[: len(item)][order], both[: len(item)][order]
    wanted, alike = at[len(item) :], both[len(item) :]
    lo, hi = np.searchsorted(seed_of, wanted, "left"), np.searchsorted(seed_of, wanted, "right")
    a, b = np.searchsorted(both_of, alike, "left"), np.searchsorted(both_of, alike, "right")
    a, b = np.clip(a, lo, hi), np.clip(b, lo, hi)
    starts, counts = np.concatenate([lo, b]), np.concatenate([a - lo, hi - b])
    rows = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return order[rows], np.repeat(np.tile(np.arange(len(doc)), 2), counts)


def maximal_runs(item: np.ndarray, doc: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """(item start, document start, words) of all common runs of `seed` words or more that can't be made longer.

    A run starts where the words before differ and ends where those after do. On a diagonal, starts and ends alternate.
    """
    if min(len(item), len(doc)) < seed:
        return []
    grams = [shingle_hashes(w, seed) for w in (item, doc)]
    limits = np.array([1, 2], dtype=np.uint64)  # a text's edge differs from any word and from the other's edge
    p, q = _differing(*grams, *(np.r_[limits[k : k + 1], w[: len(g) - 1]] for k, (w, g) in enumerate(zip((item, doc), grams))))
    x, y = _differing(*grams, *(np.r_[w[seed:], limits[k : k + 1]] for k, w in enumerate((item, doc))))
    start, end = np.lexsort((p, q - p)), np.lexsort((x, y - x))
    return list(zip(p[start].tolist(), q[start].tolist(), (x[end] - p[start] + seed).tolist()))


def greedy_tiles(runs: list[tuple[int, int, int]], item_words: int, doc_words: int, seed: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, words) of maximal runs, longest first."""
    heap = [(-n, p, q) for p, q, n in runs]
    heapq.heapify(heap)
    in_item, in_doc, tiles = np.zeros(item_words, dtype=bool), np.zeros(doc_words, dtype=bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        lost = in_item[a : a - n] | in_doc[b : b - n]
        if not lost.any():
            tiles.append((a, b, -n))
            in_item[a : a - n] = in_doc[b : b - n] = True
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, lost, True]))  # partly covered: its free parts compete again
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= seed:
                heapq.heappush(heap, (lo - hi, a + lo, b + lo))
    return tiles


class Block:
    """The words of some items, and their seeds sorted by hash with item and position."""

    def __init__(self, ids: list, texts: list[str | None], seed: int):
        self.words = [tokens(t) for t in texts]
        self.ids, self.sizes, self.seed = ids, np.array([len(w) for w in self.words], dtype=np.int64), seed
        grams = [shingle_hashes(w, seed) for w in self.words]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        pos = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.lexsort((pos, item, h))
        self.hash, self.item, self.pos = h[order], item[order], pos[order]
        self.known, self.short = np.unique(self.hash), sorted({int(n) for n in self.sizes if 0 < n < seed})

    def matches(self, words: np.ndarray, threshold: float) -> Iterator[tuple[int, list[tuple[int, int, int]], float]]:
        """(item, tiles, coverage) of the items that words covers to the threshold."""
        for width in [self.seed, *self.short]:
            grams = np.unique(shingle_hashes(words, width)) if len(words) >= width else np.zeros(0, np.uint64)
            if not len(grams) or not len(self.known):
                continue
            at = np.searchsorted(self.known, grams)
            at[at == len(self.known)] = 0
            grams = grams[self.known[at] == grams]
            if not len(grams):
                continue
            lo, hi = np.searchsorted(self.hash, grams, "left"), np.searchsorted(self.hash, grams, "right")
            reps = hi - lo
            rows = np.repeat(lo - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
            item, pos = self.item[rows], self.pos[rows]
            order = np.argsort(item, kind="stable")
            item, pos = item[order], pos[order]
            starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
            for s, e in zip(starts, np.r_[starts[1:], len(item)]):
                k = int(item[s])
                n = int(self.sizes[k])
                if (width == self.seed) != (n >= self.seed) or (width != self.seed and n != width):
                    continue
                if len(np.unique(pos[s:e][:, None] + np.arange(width))) < threshold * n:
                    continue
                tiles = greedy_tiles(maximal_runs(self.words[k], words, width), n, len(words), width)
                share = sum(t[2] for t in tiles) / n
                if share >= threshold:
                    yield k, tiles, share


def _search(block, threshold: float):
    kind = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, item_kind = block.value
        for batch in batches:
            rows, items, shares, tiles = [], [], [], []
            for r, text in enumerate(batch.column(1)):
                for k, found, share in b.matches(tokens(text.as_py()), threshold):
                    rows.append(r)
                    items.append(b.ids[k])
                    shares.append(share)
                    tiles.append([{"item_start": x, "doc_start": y, "words": n} for x, y, n in sorted(found)])
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, item_kind), pa.array(shares, pa.float64()), pa.array(tiles, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "coverage", "tiles"])

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, seed: int = SEED, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, item_id, coverage, tiles` for every document and item whose words it covers to the threshold."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    sized = items.withColumn("w", text_words(F.col("text")))
    total = sized.agg(F.sum("w")).first()[0] or 0
    blocks = total // block_words + 1
    sized = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        sized = materialize(sized)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, coverage double, tiles array<struct<item_start:int,doc_start:int,words:int>>"
    out = []
    for k in range(blocks):
        rows = sized.where(F.col("block") == k).orderBy("item_id", "text").select("item_id", "text").toArrow()
        shared = spark.sparkContext.broadcast((Block(rows.column(0).to_pylist(), rows.column(1).to_pylist(), seed), rows.schema.field(0).type))
        found = own.mapInArrow(_search(shared, threshold), schema)
        if blocks > 1:  # one block at a time is held and searched
            found = materialize(found)
            shared.destroy()
        out.append(found)
    return reduce(DataFrame.unionByName, out)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """docs without those that cover an item to the threshold. Rows of one id go together, and so do rows without an id."""
    gone = materialize(contaminated(docs, benchmark, **params).select("doc_id"))
    return by_ids(docs, gone, "doc_id", "left_anti").select(*docs.columns)


# ---------------------------------------------------------------- query


def op1_string_tiling_decontamination(spark, sf_dir):
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs.select("doc_id", "text"), bench)
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").cast("long").alias("n_tiles"), F.aggregate("tiles", F.lit(0).cast("long"), lambda a, t: a + t["words"]).alias("words"))


def decontamination_stage(spark, docs, sf_dir):
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op1_string_tiling_decontamination": op1_string_tiling_decontamination}
ORACLE = {}
