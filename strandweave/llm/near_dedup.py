"""Near-duplicate grouping: SuperMinHash signatures, banding, verification on full shingle sets, union-find.

SuperMinHash (Ertl, 2017): every shingle walks a permutation of the registers of its own; its j-th register is offered
j + r with r uniform in [0, 1), so early registers of the walk win. A document stops walking once no register can get
a smaller value, after about one step where it has many more shingles than registers. The walks of all shingles of a
batch are made together in numpy.

Documents with equal shingle sets are one class (found by a 128-bit key of the set), and only one document of a class
goes on. Two classes whose signatures agree in all registers of a band are candidates. Within a bucket candidates are
paired with a hub first; links are verified on full sets and united, and only buckets that still hold several
components are taken up again: once with another hub, then all rows of different components are compared by sketches (8
bits of each register) in blocks of bounded size, and what a sketch can't rule out is verified. So a group of linked
copies costs a pair per document, rows of a large bucket are never paired in a table, and no candidate that could join
two components is left out.

Bands follow from the threshold: at 0.80 and 0.85 they are 20 of 4 registers, and a pair there shares none with probability
3e-5 (0.85: 4e-7); lower thresholds take more or shorter ones, and one that no bands serve is an error. Sketches rule out
what agrees in fewer registers than 4.5 standard deviations below the threshold (3e-6).

Edge cases: null or blank text: no shingles, linked with nothing. Very long texts: a set of all shingles is held in one
worker (8 bytes each), a text's walk at a time. Fewer words than a shingle: the whole sequence is
one shingle. Rows with a null id form no links and are kept. Rows that repeat an id are one node. Empty table: no
rows. Extra columns are ignored by `near_duplicates`, and kept by `drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX_A, by_ids, materialize, scramble, shingle_hashes, word_hashes, words_of
from .components import connected_components

#: All registers make the sketch, the first of them the bands. MISS: the chance that a pair at the threshold shares no band.
REGISTERS, MISS = 256, 3e-5
#: Shingles walked together, and rows compared together; they bound a worker's memory.
WALK, BLOCK = 80_000, 1024


def super_minhash(elements: np.ndarray, owner: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Signatures (docs x registers, values j * 2^32 + r) of sets given as distinct elements with their owners."""
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    out = np.full(docs * registers, np.uint64(registers) << half, dtype=np.uint64)
    el, own, step = elements, owner, 0
    chosen: list[np.ndarray] = []
    perm = None
    while len(el) and step < registers:
        with np.errstate(over="ignore"):
            z = scramble(el + np.uint64(step + 1) * MIX_A)
        k = step + (((z & low) * np.uint64(registers - step)) >> half).astype(np.int64)
        if step == 0:
            reg = k
        elif step == 1:
            reg = np.where(k == chosen[0], 0, k)
        else:
            at = np.arange(len(el))
            if perm is None:
                perm = np.tile(np.arange(registers, dtype=np.uint8), (len(el), 1))
                for s, c in enumerate(chosen):
                    held = perm[at, c].copy()
                    perm[at, c] = perm[at, s]
                    perm[at, s] = held
            reg = perm[at, k].astype(np.int64)
            perm[at, k] = perm[at, step]
            perm[at, step] = reg
        np.minimum.at(out, own * registers + reg, (np.uint64(step) << half) | (z >> half))
        chosen.append(k)
        step += 1
        live = out.reshape(docs, registers).max(axis=1) >= (np.uint64(step) << half)
        go = live[own]
        el, own, chosen = el[go], own[go], [c[go] for c in chosen]
        if perm is not None:
            perm = perm[go]
    return out.reshape(docs, registers)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(words_of(text)), width))


def _signatures(width: int, bands: int, rows: int):
    names = ["doc_id", "n_shingles", "key1", "key2", "bands", "sketch"]

    def flush(ids, sets) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        el = np.concatenate(sets)
        sig = super_minhash(el, np.repeat(np.arange(len(sets)), sizes), len(sets), REGISTERS)
        key = np.zeros((len(sets), bands), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for b in range(bands):
                h = np.full(len(sets), np.uint64(b + 1), dtype=np.uint64)
                for r in range(rows):
                    h = scramble((h + sig[:, b * rows + r]) * MIX_A)
                key[:, b] = h
            starts = np.minimum(np.cumsum(sizes) - sizes, max(0, len(el) - 1))
            one = np.add.reduceat(scramble(el), starts) if len(el) else np.zeros(len(sets), np.uint64)
            two = np.bitwise_xor.reduceat(scramble(el ^ MIX_A), starts) if len(el) else np.zeros(len(sets), np.uint64)
            short = (scramble(sig) >> np.uint64(56)).astype(np.uint8)
        values = [[int(x) for x in row] if n else [] for row, n in zip(key.view(np.int64).tolist(), sizes)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.array(np.where(sizes, one.view(np.int64), 0)), pa.array(np.where(sizes, two.view(np.int64), 0)), pa.array(values, pa.list_(pa.int64())), pa.array([x.tobytes() for x in short], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py(), width)
                ids.append(doc_id)
                sets.append(s)
                held += len(s)
                if held >= WALK:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield flush(ids, sets)

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t.as_py(), width).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return run


def _cut(threshold_pct: int) -> int:
    """Equal registers that a pair at the threshold reaches but with probability 3e-6."""
    t = threshold_pct / 100
    return int(REGISTERS * t - 4.5 * (REGISTERS * t * (1 - t)) ** 0.5)


def _likely(threshold_pct: int):
    """Keeps the pairs (a, b, sketch of a, sketch of b) that sketches can't rule out."""
    cut = _cut(threshold_pct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (2, 3))
            keep = (x == y).sum(axis=1) >= cut
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table.column(c).to_numpy() for c in ("key", "i", "j", "block", "rep", "n", "component")}
    out["sketch"] = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    out["bands"] = np.array(table.column("bands").to_pylist(), dtype=np.int64)
    return out


def _suspicious(x: dict[str, np.ndarray], threshold_pct: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of different components in one bucket that sketches can't rule out, some at a time.

    A pair is compared in the first bucket that both rows are in, so it is met once, not in each bucket they share.
    """
    cut, (key, block, rep, n, comp, i, j, bands, sketch) = _cut(threshold_pct), (x[c] for c in ("key", "block", "rep", "n", "component", "i", "j", "bands", "sketch"))
    order = np.lexsort((rep, key))
    ends = np.flatnonzero(np.diff(key[order], append=key[order][-1:] + 1)) + 1
    start = 0
    for end in ends:
        own = order[start:end]
        start = end
        left, right = own[block[own] == i[own]], own[block[own] == j[own]]
        for at in range(0, len(left), 32):
            a = left[at : at + 32]
            ok = (comp[a][:, None] != comp[right][None, :]) & (np.minimum(n[a][:, None], n[right][None, :]) * 100 >= np.maximum(n[a][:, None], n[right][None, :]) * threshold_pct)
            p, q = np.nonzero(ok)
            for s in range(0, len(p), 50_000):
                u, v = a[p[s : s + 50_000]], right[q[s : s + 50_000]]
                same = bands[u] == bands[v]
                here = bands[u, same.argmax(axis=1)] == key[u]
                u, v = u[here], v[here]
                hit = (sketch[u] == sketch[v]).sum(axis=1) >= cut
                yield u[hit], v[hit]


_UNIT = ("bin", "key", "i", "j", "rep")


def _suspects(threshold_pct: int):
    """Rows of one group (`bin, key, i, j, block, rep, n, component, bands, sketch`) to those that are in a suspicious pair there."""

    def run(table: pa.Table) -> pa.Table:
        x = _columns(table)
        marked = np.zeros(table.num_rows, dtype=bool)
        for u, v in _suspicious(x, threshold_pct):
            marked[u] = marked[v] = True
        return table.select(list(_UNIT)).filter(pa.array(marked))

    return run


def _joined(threshold_pct: int):
    """The suspicious pairs of one group, which has the rows' `shingles` too, compared in full: the links that join two components.

    Pairs whose components other links of the group have joined by then are left, so there are fewer links than rows,
    and no pair leaves the task that isn't one.
    """

    def run(table: pa.Table) -> pa.Table:
        x = _columns(table)
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("shingles")]
        _, part = np.unique(x["component"], return_inverse=True)
        root = list(range(int(part.max(initial=-1)) + 1))

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        links = []
        for us, vs in _suspicious(x, threshold_pct):
            for u, v in zip(us.tolist(), vs.tolist()):
                p, q = top(part[u]), top(part[v])
                if p != q and _alike(sets[u], sets[v], threshold_pct, 100):
                    root[max(p, q)] = min(p, q)
                    links.append((int(x["rep"][u]), int(x["rep"][v])))
        return pa.table({"a": pa.array([min(k) for k in links], pa.int64()), "b": pa.array([max(k) for k in links], pa.int64())})

    return run


def _alike(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |A & B| >= num * |A | B| of sorted sets."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a)) if len(b) else 0
    return den * both >= num * (len(a) + len(b) - both)


def _verify(num: int, den: int):
    """Keeps the pairs with den * |A & B| >= num * |A | B|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_alike(*(np.frombuffer(x.as_buffer(), np.uint64) for x in pair), num, den) for pair in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def bands_for(threshold_pct: int, miss: float = MISS) -> tuple[int, int]:
    """(bands, registers in each): the longest bands of up to four registers, 20 at least, that keep to the chance of a miss."""
    for rows in (4, 3, 2, 1):
        alike = (threshold_pct / 100) ** rows
        bands = max(20, ceil(log(miss) / log(1 - alike))) if alike < 1 else 20
        if bands * rows <= REGISTERS:
            return bands, rows
    raise ValueError(f"no bands of {REGISTERS} registers find pairs at {threshold_pct} %")


def near_duplicates(
    docs: DataFrame, *, threshold_pct: int = 85, width: int = 5, bands: int | None = None, rows: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row: component_id is the smallest id linked with it."""
    if bands is None or rows is None:
        bands, rows = bands_for(threshold_pct)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(texts.mapInArrow(_signatures(width, bands, rows), "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>, sketch binary"))
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "key1", "key2").agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch"))
    classes = materialize(classes)
    sketches = classes.groupBy("rep").agg(F.min(F.struct("bands", "sketch")).alias("s")).select("rep", "s.*")
    keys = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    several = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    keys = materialize(keys.join(several, "key"))  # only buckets with candidates

    near = F.least("n", "hn") * 100 >= F.greatest("n", "hn") * threshold_pct

    def sets_of(ids: DataFrame) -> DataFrame:
        return materialize(by_ids(texts, ids, "doc_id", "left_semi").mapInArrow(_sets(width), "doc_id long, shingles binary"))

    def linked(pairs: DataFrame) -> DataFrame:
        sets = sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))))
        left = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        full = left.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")
        return full.mapInArrow(_verify(threshold_pct, 100), "a long, b long")

    def likely(pairs: DataFrame) -> DataFrame:
        own = sketches.select("rep", "sketch")
        both = pairs.join(own.toDF("b", "kb"), "b").join(own.toDF("a", "ka"), "a").select("a", "b", "ka", "kb")
        return materialize(both.mapInArrow(_likely(threshold_pct), "a long, b long"))

    # a hub for each bucket: the smallest id
    hubs = keys.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("hub"))
    with_hub = keys.join(hubs.select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hn")), "key")
    pairs = materialize(with_hub.where(F.col("rep") != F.col("hub")).where(near).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    links = materialize(linked(likely(pairs)))
    tried = pairs
    labels = materialize(connected_components(links))
    for last in (False, True):
        at = keys.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        open_keys = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        at = materialize(at.join(open_keys, "key"))
        if last:
            count = at.groupBy("key").agg(F.count("*").alias("c"))
            groups = at.count() // (4 * BLOCK) + 1
            blocks = F.ceil(F.col("c") / BLOCK).cast("int")
            rows_ = at.join(count, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            rows_ = rows_.join(sketches, "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            rows_ = rows_.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            rows_ = rows_.withColumn("bin", F.when(F.col("blocks") == 1, F.pmod("key", F.lit(groups))).otherwise(F.col("key")))
            rows_ = rows_.select("bin", "key", "i", "j", "block", "rep", "n", "component", "bands", "sketch")
            suspects = materialize(rows_.groupBy("bin", "i", "j").applyInArrow(_suspects(threshold_pct), "bin long, key long, i int, j int, rep long"))
            sets = sets_of(suspects.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
            found = rows_.join(suspects, list(_UNIT), "left_semi").join(sets, "rep").groupBy("bin", "i", "j").applyInArrow(_joined(threshold_pct), "a long, b long")
            links = materialize(links.unionByName(found))
            labels = materialize(connected_components(links))
        else:
            hubs = at.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "rep").alias("o"), "rep", "n", "component")).alias("hub"))
            with_hub = at.join(hubs.select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hn"), F.col("hub.component").alias("hc")), "key")
            pairs = with_hub.where(F.col("component") != F.col("hc")).where(near).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
            pairs = materialize(pairs.distinct().join(tried, ["a", "b"], "left_anti"))
            if not pairs.isEmpty():
                links = materialize(links.unionByName(linked(likely(pairs))))
                labels = materialize(connected_components(links))

    member = classes.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").select("n_shingles", "key1", "key2", F.coalesce("component", "rep").alias("component"))
    out = signed.join(member, ["n_shingles", "key1", "key2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **params) -> DataFrame:
    """docs without those that are not the smallest id of their group."""
    gone = near_duplicates(docs, id_col=id_col, **params).where("not kept").select(F.col("doc_id").alias(id_col))
    return by_ids(docs, materialize(gone), id_col, "left_anti").select(*docs.columns)


# ---------------------------------------------------------------- query


def op8_super_minhash(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def near_dedup_stage(spark, docs, sf_dir):
    return drop_near_duplicates(docs, threshold_pct=80)


QUERIES = {"op8_super_minhash": op8_super_minhash}

#: Exact: links by counts of shared shingles over all pairs that share any, and the smallest id reachable.
ORACLE = {
    "op8_super_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
n AS (SELECT doc_id, ws, least(5, len(ws)) AS k, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + k - 1], ' ') AS s FROM n),
sz AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM shared JOIN sz p ON x = p.doc_id JOIN sz q ON y = q.doc_id WHERE 100 * k >= 85 * (p.c + q.c - k)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM sz UNION SELECT e.b, r.c FROM r JOIN e ON r.id = e.a WHERE r.c < e.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, coalesce(sz.c, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sz ON d.doc_id = sz.doc_id LEFT JOIN m ON d.doc_id = m.id
"""
}
