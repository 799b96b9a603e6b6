"""Audit of filters applied in any order: what each filter removes at each step of each order, counted on a lattice.

Whatever the order, a document meets the next filter f with some set S of filters already applied. What happens there
depends on (S, f) only, so all orders of five filters share 80 edges of the lattice of subsets. A document is first
reduced to the set of filters it fails (32 possible masks) and counted by part and mask; masks are joined to the edges,
counts are summed by edge, and the 600 steps of the 120 orders look their edge up. Nothing but masks is computed by document, and
the tables of masks, edges and steps are fixed in size, so they are broadcast.

A document fails the last filter if a smaller id anywhere has the same text. Texts are compared by sha-256: the smallest
id of each digest is a map-side combined minimum, and documents look for themselves among (digest, smallest id), a key
that copies don't share, so a group with a third of all rows isn't gathered.

Edge cases: null text counts as empty; empty text fails the first filter and, but for the smallest id, the last one.
Null source: part ''. Null ids come after no other and before none: they never fail the last filter, nor make others
fail it; they have no labels. Rows that repeat an id are counted each and fail the last filter together. An id with
several labels has a label if any row has it. Very long texts are worked on whole, one at a time. Empty table: no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PCT, CAPITALS_PCT = 50, 65, 5
_CAPITALS, _MARKS = bytes(range(65, 91)), b"#$%&*|"
_BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failed(text: str | None) -> int:
    """The mask of the filters A to D that a text fails."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # at ASCII white space
    out = _BIT["A"] if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < DISTINCT_PCT * len(words):
        out |= _BIT["B"]
    if 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > CAPITALS_PCT * len(text or ""):
        out |= _BIT["C"]
    if len(raw) != len(raw.translate(None, _MARKS)):
        out |= _BIT["D"]
    return out


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, digest, text) to (doc_id, part, digest, mask)."""
    for batch in batches:
        mask = pa.array([failed(t.as_py()) for t in batch.column(3)], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), mask], ["doc_id", "part", "digest", "mask"])


def edges() -> list[tuple[int, str]]:
    """(set of filters already applied, next filter): for each filter the subsets of the others."""
    return [(sum(_BIT[x] for x in s), f) for f in FILTERS for n in range(len(FILTERS)) for s in combinations(FILTERS.replace(f, ""), n)]


def edge_outcomes(spark: SparkSession) -> DataFrame:
    """What happens to a document of each mask at each edge: 32 * 80 rows."""
    rows = []
    for mask in range(1 << len(FILTERS)):
        for applied, f in edges():
            fails, gone = bool(mask & _BIT[f]), bool(mask & applied)
            rows.append((mask, applied, f, int(not gone and not fails), int(fails and not gone), int(fails and gone), int(mask == _BIT[f])))
    return spark.createDataFrame(rows, "mask int, applied int, filter string, kept int, removed int, redundant int, unique_fails int")


def steps(spark: SparkSession) -> DataFrame:
    """The edges that each order goes along: 120 * 5 rows."""
    rows = [("".join(p), k + 1, sum(_BIT[x] for x in p[:k]), p[k]) for p in permutations(FILTERS) for k in range(len(p))]
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, filter string")


def paths_over(spark: SparkSession) -> DataFrame:
    """How many orders go along each edge: 80 rows."""
    n = len(FILTERS)
    return spark.createDataFrame([(s, f, factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) for s, f in edges()], "applied int, filter string, orders long")


def failure_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """`doc_id, part, mask` of every row: bit k is set if it fails the k-th filter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    own = materialize(rows.mapInArrow(_masks, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, part string, digest binary, mask int"))
    first = own.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    known = own.where("doc_id is not null").join(first, ["digest", "doc_id"], "left")
    later = F.when(F.col("first").isNull(), F.lit(_BIT["E"])).otherwise(0)
    nameless = own.where("doc_id is null").select("doc_id", "part", "mask")
    return known.select("doc_id", "part", (F.col("mask") + later).cast("int").alias("mask")).unionByName(nameless)


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`part, mask, n, good, toxic`: at most 32 rows for a part."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counts = [F.count("*").alias("n"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("good", "toxic")]]
    return masks.join(known, "doc_id", "left").groupBy("part", "mask").agg(*counts)


def audit(counts: DataFrame) -> DataFrame:
    """`part, filter_order, step` and the measures from `part, mask, n, good, toxic`."""
    spark = counts.sparkSession
    met = counts.join(F.broadcast(edge_outcomes(spark)), "mask")
    sums = [F.sum(F.col(k) * F.col("n")).alias(k) for k in ("kept", "removed", "redundant", "unique_fails")]
    sums += [F.sum(F.col("removed") * F.col(k)).alias(f"{k}_lost") for k in ("good", "toxic")]
    by_edge = materialize(met.groupBy("part", "applied", "filter").agg(*sums))
    shapley = by_edge.join(F.broadcast(paths_over(spark)), ["applied", "filter"]).groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    out = by_edge.join(F.broadcast(steps(spark)), ["applied", "filter"]).join(shapley, ["part", "filter"])
    return out.select("part", "filter_order", "step", *MEASURES, "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """A row for each part, order of the filters and step, zeros included."""
    return audit(mask_counts(failure_masks(docs, **columns), labels))


# ---------------------------------------------------------------- query


def op11_filter_lattice(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return audit_filters(read("documents"), read("labels"))


QUERIES = {"op11_filter_lattice": op11_filter_lattice}

#: Every order walked step by step.
ORACLE = {
    "op11_filter_lattice": r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, doc_id, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b, 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM d),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails FROM m LEFT JOIN g USING (doc_id)),
n AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k] AS x, filter_order[1:k - 1] AS before FROM o, range(1, 6) r(k)),
w AS (
  SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS hit, len(list_filter(string_split(before, ''), lambda y: y <> '' AND contains(fails, y))) > 0 AS gone, fails = x AS alone FROM n, s),
t AS (
  SELECT part, filter_order, step, x, sum(n) FILTER (NOT gone AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed, sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (alone) AS unique_fails,
    sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost FROM w GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM t
"""
}
