"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order (a keyed hash of the id), then of their second copies, and so
on. A source whose target is T words is served at rate T, so what ends after `c` words of its queue has virtual finish
time c / T. All queues are put in one global order of finish times by a range partitioning; running totals over it come
from partition sums, and the order is truncated where its words reach the budget. As in packet networks a document is
queued in packets, here of at most 1 / `PACKETS` of its source's target, so that a long document in service at the end
doesn't take its source far from the target. `taken` counts the words of a document's packets before the cut.

Nothing is gathered per source: queues are prefix sums over hash slots (one small row for a source and slot), then
over the rows of one slot. A source with a third of all rows is spread over all slots. Targets are found from running
totals over the range-partitioned sources, so their number isn't bounded either.

Edge cases: null text or no words: size 0, taken 0. Null source: a source of its own, last in order. No rows or no
words: targets 0. Repeated rows are separate documents; rows of one id and size are ordered by a hash of their text, and
what is equal in that too is taken in any order, which can't be told apart. Extra columns pass through, whatever their
names; `size`, `source_size`, `target`, `taken` and `finish` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_words

#: Most sources for which the table of targets may be broadcast (a row is under 100 bytes besides its name).
BROADCAST_SOURCES = 20_000
PACKETS = 4096
_OWN = ("size", "source_size", "target", "taken", "finish")


def running_totals(rows: DataFrame, order: Sequence[str], **sums: Column) -> DataFrame:
    """rows with, for each name, the sum of its column over all rows before this one in the global order.

    The rows are range-partitioned and written; totals of whole partitions (a row each) give every partition its offset.
    """
    dealt = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for a partition
    whole = dealt.groupBy("part").agg(*[F.sum(c).alias(f"sum_{k}") for k, c in sums.items()])
    whole = whole.select("part", *[F.sum(f"sum_{k}").over(before).alias(f"base_{k}") for k in sums])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(whole), "part")
    return out.select(*rows.columns, *[(F.coalesce(f"base_{k}", F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(k) for k, c in sums.items()])


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, repeats: float) -> DataFrame:
    """`key, source_size, target` from `key, source_size`: share * all words by weight, no target above repeats * its
    source's words. Keys sort as sources do, null last.

    The excess of capped sources is reshared by weight. With sources ordered by cap / weight this has a closed form:
    the level rises until the first source that the remaining budget doesn't fill.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = running_totals(totals, ["key"], place=F.lit(1))
    t = t.select("key", "source_size", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"), (F.col("source_size") * float(repeats)).alias("cap"))
    t = materialize(running_totals(t.withColumn("ratio", F.col("cap") / F.col("weight")), ["ratio", "key"], filled=F.col("cap"), passed=F.col("weight")))
    words, weight = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = (F.lit(float(words) * share) - F.col("filled")) / (F.lit(float(weight)) - F.col("passed"))
    found = t.where(level <= F.col("ratio")).agg(F.min(F.struct("ratio", "key", level.alias("level"))).alias("s")).first()["s"]
    level = float("inf") if found is None else found["level"]
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap"), F.lit(level) * F.col("weight")))
    return t.select("key", "source_size", target.alias("target"))


def _ends(start: Column, size: Column, quantum: Column) -> Column:
    """Queue positions at which a document's packets end."""
    return F.transform(F.sequence(F.lit(1).cast("long"), F.ceil(size / quantum).cast("long")), lambda p: start + F.least(size, p * quantum))


def fair_mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    rows_per_slot: int = 1000,
    packets: int = PACKETS,
    size: Column | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """docs with size, source_size, target, taken (words taken, repeats counted) and finish (virtual time, first copy).

    size and tie: the words of a row and a value that tells rows of one id and size apart, where not those of text_col.
    """
    keep = [c for c in docs.columns if c not in _OWN]
    key = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    # "+" sorts before "-": null sources come last
    # computed anew for sums, packets and result: counting words thrice costs less than writing all texts once
    rows = docs.select(
        F.struct(*keep).alias("row"), F.col(id_col).alias("id"), key.alias("key"), hashed.alias("hash"),
        (text_words(F.col(text_col)) if size is None else size).cast("long").alias("size"), (F.xxhash64(text_col) if tie is None else tie).alias("tie"),
    )
    slots = 1 << max(4, (max(1, docs.count()) // rows_per_slot).bit_length())
    # the slot is the top of the hash, so slot order is hash order
    rows = rows.withColumn("slot", F.floor(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long") / (2**32 // slots)).cast("long"))
    sums = materialize(rows.groupBy("key", "slot").agg(F.sum("size").alias("n")))
    targets = materialize(source_targets(sums.groupBy("key").agg(F.sum("n").alias("source_size")), weights, share, repeats))
    count, budget = targets.agg(F.count("*"), F.floor(F.coalesce(F.sum("target"), F.lit(0.0))).cast("long")).first()
    offsets = running_totals(sums, ["key", "slot"], before=F.col("n"))
    first = offsets.groupBy("key").agg(F.min("before").alias("base"))
    offsets = offsets.join(first, "key").select("key", "slot", (F.col("before") - F.col("base")).alias("offset"))
    targets = targets.withColumn("quantum", F.greatest(F.lit(1), F.ceil(F.col("target") / packets)).cast("long"))
    offsets = offsets.join(F.broadcast(targets) if count <= BROADCAST_SOURCES else targets, "key")
    inside = Window.partitionBy("key", "slot").orderBy("hash", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    queued = rows.join(offsets, ["key", "slot"]).withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    # all packets of all copies, in the global order of finish times
    copies = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("copy")
    served = queued.where("size > 0 and target > 0").select("key", "target", "quantum", "size", "start", "source_size", copies)
    end = F.explode(_ends(F.col("start") + F.col("source_size") * F.col("copy"), F.col("size"), F.col("quantum"))).alias("end")
    served = served.select("key", "target", "quantum", "start", "source_size", "copy", end)
    done = F.col("end") - F.col("start") - F.col("source_size") * F.col("copy")
    packet = served.select((F.col("end") / F.col("target")).alias("finish"), "key", "end", (done - (F.ceil(done / F.col("quantum")) - 1) * F.col("quantum")).cast("long").alias("n"))
    ordered = running_totals(packet, ["finish", "key", "end"], total=F.col("n"))
    cut = ordered.where(F.col("total") + F.col("n") > budget).agg(F.min(F.struct("finish", "key", "end", (budget - F.col("total")).alias("left"))).alias("s")).first()["s"]

    taken = F.lit(0).cast("long")
    for copy in range(repeats):
        begin = F.col("start") + F.col("source_size") * copy
        if cut is None:
            taken = taken + F.col("size")
            continue
        at = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["key"]).alias("key"), F.lit(cut["end"]).cast("long").alias("end"))
        place = lambda e: F.struct((e / F.col("target")).alias("finish"), F.col("key").alias("key"), e.alias("end"))
        ends = _ends(begin, F.col("size"), F.col("quantum"))
        some = F.coalesce(F.array_max(F.filter(ends, lambda e: place(e) < at)) - begin, F.lit(0)) + F.when(F.exists(ends, lambda e: place(e) == at), cut["left"]).otherwise(0)
        first_end = begin + F.least(F.col("size"), F.col("quantum"))
        taken = taken + F.when(place(begin + F.col("size")) < at, F.col("size")).when(place(first_end) > at, F.lit(0)).otherwise(some)
    out = queued.withColumn("taken", F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0).cast("long"))
    finish = F.when(F.col("target") > 0, (F.col("start") + F.col("size")) / F.col("target"))
    return out.select("row.*", "size", "source_size", "target", "taken", finish.alias("finish"))


def in_virtual_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix in global order of virtual finish time: a range partitioning, sorted within partitions."""
    return mixed.repartitionByRange(F.col("finish").asc_nulls_last(), F.col(id_col)).sortWithinPartitions(F.col("finish").asc_nulls_last(), id_col)


# ---------------------------------------------------------------- query


def op7_weighted_fair_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "source", text_words(F.col("text")).alias("words"), F.xxhash64("text").alias("tie"))
    return in_virtual_order(fair_mix(docs, size=F.col("words"), tie=F.col("tie")).drop("words", "tie"))


def mix_corpus(spark, docs, sf_dir):
    """Pipeline stage: documents that the mix takes words of, with what it takes and `finish`, their place in it; the rest go.

    Who reads the mix in order sorts by finish; sorting the texts here would move all of them once more.
    """
    return fair_mix(docs).where("taken > 0")


QUERIES = {"op7_weighted_fair_mix": op7_weighted_fair_mix}

#: The same sequentially: targets by filling capped sources first, then one running sum over all packets.
ORACLE = {
    "op7_weighted_fair_mix": r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS key, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY key) - 1) % 3 + 1] AS w FROM d GROUP BY key),
c AS (SELECT key, source_size, CAST(w AS DOUBLE) AS w, CAST(source_size AS DOUBLE) * 2 AS cap FROM s),
r AS (SELECT *, cap / w AS ratio, (SELECT CAST(sum(source_size) AS DOUBLE) FROM c) * 1.5 AS budget, (SELECT sum(w) FROM c) AS all_w,
    coalesce(sum(cap) OVER o, 0) AS filled, coalesce(sum(w) OVER o, 0) AS passed FROM c WINDOW o AS (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce((SELECT arg_min((budget - filled) / (all_w - passed), struct_pack(ratio, key)) FROM r WHERE (budget - filled) / (all_w - passed) <= ratio), 'inf'::DOUBLE) AS level),
t AS (SELECT key, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE least(cap, level * w) END AS target FROM r, l),
q AS (SELECT d.*, source_size, target, CAST(greatest(1, ceil(target / 4096)) AS BIGINT) AS quantum,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.key ORDER BY hash, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d JOIN t ON d.key = t.key),
k AS (SELECT doc_id, key, target, size, quantum, start + source_size * copy AS start, unnest(range(1, CAST(ceil(size / quantum) AS BIGINT) + 1)) AS p
  FROM q, (VALUES (0), (1)) v(copy) WHERE size > 0 AND target > 0),
e AS (SELECT doc_id, key, start + least(size, p * quantum) AS "end", least(size, p * quantum) - (p - 1) * quantum AS n, (start + least(size, p * quantum)) / target AS finish FROM k),
o AS (SELECT *, sum(n) OVER (ORDER BY finish, key, "end" ROWS UNBOUNDED PRECEDING) - n AS before FROM e),
g AS (SELECT doc_id, CAST(sum(greatest(0, least(n, (SELECT floor(sum(target)) FROM t) - before))) AS BIGINT) AS taken FROM o GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(g.taken, 0) AS taken, CASE WHEN q.target > 0 THEN (q.start + q.size) / q.target END AS finish FROM q LEFT JOIN g ON q.doc_id = g.doc_id
"""
}
