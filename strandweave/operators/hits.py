"""Operators on alignment hits: runs of equal subjects, prefilters, masks by reads, homopolymers and taxa."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written
from .taxonomy import BROADCAST_NODES

QUERY = ("sample", "qacc")


def islands(df: DataFrame, keys: Sequence[str] = QUERY, value: str = "sacc", order: str = "ord", name: str = "island") -> DataFrame:
    """df with the number of its run of consecutive equal values, from 1 (WIN-01)."""
    by = Window.partitionBy(*keys).orderBy(order)
    start = F.lag(value).over(by)
    new = F.when(start.isNotNull() & (start == F.col(value)), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def keep_flag(hits: DataFrame, allowed: DataFrame, name: str = "keep") -> DataFrame:
    """hits with a flag: all of a hit's taxids are allowed; a hit without any passes.

    Up to BROADCAST_NODES allowed ids are broadcast to the ids of each hit, which meet again in a window by query and place: hits that
    are dealt by query aren't shuffled.
    """
    if allowed.count() <= BROADCAST_NODES:
        ids = hits.select("*", F.posexplode_outer("staxids").alias("_pos", "_tax_id"))
        found = ids.join(F.broadcast(allowed.select(F.col("tax_id").alias("_tax_id"), F.lit(True).alias("_allowed")).distinct()), "_tax_id", "left")
        bad = F.max(F.col("_pos").isNotNull() & F.col("_allowed").isNull()).over(Window.partitionBy("sample", "qacc", "ord"))
        unnamed = F.col("sample").isNull() | F.col("qacc").isNull() | F.col("ord").isNull()
        return found.withColumn("_keep", unnamed | ~bad).where("coalesce(_pos, 0) = 0").select(*[c for c in hits.columns if c != name], F.col("_keep").alias(name))
    ids = hits.select("sample", "qacc", "ord", F.explode("staxids").alias("tax_id"))
    bad = ids.join(allowed.select(F.col("tax_id")), "tax_id", "left_anti").select("sample", "qacc", "ord").distinct().withColumn("_bad", F.lit(True))
    return hits.join(bad, ["sample", "qacc", "ord"], "left").withColumn(name, F.col("_bad").isNull()).drop("_bad")


def majority_prefilter(hits: DataFrame, keep: str = "keep", *, keys: Sequence[str] = QUERY, share: float = 0.9) -> DataFrame:
    """Drops queries more than half of whose top hits (bitscore > 0.9 of the best) are rejected, then rejected hits (FLT-04)."""
    by = Window.partitionBy(*keys)
    top = F.col("bitscore") > F.max("bitscore").over(by) * share
    rows = hits.withColumn("_top", top)
    kept = F.sum(F.when(F.col("_top") & F.col(keep), 1).otherwise(0)).over(by)
    tops = F.sum(F.col("_top").cast("int")).over(by)
    return rows.withColumn("_kept", kept).withColumn("_tops", tops).where((F.col("_kept") * 2 >= F.col("_tops")) & F.col(keep)).drop("_top", "_kept", "_tops")


def relative_score_prefilter(hits: DataFrame, *, keys: Sequence[str] = QUERY, share: float = 0.9, slack: float = 1.5, less: float = 0.5) -> DataFrame:
    """Keeps runs of a subject whose summed score and mean identity come near those of the query's first run (FLT-05).

    Runs are summed by windows over the partitioning that numbering them needs anyway, so there is one shuffle.
    """
    rows = islands(hits, keys)
    run = Window.partitionBy(*keys, "island")
    rows = rows.withColumn("_sum", F.sum("score").over(run)).withColumn("_avg", F.avg("pident").over(run))
    first = Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_sum0", F.first("_sum").over(first)).withColumn("_avg0", F.first("_avg").over(first))
    good = (F.col("_sum") > F.col("_sum0") * share) & (F.col("_avg") > 100 - (100 - F.col("_avg0")) * slack - less)
    return rows.where(good).drop("island", "_sum", "_avg", "_sum0", "_avg0")


def min_reads(hits: DataFrame, coverage: DataFrame, least: int) -> DataFrame:
    """Queries with at least `least` reads over all units; queries without coverage have none (FLT-01, Q22)."""
    reads = coverage.groupBy("sample", "qacc").agg(F.sum("numreads").alias("_reads")).where(F.col("_reads") >= least)
    return hits if least <= 0 else hits.join(reads.select("sample", "qacc"), ["sample", "qacc"], "left_semi")


def read_and_simple(hits: DataFrame, coverage: DataFrame, least: int, qc: DataFrame, most_pct: float) -> DataFrame:
    """`min_reads` and `max_homopolymer` at once. What stays of them has one row for each query name, with its samples, so that hits which are dealt by
    query name aren't shuffled."""
    reads = coverage.repartition("qacc").groupBy("sample", "qacc").agg(F.sum("numreads").alias("_reads")).where(F.col("_reads") >= least)
    stay = max_homopolymer(reads.groupBy("qacc").agg(F.collect_set("sample").alias("_samples")), qc, most_pct)
    return hits.join(written(stay), "qacc").where(F.array_contains("_samples", F.col("sample"))).select(*hits.columns)


def max_homopolymer(hits: DataFrame, qc: DataFrame, most_pct: float) -> DataFrame:
    """Queries whose homopolymer share is at most most_pct percent (FLT-02)."""
    good = qc.where(F.col("frac_hp") * 100 <= most_pct).select(F.col("acc").alias("qacc"))
    return hits.join(good, "qacc", "left_semi")


def class_prefilter(hits: DataFrame, classes: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drops queries whose own class lies in an excluded subtree (FLT-06). They are found by name, with their samples, so that hits which are dealt by
    query name aren't shuffled."""
    ids = excluded.select(F.col("tax_id").alias("taxid"))
    bad = classes.join(F.broadcast(ids) if ids.count() <= BROADCAST_NODES else ids, "taxid", "left_semi").groupBy("qacc").agg(F.collect_set("sample").alias("_samples"))
    return hits.join(bad, "qacc", "left").where(~F.coalesce(F.array_contains("_samples", F.col("sample")), F.lit(False))).select(*hits.columns)
