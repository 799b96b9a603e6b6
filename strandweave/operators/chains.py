"""Chains of hits to one subject: metrics, best chain per query, greedy selection of non-redundant subjects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import log_evalue
from ..scratch import written
from .intervals import beyond, oriented, union_length, weighted_over_segments_of
from .ordering import HOT

CHAIN = ("sample", "sacc")


def chain_metrics(hits: DataFrame, *, keys: Sequence[str] = CHAIN, penalty: float = 20.0, reads: DataFrame | None = None, qc: DataFrame | None = None) -> DataFrame:
    """One row for each chain: score, qlen, slen, contig_coverage (percent), pident, log_evalue, n_frag, ends, identity
    columns of its first hit, and numreads, pcthp and entropies where these tables are given (CHN-02)."""
    keys = list(keys)
    per_query = hits.groupBy(*keys, "qacc").agg(F.min_by("qlen", "ord").alias("qlen"), F.sum("score").alias("s"), F.count("*").alias("n"))
    if reads is not None:
        per_query = per_query.join(reads.groupBy("sample", "qacc").agg(F.sum("numreads").alias("numreads")), ["sample", "qacc"], "left")
    sums = [F.sum("qlen").cast("long").alias("qlen"), F.sum("s").alias("_s"), F.sum("n").alias("_n")]
    if reads is not None:
        sums.append(F.coalesce(F.sum("numreads"), F.lit(0)).cast("long").alias("numreads"))
    out = per_query.groupBy(*keys).agg(*sums)
    out = out.withColumn("raw_score", F.col("_s") - penalty * (F.col("_n") - 1))
    covered = union_length(hits, [*keys, "qacc"], "qstart", "qend", "c").groupBy(*keys).agg(F.sum("c").alias("_qcov"))
    first = [F.min_by(c, "ord").alias(c) for c in ("stitle", "staxids") if c in hits.columns]
    ends = hits.groupBy(*keys).agg(F.max(F.greatest("sstart", "send")).alias("send"), F.min(F.least("sstart", "send")).alias("sstart"), F.min("ord").alias("ord"), *first)
    cols = [] if qc is None else [c for c in qc.columns if c.startswith("entropy") or c == "frac_hp"]
    with_qc = hits.join(qc.select(F.col("acc").alias("qacc"), *cols), "qacc", "left") if cols else hits
    values = {"pident": "max"} | dict.fromkeys(cols, "avg")
    means = weighted_over_segments_of(with_qc, keys, "sstart", "send", values, {"pident": 1} | dict.fromkeys(cols, 12))
    out = out.join(union_length(hits, keys, "sstart", "send", "slen"), keys).join(covered, keys).join(means, keys).join(ends, keys)
    out = out.withColumn("contig_coverage", F.round(F.col("_qcov") * 100 / F.col("qlen"), 1)).withColumn("n_frag", F.col("_n").cast("int"))
    out = out.withColumn("log_evalue", log_evalue(F.col("raw_score"), F.col("qlen"))).withColumn("score", -F.col("log_evalue"))
    for c in cols:
        name, unit = ("pcthp", 100) if c == "frac_hp" else (c, 1)
        out = out.withColumnRenamed(c, name).withColumn(name, F.coalesce(F.round(F.col(name) * unit, 2), F.lit(-1.0)))
    return out.drop("_s", "_n", "_qcov")


def best_chain_per_query(hits: DataFrame, *, penalty: float = 20.0) -> DataFrame:
    """Each query's chain of the best score, the first on ties, with covered subject bases (CHN-05).

    One shuffle by query: covered bases come from a window, scores from an aggregation and the choice from another window, all
    over parts of the same keys, so rows dealt by query (`ordering.dealt`) aren't shuffled again.
    """
    lo, hi = oriented("sstart", "send")
    rows = hits.where("qacc is not null and sacc is not null").select("qacc", "sacc", "score", "ord", "qlen", lo.alias("_lo"), hi.alias("_hi"))
    rows = rows.withColumn("_added", beyond(["qacc", "sacc"]))
    chains = rows.groupBy("qacc", "sacc").agg(F.sum("score").alias("s"), F.count("*").alias("n"), F.min("ord").alias("ord"), F.max("qlen").alias("qlen"), F.sum("_added").cast("long").alias("slen"))
    chains = chains.withColumn("score", F.col("s") - penalty * (F.col("n") - 1))
    best = Window.partitionBy("qacc").orderBy(F.desc("score"), "ord")
    return chains.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("qacc", "sacc", "qlen", "slen", "n", "score")


def covers(min_unaligned: int = 1, max_aligned: int = 1 << 30) -> Column:
    """Whether a chain covers its query: fewer than min_unaligned bases beyond the covered subject bases, or max_aligned covered."""
    return (F.col("qlen") - F.col("slen") < min_unaligned) | (F.col("slen") >= max_aligned)


def alignment_filter(best: DataFrame, *, min_unaligned: int = 1, max_aligned: int = 1 << 30) -> DataFrame:
    """Queries that stay: at least min_unaligned bases beyond the covered subject bases, fewer than max_aligned covered (FLT-10)."""
    return best.where(~covers(min_unaligned, max_aligned))


# ---- greedy selection
#
# One by one, the chain of the best score is selected, its queries are removed from all others, and these are scored
# again. A removal can raise a score (a query whose hits score less than the penalty goes, the query length shrinks), so
# selected scores don't simply fall. Chains act on each other through shared queries only, which allows rounds: a chain whose score beats the highest score
# that any chain it shares queries with can still reach is selected before all of these, whatever happens
# elsewhere; all such chains, and the best of each sample, are selected at once. What came first is known afterwards
# from a key: a chain follows the last one that took queries from it, at once if it is better than that.


def query_scores(hits: DataFrame) -> DataFrame:
    """`sample, sacc, first, qacc, qlen, s, n`: a row for each query of a chain; first is the chain's place in the file."""
    per = hits.groupBy("sample", "sacc", "qacc").agg(F.min_by("qlen", "ord").alias("qlen"), F.sum(F.col("score").cast("double")).alias("s"), F.count("*").alias("n"))
    place = hits.groupBy("sample", "sacc").agg(F.min("ord").alias("first"))
    per, place = per.dropna(subset=["sample", "sacc", "qacc"]), place.dropna()
    return per.join(_small(place), ["sample", "sacc"])


def _small(chains: DataFrame) -> DataFrame:
    """A table of chains or samples, written, and broadcast where it has HOT rows at most."""
    chains = written(chains)
    return F.broadcast(chains) if chains.count() <= HOT else chains


def _round(live: DataFrame, after: DataFrame, penalty: float) -> DataFrame:
    """`sample, sacc, key` of the chains that are selected in this round."""
    gain = F.col("s") - penalty * F.col("n")
    chains = live.groupBy("sample", "sacc", "first").agg(
        F.sum("s").alias("_s"), F.sum("n").alias("_n"), F.sum("qlen").alias("_qlen"), F.sum(F.greatest(gain, F.lit(0.0))).alias("_up"), F.max(gain).alias("_one"), F.min("qlen").alias("_least"), F.count("*").alias("queries")
    )
    now = log_evalue(F.col("_s") - penalty * (F.col("_n") - 1), F.col("_qlen"))
    most = log_evalue(penalty + F.when(F.col("_one") > 0, F.col("_up")).otherwise(F.col("_one")), F.col("_least"))
    bound = F.when(F.col("queries") == 1, now).otherwise(F.least(now, most) - 0.01)  # a unit of rounding to spare
    chains = _small(chains.select("sample", "sacc", "first", "queries", now.alias("neg"), bound.alias("bound")))
    rows = live.select("sample", "sacc", "qacc").repartition("sample", "qacc").join(chains.drop("queries", "neg"), ["sample", "sacc"])
    rows = rows.withColumn("top", F.min(F.struct("bound", "first", "sacc")).over(Window.partitionBy("sample", "qacc")))
    is_top = F.col("sacc") == F.col("top.sacc")
    tops = rows.groupBy("sample", F.col("top.sacc").alias("_top")).agg(F.count_if(is_top).alias("tops"), F.min(F.when(~is_top, F.struct("bound", "first"))).alias("rival")).withColumnRenamed("_top", "sacc")
    ahead = chains.join(tops, ["sample", "sacc"]).where(F.col("tops") == F.col("queries"))
    own = F.struct(F.col("neg").alias("bound"), "first")
    ahead = ahead.where(F.col("rival").isNull() | (own < F.col("rival"))).select("sample", "sacc", "neg", "first")
    best = chains.groupBy("sample").agg(F.min(F.struct("neg", "first", "sacc")).alias("b")).select("sample", "b.sacc", "b.neg", "b.first")
    place = F.struct("neg", "first")
    key = F.concat(F.filter(F.coalesce("last", F.array().cast("array<struct<neg:double,first:bigint>>")), lambda x: x > place), F.array(place))
    return ahead.unionByName(best).distinct().join(after, ["sample", "sacc"], "left").select("sample", "sacc", key.alias("key"))


def greedy_owners(hits: DataFrame, *, penalty: float = 20.0) -> DataFrame:
    """`sample, qacc, owner, key`: the selected chain that takes each query; the order of keys is the order of selection.

    A round scores chains, finds each query's best bound and the best behind it, and removes the queries of the selected
    chains: aggregations and equi-joins by chain and by query. Rounds go on until no query is left; their number is that of
    the longest row of selections each of which waits for the one before.
    """
    live = written(query_scores(hits).withColumn("first", F.col("first").cast("bigint")))
    after = live.sparkSession.createDataFrame([], f"sample {live.schema['sample'].dataType.simpleString()}, sacc {live.schema['sacc'].dataType.simpleString()}, last array<struct<neg:double,first:bigint>>")
    out = []
    while not live.isEmpty():
        chosen = _small(_round(live, after, penalty))
        mine = live.repartition("sample", "qacc").join(chosen, ["sample", "sacc"], "left").withColumn("_owner", F.when(F.col("key").isNotNull(), F.struct(F.col("sacc").alias("owner"), "key")))
        taken = F.first("_owner", ignorenulls=True).over(Window.partitionBy("sample", "qacc"))
        marked = written(mine.select(*live.columns, taken.alias("_t")).select(*live.columns, "_t.owner", "_t.key"))
        out.append(marked.where("sacc = owner").select("sample", "qacc", "owner", "key"))
        lost = marked.where("sacc <> owner").select("sample", "sacc", F.col("key").alias("last"))
        live = marked.where("owner is null").select(*live.columns)
        after = written(after.unionByName(lost).groupBy("sample", "sacc").agg(F.max("last").alias("last")))
    return reduce(DataFrame.unionByName, out) if out else live.select("sample", "qacc", F.col("sacc").alias("owner"), F.lit(None).cast("array<struct<neg:double,first:bigint>>").alias("key"))


def selected_hits(hits: DataFrame, owners: DataFrame) -> DataFrame:
    """Hits of each selected chain as it was when it was selected: those of the queries that it took."""
    return hits.join(owners.select("sample", "qacc", F.col("owner").alias("sacc")), ["sample", "qacc", "sacc"], "left_semi")


def greedy_groups(hits: DataFrame, owners: DataFrame, *, penalty: float = 20.0, alt: float = 0.9, alternatives: str = "post_prune") -> DataFrame:
    """`sample, bin, position, sacc, representative, n_hits, n_queries, slen, log_evalue` of the selected chains and their alternatives.

    An alternative shares more than a tenth of the selected chain's queries, and its score, log e-value, covered
    subject and query length at that time are beyond alt times the selected chain's. What a chain had when another was
    selected are its queries that this or a later one takes, so a running sum from the last owner back gives its measures for all
    owners at once. Covered subject bases are found for pairs that pass all else.
    """
    own = query_scores(hits).join(owners, ["sample", "qacc"])
    by_owner = own.groupBy("sample", "sacc", "first", "owner", "key").agg(F.sum("qlen").alias("qlen"), F.sum("s").alias("s"), F.sum("n").alias("n"), F.count("*").alias("shared"))
    since = Window.partitionBy("sample", "sacc").orderBy(F.desc("key")).rowsBetween(Window.unboundedPreceding, 0)
    then = by_owner.select("sample", "sacc", "first", "owner", "key", "shared", *[F.sum(c).over(since).alias(c) for c in ("qlen", "s", "n")], F.sum("shared").over(since).alias("queries"))
    then = written(then.withColumn("e", log_evalue(F.col("s") - penalty * (F.col("n") - 1), F.col("qlen"))))

    lo, hi = F.least("sstart", "send").alias("lo"), F.greatest("sstart", "send").alias("hi")
    spans = hits.select("sample", "sacc", "qacc", lo, hi).join(owners, ["sample", "qacc"])
    covered = union_length(spans.where("sacc = owner"), ["sample", "sacc"], "lo", "hi", "slen")
    best = then.where("sacc = owner").join(covered, ["sample", "sacc"])
    best = written(best.withColumn("bin", (F.row_number().over(Window.partitionBy("sample").orderBy("key")) - 1).cast("int")))
    reps = best.select("sample", F.col("sacc").alias("owner"), "bin", *[F.col(c).alias(f"_{c}") for c in ("e", "qlen", "queries", "slen")])
    pairs = then.where("sacc <> owner").join(reps, ["sample", "owner"])
    pairs = pairs.where((-F.col("e") > alt * -F.col("_e")) & (F.col("e") < alt * F.col("_e")) & (F.col("qlen") > alt * F.col("_qlen")) & (F.col("shared") * 10 > F.col("_queries")))
    pairs = written(pairs)
    theirs = pairs.select("sample", "sacc", F.col("owner").alias("_c"), F.col("key").alias("_ck")).join(spans, ["sample", "sacc"]).where("key >= _ck")
    covered = union_length(theirs, ["sample", "sacc", "_c"], "lo", "hi", "slen").withColumnRenamed("_c", "owner")
    alts = pairs.join(covered, ["sample", "sacc", "owner"]).where(F.col("slen") > alt * F.col("_slen"))
    place = F.row_number().over(Window.partitionBy("sample", "owner").orderBy("e", "first")).cast("int")
    measures = [F.col("n").cast("int").alias("n_hits"), F.col("queries").cast("int").alias("n_queries"), F.col("slen").cast("int").alias("slen"), F.col("e").alias("log_evalue")]
    alts = alts.select("sample", "bin", place.alias("position"), "sacc", F.lit(False).alias("representative"), *measures)
    if alternatives == "post_prune":
        final = best.select("sample", "sacc", *measures)
        names = ("n_hits", "n_queries", "slen")
        alts = alts.drop(*names, "log_evalue").join(final, ["sample", "sacc"], "left").fillna({**dict.fromkeys(names, 0), "log_evalue": 0.0})
    tops = best.select("sample", "bin", F.lit(0).alias("position"), "sacc", F.lit(True).alias("representative"), *measures)
    return tops.unionByName(alts)


def greedy_select(hits: DataFrame, *, penalty: float = 20.0, alt: float = 0.9, alternatives: str = "post_prune") -> DataFrame:
    """Greedy selection (CHN-04); bins are numbered from 0 within a sample as they are selected, position 0 is the selected chain.

    alternatives: `post_prune` describes an alternative by what is left of it in the end, as a consumer sees it that
    drains the selection first: what it had when it was selected itself, or nothing; `snapshot` by what it had when the group was formed.
    """
    return greedy_groups(hits, greedy_owners(hits, penalty=penalty), penalty=penalty, alt=alt, alternatives=alternatives)


def query_components(hits: DataFrame, *, sample: str = "sample", rounds: int | None = None) -> DataFrame:
    """`sample, sacc, component`: subjects that share queries, directly or through others; the smallest subject names them.

    Subjects of one label hang on the smallest label that any of their queries has, and on the label of the subject
    that this one names, until no label changes. More than `rounds`, where given, is an error.
    Chains interact through shared queries only, so greedy selection of a component alone selects the same groups.
    """
    edges = written(hits.select(sample, "qacc", "sacc").distinct())
    labels = edges.select(sample, "sacc").distinct().withColumn("component", F.col("sacc"))
    for k in count(1):
        own = edges.join(labels, [sample, "sacc"])
        low = own.groupBy(sample, "qacc").agg(F.min("component").alias("m"))
        hung = written(own.join(low, [sample, "qacc"]).groupBy(sample, "component").agg(F.min("m").alias("_to")))
        if hung.where("component <> _to").isEmpty():
            return labels
        if k == rounds:
            raise RuntimeError(f"labels of subjects that share queries still change after {rounds} rounds")
        ahead = labels.select(sample, F.col("sacc").alias("_to"), F.col("component").alias("_next"))
        labels = written(labels.join(hung, [sample, "component"]).join(ahead, [sample, "_to"]).select(sample, "sacc", F.col("_next").alias("component")))


def without_queries(hits: DataFrame, used: DataFrame, keys: Sequence[str] = ("sample", "qacc")) -> DataFrame:
    """Hits of queries that weren't used (CHN-03)."""
    return hits.join(used.select(*keys).distinct(), list(keys), "left_anti")


def chain_hits(selected: DataFrame, hits: DataFrame) -> DataFrame:
    """Detail rows of selected chains (PRJ-16)."""
    cols = [c for c in ("qlen", "pident", "bitscore", "qstart", "qend", "sstart", "send", "btop", "numreads") if c in hits.columns]
    return hits.join(selected.select("sample", "sacc").distinct(), ["sample", "sacc"], "left_semi").select("sample", "sacc", "qacc", *cols)


def build_chains(hits: DataFrame, *, max_overlap: int = 0) -> DataFrame:
    """Alternative builder: in subject order, a hit joins the current chain unless it overlaps its end by more than max_overlap (REG-11)."""
    by = Window.partitionBy("sample", "sacc").orderBy(F.least("sstart", "send"), "ord")
    reach = F.max(F.greatest("sstart", "send")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNotNull() & (reach - F.least("sstart", "send") + 1 <= max_overlap), 0).otherwise(1)
    return hits.withColumn("_new", new).withColumn("chain", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
