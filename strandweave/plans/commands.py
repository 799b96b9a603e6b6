"""The commands as plans: lazy DataFrames in, lazy DataFrames out, many samples at once, keyed by `sample`."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..functions.scalars import best_words, file_safe, title_words
from ..operators import chains, hits as H, report, scaffold, taxonomy
from ..scratch import written

# Names of taxa that the default filters leave out.
HIT_EXCLUDES = (
    "artificial sequences", "unclassified sequences", "uncultured bacterium", "uncultured eukaryote", "uncultured fungus", "uncultured phage", "uncultured virus",
)
CLASS_EXCLUDES = ("Euteleostomi",)
BIN_EXCLUDES = ("Hominidae",)


def prefilter(hits: DataFrame, lin: DataFrame, *, hit_excludes: Sequence[str] = HIT_EXCLUDES, class_excludes: Sequence[str] = CLASS_EXCLUDES, hit_includes: Sequence[str] = ()) -> DataFrame:
    """Class, majority and relative score filters, in this order. A hit exclude of "None" lifts all hit excludes."""
    if "None" in hit_excludes:
        hit_excludes = ()
    if class_excludes:
        excluded = taxonomy.subtree(lin, taxonomy.ids_by_name(lin, class_excludes).select("tax_id"))
        hits = H.class_prefilter(hits, taxonomy.classify_contigs(hits, lin), excluded)
    if hit_excludes or hit_includes:
        hits = H.majority_prefilter(H.keep_flag(hits, taxonomy.allowed_ids(lin, hit_includes, hit_excludes))).drop("keep")
    return H.relative_score_prefilter(hits)


def word_scores(chain_rows: DataFrame, keys: Sequence[str], *, k: int = 4, weight: float = 2.0, order: str | None = None) -> DataFrame:
    """`keys, words`: the words of the chains' titles, log e-values halved with each place, summed, best k (TXT-06, AGG-30).

    Words of equal score come as first met, by `order` of the chains and place in the title; without it by name.
    """
    met = F.struct((F.col(order) if order else F.lit(0)).alias("o"), "idx")
    words = chain_rows.select(*keys, "log_evalue", *([order] if order else []), F.posexplode(title_words(F.col("stitle"))).alias("idx", "word"))
    per = words.groupBy(*keys, "word").agg(F.sum(F.col("log_evalue") / F.pow(F.lit(weight), F.col("idx"))).alias("score"), F.min(met).alias("met"))
    rank = F.struct("score", "met", "word") if order else F.struct("score", "word")
    ordered = F.transform(F.array_sort(F.collect_list(rank)), lambda x: x["word"])
    return per.groupBy(*keys).agg(F.array_join(best_words(ordered, k), " ").alias("words"))


def blastbin(
    hits: DataFrame, lin: DataFrame, *, coverage: DataFrame | None = None, qc: DataFrame | None = None, sizes: DataFrame | None = None, min_reads: int = 0, max_pcthp: float = 15,
    penalty: float = 20.0, bin_excludes: Sequence[str] = BIN_EXCLUDES, bin_includes: Sequence[str] = (), **filters,
) -> dict[str, DataFrame]:
    """calls and their hits: filters, prefilters, chains, greedy selection, LCA, words, lineage."""
    if coverage is not None and qc is not None and min_reads > 0:
        hits = H.read_and_simple(hits, coverage, min_reads, qc, max_pcthp)
    else:
        hits = H.min_reads(hits, coverage, min_reads) if coverage is not None else hits
        hits = H.max_homopolymer(hits, qc, max_pcthp) if qc is not None else hits
    hits = written(prefilter(hits, lin, **filters))
    owners = written(chains.greedy_owners(hits, penalty=penalty))
    groups = chains.greedy_groups(hits, owners, penalty=penalty)
    hits = written(chains.selected_hits(hits, owners))
    metrics = chains.chain_metrics(hits, penalty=penalty, reads=coverage, qc=qc)
    members = written(groups.select("sample", "bin", "position", "sacc", "representative").join(metrics, ["sample", "sacc"]))  # alternatives of which nothing was left fall out
    key = ["sample", "bin"]
    ids = members.select(*key, F.explode("staxids").alias("tax_id"), "position")
    lca = taxonomy.quorum_lca(ids, lin, key, "tax_id", order=F.col("position")).select(*key, "taxid")
    words = word_scores(members, key, order="position")
    top = members.where("representative").join(lca, key).join(words, key, "left")
    allowed = taxonomy.allowed_ids(lin, bin_includes, bin_excludes).select(F.col("tax_id").alias("taxid"))
    top = top.join(allowed, "taxid", "left_semi")
    if sizes is not None:
        from ..sources.readers import genome_sizes

        top = genome_sizes(top, sizes)
    calls = taxonomy.annotate(top, lin, "taxid").drop("position", "representative")
    return {"calls": calls, "hits": chains.chain_hits(calls, hits)}


def filter_blast(hits: DataFrame, contigs: DataFrame, *, min_unaligned: int = 1, max_aligned: int = 1 << 30) -> DataFrame:
    """Contigs whose best chain doesn't cover them; contigs without hits stay."""
    best = chains.best_chain_per_query(hits)
    gone = best.where(F.coalesce(chains.covers(min_unaligned, max_aligned), F.lit(True))).select(F.col("qacc").alias("acc"))
    return contigs.join(gone, "acc", "left_anti")


def fasta_qc(contigs: DataFrame, *, ks: Sequence[int] = (1, 2, 3, 4, 6, 10), kmin: int = 5) -> DataFrame:
    """Lengths, k-mer entropies and homopolymer share of each contig."""
    used = S.normalize_sequence(F.col("seq"))
    base = contigs.select("acc", F.length("seq").alias("len_all"), F.length(used).alias("len_used"), F.round(S.homopolymer_ratio(used, kmin), 4).alias("frac_hp"), used.alias("used"))
    out = S.with_entropies(base, "used", ks)
    return out.select("acc", "len_all", "len_used", *[F.round(f"entropy{k}", 4).alias(f"entropy{k}") for k in ks], "frac_hp")


def blast_classify(hits: DataFrame, lin: DataFrame, **kw) -> DataFrame:
    return taxonomy.blast_classify(hits, lin, **kw)


def export_fasta(calls: DataFrame, call_hits: DataFrame, contigs: DataFrame, *, lineage: str | None = None, bin_by: str = "sacc", max_fill: int = 50_000) -> dict[str, DataFrame]:
    """Scaffold sequences and mapping of calls; a lineage pattern is anchored and tested on each bin's first row."""
    named = calls.withColumn("bin", file_safe(F.col(bin_by).cast("string")))
    if lineage:
        first = named.groupBy("bin").agg(F.min_by("lineage", F.struct("sample", "sacc")).alias("_l")).where(F.col("_l").rlike(f"^(?:{lineage})"))
        named = named.join(first.select("bin"), "bin", "left_semi")
    own = call_hits.join(named.select("sample", "sacc").distinct(), ["sample", "sacc"], "left_semi")
    seqs, mapping = scaffold.scaffolds(own, contigs.select(F.col("acc").alias("qacc"), "seq"), max_fill=max_fill)
    bins = named.select("sample", "sacc", "bin")
    labelled = seqs.join(bins, ["sample", "sacc"]).withColumn("comment", F.format_string("%d bp", S.count_bp(F.col("seq"))))
    return {"sequences": labelled, "mapping": mapping.join(bins, ["sample", "sacc"])}


def find_bins(calls: DataFrame, records: DataFrame, *, lineage: str | None = None, bin_by: str = "species") -> tuple[DataFrame, DataFrame]:
    """(records with their bin, distinct bins): the bin of a `sample.sacc_pilon` record by its call, the last call of an sacc counting."""
    if lineage:
        calls = calls.where(F.col("lineage").rlike(f"^(?:{lineage})"))
    sample, sacc, _ = report.parse_scaffold_id(F.col("acc"))
    dim = calls.groupBy("sacc").agg(F.max_by(file_safe(F.col(bin_by).cast("string")), F.struct("sample")).alias("bin"))
    out = records.withColumn("sample", sample).withColumn("sacc", sacc).join(dim, "sacc")
    return out, out.select("bin").distinct()


def index_tree(nodes: DataFrame, path: str) -> None:
    """Writes the lineage table (SRC-11)."""
    taxonomy.lineage(nodes).write.mode("overwrite").parquet(path)


def prepare_phylo(
    queries: DataFrame, references: DataFrame, *, min_bp: int = 0, max_ambiguous: int | None = None, include_short: bool = False, include_full: bool = True, sample: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records, references not taken): query records of enough bases, short ones as `_partial`, then references whose
    unversioned accession isn't there yet (FLT-16, SET-06, SET-07)."""
    bp = S.count_bp(F.col("seq"))
    q = queries.withColumn("bp", bp).withColumn("acc", F.regexp_replace("acc", "_pilon$", ""))
    q = q.where(F.when(F.col("bp") < min_bp, F.lit(include_short)).otherwise(F.lit(include_full)))
    if max_ambiguous is not None:
        q = q.where(F.length("seq") - F.col("bp") <= max_ambiguous)
    if sample:
        q = q.where(F.substring_index("acc", ".", 1).rlike(sample))
    q = q.withColumn("acc", F.when(F.col("bp") < min_bp, F.concat("acc", F.lit("_partial"))).otherwise(F.col("acc")))
    plain = lambda df: df.withColumn("_plain", F.substring_index("acc", ".", 1))
    new = plain(references).join(plain(q).select("_plain").distinct(), "_plain", "left_anti").drop("_plain")
    taken = q.select("acc", "seq").unionByName(new.select("acc", "seq"))
    return taken, references.select("acc").join(new.select("acc"), "acc", "left_anti")


def download_candidates(genomes: DataFrame, taxid: int, size: float, *, tolerance: float = 0.2) -> DataFrame:
    """Genomes of a taxon within 20 % of a length, from a table that was fetched before (API-08; no network here)."""
    return genomes.where((F.col("taxid") == taxid) & F.col("length").between(size * (1 - tolerance), size * (1 + tolerance)))


def genome_sets(genomes: DataFrame, nodes: DataFrame, lin: DataFrame, taxa: DataFrame, *, outgroup: str = "no", tolerance: float = 0.2, min_len: float = 500, max_len: float = 50_000) -> DataFrame:
    """`taxid, source, acc`: for every taxon of `taxa` (`taxid, size`) the genomes to compare, from a table that was fetched before (API-08, SRT-08).

    Own genomes are those of the taxon or of anything below it, within the tolerance of its size, or from min_len to
    max_len where the size is null. outgroup `yes` adds, and `only` gives, for each sibling (same parent and rank) the first
    reference genome of the sibling or below it; siblings without one are left out. genomes: `acc, ord, taxid, length, reference`.

    Genomes climb to all their ancestors once, for all taxa together, and only the first of each node goes on to the siblings.
    """
    up = lin.select(F.col("tax_id").alias("taxid"), F.explode(F.concat(F.array(F.lit(taxonomy.ROOT).cast("long")), "path")).alias("source"))
    above = genomes.join(up, "taxid").drop("taxid")
    own = taxa.select(F.col("taxid").cast("long").alias("taxid"), F.col("size").cast("double").alias("size"))
    out = []
    if outgroup != "only":
        lo, hi = F.coalesce(F.col("size") * (1 - tolerance), F.lit(float(min_len))), F.coalesce(F.col("size") * (1 + tolerance), F.lit(float(max_len)))
        mine = above.join(own.withColumnRenamed("taxid", "source"), "source").where(F.col("length").between(lo, hi))
        out.append(mine.select(F.col("source").alias("taxid"), "source", "acc"))
    if outgroup != "no":
        first = above.where("reference").groupBy("source").agg(F.min_by("acc", F.struct("ord", "acc")).alias("acc"))
        tree = nodes.where(F.col("parent_id") != F.col("tax_id"))
        me = tree.join(own.select(F.col("taxid").alias("tax_id")).distinct(), "tax_id").select(F.col("tax_id").alias("taxid"), "parent_id", "rank")
        near = me.join(tree.select(F.col("tax_id").alias("source"), "parent_id", "rank"), ["parent_id", "rank"]).where(F.col("taxid") != F.col("source"))
        out.append(near.join(first, "source").select("taxid", "source", "acc"))
    return reduce(DataFrame.unionByName, out)


def full_report(calls: DataFrame, coverage: DataFrame, scaffolds: DataFrame, qc: DataFrame, vhdb: DataFrame, *, whitelist: Sequence[str] = (), host: str | None = None, **thresholds) -> dict[str, DataFrame]:
    """Sheets of the report: all calls, thresholds, species, viruses with hosts and respiratory flag, by species and by sample."""
    joined = written(report.join_parts(calls, coverage, scaffolds, qc))  # every sheet and every count begins here
    full = report.add_genome_coverage(joined)
    kept, removed = report.threshold_cascade(full, report.default_rules(**thresholds))
    hosted = report.flag_respiratory(report.annotate_hosts(report.viruses(kept), vhdb), whitelist or report.RESPIRATORY)
    chosen = hosted.where(F.col("host").rlike(host)) if host else hosted
    merged = report.merge_species(chosen.where("respiratory"))
    out = {"Calls": full, "Filtered": kept, "Thresholds": removed, "Species Found": report.species_found(kept), "Virus Detections": hosted, "Respiratory Viruses": merged, "Positive Samples": report.merge_samples(merged)}
    out["Summary"] = report.summary([(name, df, name) for name, df in out.items()])
    return out


# ---- relations among reads


def reads_in(reads: DataFrame, ids: DataFrame, *, keep: bool = True) -> DataFrame:
    """Reads whose id is in a list, or is not."""
    return reads.join(ids.select("read_id").distinct(), "read_id", "left_semi" if keep else "left_anti")


def flagged(alignments: DataFrame, bits: int, *, all_set: bool = True) -> DataFrame:
    """Alignments with all of some flag bits, or none of them."""
    return alignments.where(F.col("flag").bitwiseAND(bits) == (bits if all_set else 0))


def umi_dedup(reads: DataFrame, pattern: str) -> DataFrame:
    """One read for each position, strand and UMI, which a pattern's first group takes from the id."""
    return reads.withColumn("umi", F.regexp_extract("read_id", pattern, 1)).dropDuplicates(["chrom", "pos", "strand", "umi"])


def junctions(rows: DataFrame, least: int, most: int) -> DataFrame:
    return rows.where(F.col("end").cast("long") - F.col("start") + 1 >= least).where(F.col("end").cast("long") - F.col("start") + 1 <= most)


REGISTRY = {
    "blast-classify": blast_classify, "blastbin": blastbin, "download-genomes": download_candidates, "export-fasta": export_fasta, "fasta-qc": fasta_qc, "filter-blast": filter_blast,
    "find-bins": find_bins, "genome-sets": genome_sets, "index-tree": index_tree, "prepare-phylo": prepare_phylo, "report": full_report,
}
