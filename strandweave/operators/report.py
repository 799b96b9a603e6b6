"""Report tables over calls: coverage, scaffolds and quality joins, threshold cascade, merges by species and sample, hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_elements, genome_coverage
from ..scratch import written
from .ordering import join_groups, numbered
from .taxonomy import prefix_rows


def parse_scaffold_id(acc: Column) -> tuple[Column, Column, Column]:
    """(sample, sacc, fragment) of `sample.sacc_fragment_pilon`: the first `digit_1-3 digits` splits off the fragment."""
    clean = F.regexp_replace(acc, "_pilon$", "")
    parts = F.split(clean, r"\.")
    marked = F.split(F.regexp_replace(F.get(parts, 1), r"^(.*?\d)_(\d{1,3})", "$1:$2"), ":")
    return F.get(parts, 0), F.get(marked, 0), F.get(marked, 1)


def coverage_by_call(coverage: DataFrame) -> DataFrame:
    """Reads by (sample, sacc), over fragments (AGG-12)."""
    sample, sacc, _ = parse_scaffold_id(F.col("#rname"))
    return coverage.groupBy(sample.alias("sample"), sacc.alias("sacc")).agg(F.sum("numreads").alias("numreads"))


def segment_bp(scaffolds: DataFrame, keys: Sequence[str] = ("sample", "sacc")) -> DataFrame:
    """bp by key with every subject segment counted once, however many rows it has (AGG-13)."""
    seg = scaffolds.groupBy(*keys, "sstart", "send").agg(F.avg("bp").alias("_bp"))
    return seg.groupBy(*keys).agg(F.sum("_bp").alias("bp"))


def weighted_qc(qc: DataFrame, keys: Sequence[str] = ("sample", "sacc"), weight: str = "len_used") -> DataFrame:
    """pcthp (1 digit) and the mean of all entropies (2 digits), weighted by used length (AGG-14)."""
    ks = [c for c in qc.columns if c.startswith("entropy")]
    w = F.col(weight)
    out = [F.round(F.sum(F.col("frac_hp") * w) / F.sum(w) * 100, 1).alias("pcthp")]
    if ks:
        mean = sum((F.col(c) for c in ks), F.lit(0.0)) / len(ks)
        out.append(F.round(F.sum(mean * w) / F.sum(w), 2).alias("entropy"))
    return qc.groupBy(*keys).agg(*out)


def join_parts(calls: DataFrame, *parts: DataFrame, keys: Sequence[str] = ("sample", "sacc")) -> DataFrame:
    """Left joins on (sample, sacc), dropping columns of calls that a part brings (JOI-06)."""
    for p in parts:
        calls = calls.drop(*[c for c in p.columns if c in calls.columns and c not in keys]).join(p, list(keys), "left")
    return calls


def add_genome_coverage(calls: DataFrame) -> DataFrame:
    return calls.withColumn("genome_coverage", genome_coverage(F.col("bp"), F.col("genome_size")))


def default_rules(min_bp=200, min_aligned_bp=150, min_reads=3, min_pident=70, max_pcthp=12) -> list[tuple[str, Column]]:
    return [
        ("min_bp", F.col("bp") >= min_bp),
        ("min_aligned_bp", F.col("bp") * F.col("contig_coverage") / 100 >= min_aligned_bp),
        ("min_reads", F.col("numreads") >= min_reads),
        ("min_pident", F.col("pident") >= min_pident),
        ("max_pcthp", F.col("pcthp") <= max_pcthp),
    ]


def first_failing(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule a row fails (a null comparison fails), null if it passes all."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(list(rules)):
        out = F.when(F.coalesce(ok, F.lit(False)), out).otherwise(F.lit(name))
    return out


def threshold_cascade(calls: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, `rule, removed` counts in one pass): each step counts what the steps before left (FLT-11)."""
    marked = calls.withColumn("_rule", first_failing(rules))
    names = calls.sparkSession.createDataFrame([(k, n) for k, (n, _) in enumerate(rules)], "step int, rule string")
    counts = marked.where("_rule is not null").groupBy(F.col("_rule").alias("rule")).agg(F.count("*").alias("removed"))
    counts = names.join(counts, "rule", "left").select("step", "rule", F.coalesce("removed", F.lit(0)).alias("removed"))
    return marked.where("_rule is null").drop("_rule"), counts


def viruses(calls: DataFrame) -> DataFrame:
    return calls.where(F.col("lineage").startswith("Viruses;"))


def whitelisted(calls: DataFrame, patterns: Sequence[str], col: str = "species") -> DataFrame:
    """Rows that any of the case-insensitive patterns matches (FLT-13)."""
    return calls.where(F.col(col).rlike("(?i)(" + "|".join(patterns) + ")")) if patterns else calls


def species_found(calls: DataFrame) -> DataFrame:
    return calls.groupBy("species").agg(F.countDistinct("sample").alias("n_samples"), F.sum("numreads").alias("numreads")).orderBy("species")


# Terms of known respiratory viruses, where no list is given.
RESPIRATORY = (
    "Rhinovirus", "Coronavirus", "Influenza", "Metapneumovirus", "Enterovirus", "Orthopneumovirus", "Parainfluenza", "Respirovirus", "Rubulavirus", "Respiratory", "Bocavirus", "Adenovirus",
)


def flag_respiratory(calls: DataFrame, patterns: Sequence[str] = RESPIRATORY, col: str = "taxname") -> DataFrame:
    """calls with `respiratory` right after the name: whether any of the patterns matches it, in any case (FLT-14). Calls without names are judged by species."""
    col = col if col in calls.columns else "species"
    at = calls.columns.index(col) + 1
    flag = F.col(col).rlike("(?i)(" + "|".join(patterns) + ")").alias("respiratory")
    others = [c for c in calls.columns if c != "respiratory"]
    return calls.select(*others[:at], flag, *others[at:])


def _text(value: Column) -> Column:
    """A value as it is written in a list: whole numbers without a point, null as NA."""
    return F.coalesce(F.regexp_replace(value.cast("string"), r"\.0$", ""), F.lit("NA"))


def _listed(name: str, order: Sequence[str], sep: str) -> Column:
    """The values of a group in a stated order."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], _text(F.col(name)).alias("v"))))
    return F.array_join(F.transform(rows, lambda x: x["v"]), sep)


def _distinct(values: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(values), lambda v: _text(v)), ", ")


def merge_species(calls: DataFrame, *, order: Sequence[str] = ("sacc",)) -> DataFrame:
    """One row for each (sample, species) (AGG-16).

    Reads are summed, the largest scaffold and the least log e-value kept, identity is weighted by subject length,
    homopolymer share and entropy by scaffold length. Names and ids become sorted distinct lists (", "), the values of single
    calls lists in the calls' order (";"). Columns that calls lack are left out.
    """
    mean = lambda c, w, d: F.round(F.sum(F.col(c) * F.col(w)) / F.sum(w), d)
    has = set(calls.columns)
    out = [("taxnames", {"taxname"}, lambda: _distinct(F.collect_set("taxname"))), ("numreads", {"numreads"}, lambda: F.sum("numreads")), ("max_bp", {"bp"}, lambda: F.max("bp"))]
    out += [("pident", {"pident", "slen"}, lambda: mean("pident", "slen", 1)), ("pcthp", {"pcthp", "bp"}, lambda: mean("pcthp", "bp", 1)), ("entropy", {"entropy", "bp"}, lambda: mean("entropy", "bp", 4))]
    out += [(f"{c}s", {c}, lambda c=c: _listed(c, order, ";")) for c in ("genome_coverage", "bp", "n_frag")]
    out += [("min_log_evalue", {"log_evalue"}, lambda: F.min("log_evalue")), ("saccs", {"sacc"}, lambda: _listed("sacc", order, ";"))]
    if "staxids" in has:
        ids = F.col("staxids").cast("array<string>") if calls.schema["staxids"].dataType.simpleString().startswith("array") else F.split("staxids", ";")
        out.append(("staxids", {"staxids"}, lambda: _distinct(F.array_distinct(F.flatten(F.collect_list(ids))))))
    out += [("taxids", {"taxid"}, lambda: _distinct(F.collect_set("taxid"))), ("lineages", {"lineage"}, lambda: _distinct(F.collect_set("lineage")))]
    return calls.groupBy("sample", "species").agg(*[make().alias(name) for name, need, make in out if need <= has])


# Columns of the by-species table and their names in the by-sample table.
BY_SAMPLE = {
    "taxnames": "taxnames", "numreads": "numreadss", "max_bp": "max_bps", "pident": "pidents", "pcthp": "pcthps", "entropy": "entropies", "n_frags": "n_frags",
    "genome_coverages": "genome_coverages", "min_log_evalue": "min_log_evalues", "saccs": "saccs",
}


def merge_samples(merged: DataFrame, *, sep: str = " | ") -> DataFrame:
    """One row for each sample of a by-species table: its values as lists, most reads first, ties by species (AGG-17)."""
    rows = merged.withColumn("_most", -F.col("numreads"))
    return rows.groupBy("sample").agg(*[_listed(c, ("_most", "species"), sep).alias(name) for c, name in BY_SAMPLE.items() if c in merged.columns])


def sheet_rollup(units: DataFrame) -> DataFrame:
    """Sample sheet by sample: units, their number, processed and mapped reads (AGG-19)."""
    return units.groupBy("sample").agg(F.array_join(F.array_sort(F.collect_list("unit")), ", ").alias("units"), F.count("*").alias("n_units"), F.sum("processed").alias("processed"), F.sum("mapped").alias("mapped"))


def with_sheet(sheet: DataFrame, coldata: DataFrame, positives: DataFrame) -> DataFrame:
    return sheet.join(coldata, ["unit", "sample"], "left").join(positives, "sample", "left")


def drop_redundant_unit(calls: DataFrame) -> DataFrame:
    """Without `unit` if it equals `sample` on all rows (PRJ-03)."""
    if "unit" not in calls.columns:
        return calls
    same = calls.agg(F.bool_and(F.col("unit").eqNullSafe(F.col("sample")))).first()[0]
    return calls.drop("unit") if same in (True, None) else calls


def rewrite_sample(calls: DataFrame, pattern: str) -> DataFrame:
    """Sample names cut to the pattern's first group (PRJ-20)."""
    return calls.withColumn("sample", F.regexp_replace("sample", f"{pattern}.*", "$1"))


def summary(steps: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """`step, description, count, tab`: a row for each stage of a report (AGG-40)."""
    out = None
    for k, (what, df, tab) in enumerate(steps):
        row = df.agg(F.count("*").alias("count")).select(F.lit(k).alias("step"), F.lit(what).alias("description"), "count", F.lit(tab).alias("tab"))
        out = row if out is None else out.unionByName(row)
    return out


def properties(spark, items: dict[str, Sequence]) -> DataFrame:
    """Two-column table of named values, lists joined by ", " (PRJ-12)."""
    return spark.createDataFrame([(k, ", ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)) for k, v in items.items()], "name string, value string")


# Codes of report columns and their display names.
DISPLAY_NAMES = {
    "unit": "Unit", "sample": "Sample", "samples": "Sample(s)", "n_samples": "Sample Count", "words": "Title Summary", "log_evalue": "Log E-Value", "min_log_evalue": "Log E-Value (min)",
    "min_log_evalues": "Log E-Value(s) (min)", "n_frag": "Contig Count", "n_frags": "Contig Count(s)", "sacc": "Reference Accession", "saccs": "Reference Accession(s)", "stitle": "Reference Title",
    "staxids": "Reference Taxonomy IDs", "genome_size": "Reference Genome Size", "genome_size_source": "Reference Size Source", "pident": "% Identity", "pidents": "% Identity(s)",
    "numreads": "Read Count", "numreadss": "Read Count(s)", "taxid": "Taxonomy ID", "taxids": "Taxonomy IDs", "taxname": "Taxonomic Name", "taxnames": "Taxonomic Name(s)",
    "species": "Species Name", "lineage": "Lineage", "lineages": "Lineage(s)", "lineage_ranks": "Lineage Ranks", "bp": "Scaffold BP", "bps": "Scaffold BP(s)", "max_bp": "Max. Scaffold BP",
    "max_bps": "Max. Scaffold BP(s)", "slen": "Subject Length", "genome_coverage": "% Genome", "genome_coverages": "% Genome(s)", "contig_coverage": "% Aligned",
    "positive_samples": "Positive Samples", "host": "Host", "respiratory": "Known Respiratory Virus", "unit_names": "Sequencing Units", "num_units": "Unit Count",
    "trimmed_read_count": "Trimmed Reads", "mapped_read_count": "Mapped Reads", "pcthp": "% Homopolymer", "pcthps": "% Homopolymer(s)", "entropy": "Entropy", "entropies": "Entropy(s)",
}


def relocated(df: DataFrame, columns: Sequence[str], *, after: str | None = None) -> DataFrame:
    """df with some columns moved to the front, or behind another one; the order of the rest stays (PRJ-02)."""
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(after) + 1 if after else 0
    return df.select(*rest[:at], *columns, *rest[at:])


def rounded(df: DataFrame, columns: Sequence[str] = ("log_evalue",)) -> DataFrame:
    """Whole columns rounded to whole numbers, halves to even (PRJ-21)."""
    return df.withColumns({c: F.bround(c) for c in columns if c in df.columns})


def placed(hits: DataFrame) -> DataFrame:
    """hits with the placement of their contig on their subject (JOI-13)."""
    return hits.join(contig_placement(hits), ["sacc", "qacc"], "left")


def displayed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: DISPLAY_NAMES[c] for c in df.columns if c in DISPLAY_NAMES})


# ---- hosts


def host_table(raw: DataFrame, blacklist: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Column names with blanks to underscores, lower case, prefixed; blacklisted viruses out (PRJ-05, FLT-17)."""
    out = raw.toDF(*[prefix + c.replace(" ", "_").lower() for c in raw.columns])
    return out.join(blacklist, blacklist.columns, "left_anti") if blacklist is not None else out


def share_filter(rows: DataFrame, key: str, name: str, lineage: str, least: float = 0.1) -> DataFrame:
    """Rows with a name and a lineage whose first, first two and first three levels each hold `least` of all the key's rows (FLT-18, WIN-13).

    A level's rows are among those of the level above, so the three filters in a row are one on the first three levels. Rows
    without a name or a lineage count in the total only. Counts are aggregated and joined back, no key's rows meet in one task.
    """
    level = F.when(F.col(name).isNotNull(), first_elements(F.col(lineage), 3))
    known = rows.withColumn("_level", level)
    counts = known.groupBy(key, "_level").agg(F.count("*").alias("_n"))
    total = counts.groupBy(key).agg(F.sum("_n").alias("_all"))
    good = counts.where("_level is not null").join(total, key).where(F.col("_n") / F.col("_all") >= least).select(key, "_level", "_n")
    return join_groups(known.where("_level is not null"), written(good), [key, "_level"], "_n").drop("_level", "_n")


def host_summary(rows: DataFrame, key: str, name: str, lineage: str) -> DataFrame:
    """Sorted unique host names joined by ";", UNSPECIFIC from 2^15 characters on, empty where no host is left (AGG-20).

    Shares are of all rows, those without a name too. Names are collected only where they fit.
    """
    kept = share_filter(rows, key, name, lineage).select(key, F.col(name).alias("_name")).distinct()
    size = kept.groupBy(key).agg((F.sum(F.length("_name") + 1) - 1).alias("_size"))
    short = kept.join(size.where(F.col("_size") < 1 << 15), key).groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("_name")), ";").alias("_host"))
    long_ = size.where(F.col("_size") >= 1 << 15).select(key, F.lit("UNSPECIFIC").alias("_host"))
    return rows.select(key).distinct().join(short.unionByName(long_), key, "left").select(key, F.coalesce("_host", F.lit("")).alias("host"))


def annotate_hosts(calls: DataFrame, vhdb: DataFrame, *, mode: str = "element") -> DataFrame:
    """calls with `host`: hosts by taxid, else by the longest lineage prefix that the table knows (TAX-14, JOI-09).

    vhdb: `virus_tax_id, virus_lineage, virus_name, host_name, host_lineage`. Hosts are summed up once for each prefix,
    however many calls it serves.
    """
    by_id = vhdb.where(F.col("host_name").isNotNull()).groupBy(F.col("virus_tax_id").alias("taxid")).agg(F.array_join(F.array_sort(F.collect_set("host_name")), "; ").alias("_by_id"))
    out = calls.join(by_id, "taxid", "left")
    table = vhdb.select(F.concat_ws("; ", "virus_lineage", "virus_name").alias("_lineage"), "host_name", "host_lineage")
    pending = out.where("_by_id is null and lineage is not null").select("lineage")
    chosen, below = prefix_rows(pending, table, "lineage", "_lineage", mode=mode)
    hosts = host_summary(below, "prefix", "host_name", "host_lineage").withColumnRenamed("host", "_by_lineage")
    found = chosen.join(hosts, "prefix").select("lineage", "_by_lineage")
    return out.join(found, "lineage", "left").withColumn("host", F.coalesce("_by_id", "_by_lineage")).drop("_by_id", "_by_lineage").select(*calls.columns, "host")


# ---- plots' input tables


def flip_contigs(hits: DataFrame) -> DataFrame:
    """Contigs whose hits are mostly reverse are mirrored: `qlen - q + 1`, ends swapped (WIN-06, SEQ-12)."""
    by = Window.partitionBy("sacc", "qacc")
    rev = F.median((F.col("sstart") > F.col("send")).cast("double")).over(by) > 0.5
    out = hits.withColumn("flip", rev)
    mirrored = lambda c: F.col("qlen") - F.col(c) + 1
    return out.select(
        *[c for c in hits.columns if c not in ("qstart", "qend", "sstart", "send")],
        "flip",
        F.when(F.col("flip"), mirrored("qend")).otherwise(F.col("qstart")).alias("qstart"), F.when(F.col("flip"), mirrored("qstart")).otherwise(F.col("qend")).alias("qend"),
        F.when(F.col("flip"), F.col("send")).otherwise(F.col("sstart")).alias("sstart"), F.when(F.col("flip"), F.col("sstart")).otherwise(F.col("send")).alias("send"),
    )


def contig_placement(hits: DataFrame) -> DataFrame:
    """Where each contig lies on its subject, by its first hit (WIN-07, PRJ-22)."""
    first = Window.partitionBy("sacc", "qacc").orderBy("qstart", "sstart")
    rows = hits.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    start = (F.col("sstart") + F.col("send")) / 2 - (F.col("qstart") + F.col("qend")) / 2 + 1
    return rows.select("sacc", "qacc", start.alias("cstart"), (start + F.col("qlen")).alias("cend"))


def stranded_depth(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """`contig, pos, plus, minus` with 0 where a strand has none (JOI-12)."""
    p = plus.select("contig", "pos", F.col("depth").alias("plus"))
    m = minus.select("contig", "pos", F.col("depth").alias("minus"))
    return p.join(m, ["contig", "pos"], "full_outer").fillna(0, ["plus", "minus"])


def depth_cap(depth: DataFrame, keys: Sequence[str], value: str = "depth") -> DataFrame:
    """Mean, deviation, maximum and a drawing cap of mean + 3 deviations (AGG-32)."""
    s = depth.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.max(value).alias("max"))
    return s.withColumn("cap", F.least(F.col("max").cast("double"), F.col("mean") + 3 * F.coalesce("sd", F.lit(0.0))))


def binned_median(depth: DataFrame, keys: Sequence[str], value: str = "depth", bins: int = 2000) -> DataFrame:
    """Medians over at most `bins` equal stretches of each key's positions (AGG-33)."""
    span = depth.groupBy(*keys).agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    at = F.floor((F.col("pos") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo") + 1))
    rows = depth.join(span, list(keys)).withColumn("bin", at)
    return rows.groupBy(*keys, "bin").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.median(value).alias("median"))


def merge_annotations(features: DataFrame) -> DataFrame:
    """Annotations split over display ranges, merged: min start, max stop by whole range, key and value (AGG-41)."""
    return features.groupBy("acc", "gstart", "gstop", "key", "value").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).distinct()


def top_calls(calls: DataFrame, n: int) -> DataFrame:
    """The n calls of the species with most reads (WIN-08, SRT-06)."""
    total = F.sum("numreads").over(Window.partitionBy("species"))
    return calls.withColumn("species_reads", total).orderBy(F.desc("species_reads"), F.desc("numreads"), "species", "sample", "sacc").limit(n)


def best_call(calls: DataFrame) -> DataFrame:
    return calls.orderBy(F.desc("numreads"), "sacc").limit(1)


def pages(calls: DataFrame, per_page: int, order: Sequence[str]) -> DataFrame:
    """Page numbers for plots, numbered over a range partitioning (SRT-09)."""
    return numbered(calls, order).withColumn("page", F.floor(F.col("_number") / per_page) + 1).drop("_number")
