"""Expression tables in long form, sample sheets, run-time benchmarks, cohort comparison."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import virus_and_strain
from ..scratch import written
from .ordering import before, join_groups, numbered


def collapse(df: DataFrame, keys: Sequence[str], sep: str = ";") -> DataFrame:
    """One row by key: a column's value where it is constant, else all values joined; and n (AGG-21)."""
    rest = [c for c in df.columns if c not in keys]
    one = lambda c: F.when(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))) <= 1, F.min(F.col(c).cast("string"))).otherwise(F.array_join(F.array_sort(F.collect_list(F.col(c).cast("string"))), sep))
    return df.groupBy(*keys).agg(*[one(c).alias(c) for c in rest], F.count("*").alias("n"))


def column_profile(df: DataFrame) -> dict[str, tuple[int, int]]:
    """(non-null, distinct) counts of all columns, in one pass."""
    row = df.agg(*[x for c in df.columns for x in (F.count(c).alias(f"n:{c}"), F.count_distinct(c).alias(f"d:{c}"))]).first()
    return {c: (row[f"n:{c}"], row[f"d:{c}"]) for c in df.columns}


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without columns that are null on all rows (PRJ-09)."""
    p = column_profile(df)
    return df.select(*[c for c in df.columns if p[c][0]])


def split_constant(df: DataFrame) -> tuple[dict[str, object], DataFrame]:
    """Columns that are constant over all rows, with their value, and the table of the others (AGG-42)."""
    p, n = column_profile(df), df.count()
    constant = [c for c in df.columns if p[c][1] <= 1 and p[c][0] in (0, n)]
    row = df.select(*constant).first() if constant and n else None
    return ({c: row[c] for c in constant} if row else {}), df.select(*[c for c in df.columns if c not in constant])


def assert_constant(df: DataFrame, columns: Sequence[str]) -> None:
    """Stops if a column that must be constant isn't (AGG-26)."""
    p = column_profile(df.select(*columns))
    bad = [c for c in columns if p[c][1] > 1]
    if bad:
        raise ValueError(f"columns differ between samples: {', '.join(bad)}")


def id_columns(df: DataFrame, ids: DataFrame) -> list[str]:
    """Columns that are unique and hold known ids only (PRJ-10)."""
    p, n = column_profile(df), df.count()
    known = ids.select(F.col(ids.columns[0]).cast("string").alias("_id"))
    unique = [c for c in df.columns if p[c] == (n, n)]
    return [c for c in unique if df.select(F.col(c).cast("string").alias("_id")).join(known, "_id", "left_anti").isEmpty()]


def unique_matches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once (FLT-15)."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n = 1").drop("_n")


def fastqc_columns(df: DataFrame) -> DataFrame:
    """Read length range, mate and counts of a FastQC table (PRJ-17)."""
    lengths = F.split(F.col("Sequence length").cast("string"), "-")
    low, high = F.get(lengths, 0).try_cast("int"), F.get(lengths, 1).try_cast("int")
    return df.select(
        F.regexp_replace("Sample", r"[._]R?[12]$", "").alias("id"), F.when(F.col("Sample").endswith("2"), "R2").otherwise("R1").alias("mate"), F.col("Total Sequences").cast("long").alias("reads"),
        low.alias("read_len_min"), F.coalesce(high, low).alias("read_len_max"), F.col("%GC").cast("double").alias("pct_gc"),
    )


def gene_summary(tx: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Transcripts to genes: counts and abundance summed, length weighted by abundance (AGG-22)."""
    rows = tx.join(tx2gene, "feature_id")
    length = F.when(F.sum("abundance") > 0, F.sum(F.col("length") * F.col("abundance")) / F.sum("abundance")).otherwise(F.avg("length"))
    return rows.groupBy("gene_id", "sample").agg(F.sum("counts").alias("counts"), F.sum("abundance").alias("abundance"), length.alias("length"))


# Biotypes of ribosomal genes.
RIBOSOMAL = ("rRNA", "rRNA_pseudogene")


def gene_class(name: Column, biotype: Column) -> Column:
    """mito (by name), ribo, noncoding or coding; a gene without a biotype counts as coding (FLT-21)."""
    return F.when(name.rlike("^MT-"), "mito").when(biotype.isin(*RIBOSOMAL), "ribo").when(biotype != "protein_coding", "noncoding").otherwise("coding")


def sample_qc(expr: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts and percentages by gene class, and expressed genes, of each sample, in one aggregation (AGG-23, AGG-24, JOI-19)."""
    rows = expr.join(genes.select("gene_id", gene_class(F.col("gene_name"), F.col("biotype")).alias("_class")), "gene_id", "left")
    part = lambda k: F.coalesce(F.sum(F.when(F.col("_class") == k, F.col("counts"))), F.lit(0.0))
    out = rows.groupBy("sample").agg(F.sum("counts").alias("total"), F.count_if(F.col("counts") > 0).alias("n_expressed"), *[part(k).alias(k) for k in ("mito", "ribo", "noncoding", "coding")])
    return out.select("*", *[F.when(F.col("total") > 0, F.round(F.col(k) / F.col("total") * 100, 2)).alias(f"pct_{k}") for k in ("mito", "ribo", "noncoding")])


def zero_fill(expr: DataFrame, failed: DataFrame) -> DataFrame:
    """expr with all features of failed samples at 0, lengths the mean of the others (AGG-25, RSH-06)."""
    features = expr.groupBy("feature_id").agg(F.avg("length").alias("length"))
    names = failed.agg(F.collect_set("sample")).scalar()
    fill = features.select("feature_id", F.explode(names).alias("sample"), F.lit(0.0).alias("counts"), F.lit(0.0).alias("abundance"), "length")
    return expr.select("feature_id", "sample", F.col("counts").cast("double").alias("counts"), F.col("abundance").cast("double").alias("abundance"), "length").unionByName(fill)


def failed_files(files: DataFrame, rows: DataFrame, path: str = "path") -> DataFrame:
    """Files of a list that gave no rows (FLT-19)."""
    return files.join(rows.select(path).distinct(), path, "left_anti")


def integer_counts(expr: DataFrame) -> DataFrame:
    return expr.withColumn("counts", F.bround("counts").cast("int"))


def to_long(df: DataFrame, ids: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Wide to long (RSH-01)."""
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in (columns or [c for c in df.columns if c not in ids])], name, value)


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """Long to wide (RSH-02); names given save the pass that finds them."""
    return df.groupBy(*ids).pivot(name, list(names) if names else None).agg(F.first(value))


def size_factors(expr: DataFrame) -> DataFrame:
    """Size factors from geometric means over positive counts (poscounts), scaled to geometric mean 1 (STA-01)."""
    n = expr.select("sample").distinct().count()
    gm = expr.groupBy("feature_id").agg(F.exp(F.sum(F.when(F.col("counts") > 0, F.log("counts")).otherwise(0.0)) / n).alias("_gm"), F.max("counts").alias("_top")).where("_top > 0")
    logs = expr.join(gm, "feature_id").where("counts > 0").select("sample", F.log(F.col("counts") / F.col("_gm")).alias("_log"))
    ratio = percentiles(logs, "_log", ["sample"], (0.5,), ("_m",)).select("sample", F.exp("_m").alias("sf"))
    return ratio.withColumn("sf", F.col("sf") / F.exp(F.avg(F.log("sf")).over(Window.partitionBy())))


#: Most samples of a matrix of all pairs (8 bytes each; 128 MB), and features that a task adds to its own at a time.
MOST_SAMPLES, FEATURES = 4000, 512


def sample_products(rows: DataFrame, samples: Sequence, *, sample: str = "sample", feature: str = "feature_id", value: str = "v") -> np.ndarray:
    """Samples x samples: sums over all features of the products of two samples' values, less the feature's mean; 0 where a value is missing.

    Features are dealt over tasks, each task adds block after block of features as a matrix product and puts out one
    matrix; these are added in a few tasks, then here. What is held depends on the number of samples only.
    """
    n = len(samples)
    if n > MOST_SAMPLES:
        raise ValueError(f"{n} samples; a matrix of all pairs holds {MOST_SAMPLES}")
    place = F.broadcast(rows.sparkSession.createDataFrame([(x, k) for k, x in enumerate(samples)], T.StructType([T.StructField(sample, rows.schema[sample].dataType), T.StructField("_at", T.IntegerType())])))

    def product(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, block, held, last = np.zeros((n, n)), np.zeros((FEATURES, n)), -1, None

        def add():
            own = block[: held + 1]
            own -= own.mean(axis=1, keepdims=True)
            total[:] += own.T @ own
            block[:] = 0

        for pdf in frames:
            names, ats, values = pdf["f"].to_numpy(), pdf["at"].to_numpy(), pdf["v"].to_numpy()
            new = np.concatenate([[held < 0 or names[0] != last], names[1:] != names[:-1]])
            cuts = [*np.flatnonzero(new), len(names)]
            if cuts[0] > 0:
                cuts.insert(0, 0)
            for a, b in zip(cuts, cuts[1:]):
                if new[a]:
                    if held + 1 == FEATURES:
                        add()
                        held = -1
                    held += 1
                np.add.at(block[held], ats[a:b], values[a:b])
            last = names[-1]
        if held >= 0:
            add()
        yield pd.DataFrame({"m": [total.tobytes()]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n * n)
        for pdf in frames:
            for m in pdf["m"]:
                total += np.frombuffer(m)
        yield pd.DataFrame({"m": [total.tobytes()]})

    dealt = rows.join(place, sample).select(F.col(feature).alias("f"), F.col("_at").alias("at"), F.col(value).cast("double").alias("v")).repartition("f").sortWithinPartitions("f")
    parts = dealt.mapInPandas(product, "m binary").repartition(4).mapInPandas(added, "m binary").collect()  # four matrices
    return sum((np.frombuffer(r["m"]) for r in parts), np.zeros(n * n)).reshape(n, n)


def log_components(expr: DataFrame) -> tuple[list, np.ndarray, np.ndarray]:
    """(samples in order, coordinates by sample and component, variances of the components) of log2(counts / size factor + 1), centred by feature (STA-01)."""
    rows = expr.join(size_factors(expr), "sample").select("sample", "feature_id", F.log2(F.col("counts") / F.col("sf") + 1).alias("v"))
    samples = [r[0] for r in expr.select("sample").distinct().orderBy("sample").limit(MOST_SAMPLES + 1).collect()]
    values, vectors = np.linalg.eigh(sample_products(rows, samples))
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    return samples, vectors * np.sqrt(values), values / max(1, len(samples) - 1)


def log_pca(expr: DataFrame, k: int = 2) -> DataFrame:
    """`sample, pca`: the first k components of each sample, whose signs are free; a stand-in for the exact variance-stabilising transform."""
    samples, at, _ = log_components(expr)
    kind = T.StructType([T.StructField("sample", expr.schema["sample"].dataType), T.StructField("pca", T.ArrayType(T.DoubleType()))])
    return expr.sparkSession.createDataFrame([(s, [float(x) for x in row[:k]]) for s, row in zip(samples, at)], kind)


def regression(df: DataFrame, keys: Sequence[str], y: str, x: str) -> DataFrame:
    """Correlation, slope and intercept by key (STA-02)."""
    return df.groupBy(*keys).agg(F.corr(y, x).alias("r"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("n"))


def percentiles(df: DataFrame, value: str, keys: Sequence[str] = (), points: Sequence[float] = (0.5,), names: Sequence[str] = ("median",)) -> DataFrame:
    """`keys` and a column for each point: inclusive percentiles of the values that aren't null, interpolated.

    Selection over a global order: distinct values are counted map-side and range-partitioned by key and value, running
    counts tell which of them hold the two ranks around each point, and only these values are aggregated. So the values
    of one key are spread over many tasks.
    """
    own = df.where(F.col(value).isNotNull())
    counts = own.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    placed = before(counts, list(keys), ["_v"], sums={"_before": "_n"})
    rows = join_groups(placed, own.groupBy(*keys).agg(F.count("*").alias("_all")), list(keys), "_all")
    picks = []
    for k, p in enumerate(points):
        at = (F.col("_all") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col("_v"))).alias(f"_{side}{k}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_f{k}"))
    out = rows.groupBy(*keys).agg(*picks)
    return out.select(*keys, *[(F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * F.col(f"_f{k}")).alias(n) for k, n in enumerate(names)])


def percentile_stats(df: DataFrame, value: str, keys: Sequence[str] = (), points=(0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """Mean, minimum, maximum and inclusive percentiles (AGG-34; true extremes, Q11)."""
    names = [f"p{int(round(p * 100)):02d}" for p in points]
    base = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    at = percentiles(df, value, keys, points, names)
    if not keys:
        return base.join(F.broadcast(at), how="left").select("mean", "min", "max", *names)  # a row each
    right = at.toDF(*[f"_k{i}" for i in range(len(keys))], *names)
    return base.join(right, [base[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)], "left").select(*keys, "mean", "min", "max", *names)


# ---- run-time benchmarks of jobs


def job_table(raw: DataFrame, path: str = "path") -> DataFrame:
    """Job rows with stage, project, stack and sample taken from `benchmarks/<stage>/<project>.<stack>/<sample>[.part].txt` (SRC-21, PRJ-07)."""
    parts = F.split(F.regexp_extract(path, r"benchmarks/(.*)$", 1), "/", 3)
    stack = F.split(F.get(parts, 1), r"\.", 2)
    name = F.split(F.regexp_replace(F.get(parts, 2), r"\.txt$", ""), r"\.", 2)
    out = raw.withColumn("stage", F.get(parts, 0)).withColumn("project", F.get(stack, 0)).withColumn("stack", F.get(stack, 1)).withColumn("sample", F.get(name, 0)).withColumn("part", F.get(name, 1))
    return out.where("sample <> 'ALL' or sample is null")


def core_hours(jobs: DataFrame, threads: dict[str, int], *, keys=("stage", "stack", "sample"), more_than: int | None = None) -> DataFrame:
    """Seconds, CPU seconds, core hours (two hyper-threads a core) and CPU efficiency by job (AGG-35, STA-05, JOI-23).

    Stages that the map of threads lacks get -1 thread. more_than leaves jobs of more threads only (FLT-22).
    """
    spark = jobs.sparkSession
    t = F.broadcast(spark.createDataFrame([(k, int(v)) for k, v in threads.items()], "stage string, threads int"))
    rows = jobs.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("cpu_time").alias("cpu_time")).join(t, "stage", "left").withColumn("threads", F.coalesce("threads", F.lit(-1)))
    rows = rows if more_than is None else rows.where(F.col("threads") > more_than)
    return rows.withColumn("core_hours", F.col("s") * F.col("threads") / 3600 / 2).withColumn("efficiency", F.col("cpu_time") / (F.col("s") * F.col("threads")))


def share_of_total(df: DataFrame, value: str, within: Sequence[str] = (), name: str = "share") -> DataFrame:
    """value over its sum within a key (WIN-12)."""
    totals = df.groupBy(*within).agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
    return join_groups(df, totals, list(within), "_rows").withColumn(name, F.col(value) / F.col("_sum")).drop("_sum", "_rows")


def average_rank(df: DataFrame, value: str, within: Sequence[str], name: str = "rank") -> DataFrame:
    """Ranks with ties at their mean (WIN-11); null has none. Distinct values are counted and ranked in a global order, as for percentiles."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*within, value).agg(F.count("*").alias("_n"))
    ranks = before(counts, list(within), [value], sums={"_before": "_n"}).withColumn(name, F.col("_before") + (F.col("_n") + 1) / 2)
    return join_groups(df, written(ranks.drop("_before")), [*within, value], "_n", "left").drop("_n")


def fill_down(df: DataFrame, columns: Sequence[str], within: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Nulls replaced by the last value before (WIN-09)."""
    out = before(df, list(within), list(order), lasts={f"_last_{c}": c for c in columns})
    return out.withColumns({c: F.coalesce(c, f"_last_{c}") for c in columns}).drop(*[f"_last_{c}" for c in columns])


# ---- cohorts


def stack_studies(tables: dict[str, DataFrame], name: str = "study") -> DataFrame:
    """Tables of several studies, row-bound with the study's name (SET-01, SRC-13)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(name, F.lit(k)) for k, df in tables.items()])


def presence(tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys of all tables with a `have_` flag for each, by full outer joins (JOI-16)."""
    parts = [df.select(*keys).distinct().withColumn(f"have_{k}", F.lit(True)) for k, df in tables.items()]
    out = reduce(lambda a, b: a.join(b, list(keys), "full_outer"), parts)
    return out.fillna(False, [f"have_{k}" for k in tables])


def infection_rates(calls: DataFrame, samples: DataFrame, *, study: str = "study", virus: str = "virus") -> DataFrame:
    """Infected samples, rate of all samples, and prevalence among infected ones, by study and virus (AGG-37)."""
    total = samples.groupBy(study).agg(F.countDistinct("sample").alias("n_samples"))
    hit = calls.groupBy(study, virus).agg(F.countDistinct("sample").alias("n"))
    any_ = calls.groupBy(study).agg(F.countDistinct("sample").alias("n_infected"))
    return hit.join(total, study).join(any_, study).withColumn("rate", F.col("n") / F.col("n_samples")).withColumn("prevalence", F.col("n") / F.col("n_infected"))


def calls_of_samples(metadata: DataFrame, calls: DataFrame) -> DataFrame:
    """Metadata of all units with their virus calls, if any, and the calls' short names (JOI-17, PRJ-18)."""
    virus, strain = virus_and_strain(F.col("taxname"))
    return metadata.join(calls, ["study", "sample", "unit"], "left").withColumn("virus", virus).withColumn("strain", strain)


def with_run_meta(coldata: DataFrame, meta: DataFrame) -> DataFrame:
    """Sample table with the scalars of each sample's quantification run (JOI-18)."""
    return coldata.join(meta, "sample", "left")


def with_fastq_paths(fastqc: DataFrame, paths: DataFrame) -> DataFrame:
    """FastQC rows with the path of their file, by id and mate (JOI-20)."""
    return fastqc.join(paths.select("id", "mate", "path"), ["id", "mate"], "left")


def rpkm(reads: Column, length: Column, total: Column) -> Column:
    return reads * 1e9 / (length * total)


def viral_loads(calls: DataFrame, *, keys: Sequence[str] = ("study", "sample")) -> DataFrame:
    """Loads of infected samples: viruses, reads in all, without host and viral, shares in percent, reads by genome, and reads by
    kilobase and million of all reads and of those without host."""
    names = F.array_join(F.array_sort(F.collect_set("virus")), "+").alias("virus")
    sums = [F.sum("raw_reads").alias("total"), F.sum("filtered_reads").alias("nonhuman"), F.max("genome_length").alias("genome"), F.sum("numreads").alias("viral")]
    out = calls.where(F.col("virus").isNotNull()).groupBy(*keys).agg(names, *sums)
    viral, total, nonhuman, genome = (F.col(c) for c in ("viral", "total", "nonhuman", "genome"))
    return out.withColumns({
        "pct_viral": viral / total * 100, "pct_viral_nonhuman": viral / nonhuman * 100, "viral_per_genome": viral / genome * 100,
        "rpkm_all": rpkm(viral, genome, total), "rpkm_nonhuman": rpkm(viral, genome, nonhuman),
    })


def bind_columns(a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str]) -> DataFrame:
    """Columns side by side, by position in a stated order (JOI-21)."""
    return numbered(a, order_a, "_row").join(numbered(b, order_b, "_row"), "_row").drop("_row")
