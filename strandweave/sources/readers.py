"""Readers. All read what Spark's readers can open; gzip is read natively, and an empty file is an empty relation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import before_last, head_tail, sample_name, tax_ids
from ..functions.tables import features_of_records
from ..operators.ordering import before
from ..schemas import BLAST6, COVERAGE, DEPTH, FIELD_NAMES, FIELD_TYPES, VHDB, fasta_qc
from ..scratch import written


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """`value, path, file, pos`: lines with their place in the file.

    A file that is split is read in blocks: the block's first byte in the upper bits, the row within the task in the lower 27, which
    hold for blocks of up to 128 MB and files of up to 64 GB; files that aren't split (gzip) have no such bounds.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the upper bits number partitions
    pos = F.shiftleft(F.col("_metadata.file_block_start").cast("long"), 27) + row
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), pos.alias("pos"))


#: Most files whose rows of fields may be broadcast (under 1 kB each).
BROADCAST_FILES = 50_000


def blast7(spark: SparkSession, paths: str | Sequence[str], *, suffix: str = "blast7", checked: bool = True) -> DataFrame:
    """Tabular alignments that describe themselves: columns as in `# Fields:`, long names shortened, unknown ones kept (SRC-01).

    Fields may differ between files. A first pass makes one row for each file, its first line and its fields; the distinct
    fields, a few, and up to five names of files whose first line doesn't name the tool, which is an error, come to the driver.
    The plan returned scans the files once: lines find their file's fields by a broadcast of those rows, where there are
    several kinds of fields at all, and are not shuffled.
    """
    lines = _lines(spark, paths)
    fields = F.min(F.when(F.col("value").startswith("# Fields: "), F.expr("substring(value, 11)")))
    head = written(lines.groupBy("path").agg(F.min_by("value", "pos").alias("first"), fields.alias("fields")))
    if checked:
        bad = [r["path"] for r in head.where(~F.col("first").contains("BLAST")).limit(5).collect()]
        if bad:
            raise ValueError(f"not alignment files by their first line: {', '.join(bad)}")
    kinds = [r["fields"] for r in head.select("fields").where("fields is not null").distinct().orderBy("fields").collect()]
    data = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    if len(kinds) == 1:
        data = data.withColumn("fields", F.lit(kinds[0]))
    else:
        head = head.drop("first")
        data = data.join(F.broadcast(head) if head.count() <= BROADCAST_FILES else head, "path")
    if not kinds:
        return spark.createDataFrame([], "sample string, ord long, qacc string, sacc string")
    parts, found = F.split("value", "\t"), {}
    for fields in kinds:
        for k, text in enumerate(fields.split(",")):
            n = FIELD_NAMES.get(text.strip(), text.strip())
            one = F.get(parts, k).try_cast(FIELD_TYPES[n]) if n in FIELD_TYPES else tax_ids(F.get(parts, k)) if n == "staxids" else F.get(parts, k)
            found.setdefault(n, []).append(F.when(F.col("fields") == fields, one))
    return data.select(sample_name(F.col("file"), suffix).alias("sample"), F.col("pos").alias("ord"), *[F.coalesce(*cols).alias(n) for n, cols in found.items()])


def is_blast7(spark: SparkSession, path: str) -> bool:
    """Whether the first line names the tool (an empty file does not)."""
    first = spark.read.text(path).limit(1).collect()
    return bool(first) and "BLAST" in first[0][0]


def blast6(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Twelve fixed columns, with sample and ord (SRC-02)."""
    raw = spark.read.csv(paths, sep="\t", schema=BLAST6)
    return raw.select(sample_name(F.col("_metadata.file_name"), "blast6").alias("sample"), F.monotonically_increasing_id().alias("ord"), *BLAST6.names)


def fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """`file, ord, acc, comment, seq`: records, lines joined; an accession's last record wins (SRC-04)."""
    raw = spark.read.option("lineSep", "\n>").text(paths)
    rec = F.regexp_replace("value", "^>", "")
    head, seq = F.regexp_extract(rec, r"^([^\n]*)", 1), F.regexp_replace(F.regexp_replace(rec, r"^[^\n]*\n?", ""), r"\s+", "")
    acc, comment = head_tail(head)
    rows = raw.where("trim(value) <> ''").select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("ord"), acc.alias("acc"), comment.alias("comment"), seq.alias("seq"))
    bad = F.when(F.col("acc") == "", F.raise_error(F.lit("FASTA record without a name"))).otherwise(F.col("acc"))
    last = Window.partitionBy("file", "acc").orderBy(F.desc("ord"))
    return rows.withColumn("acc", bad).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def fasta_accessions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Accessions only (SRC-05)."""
    return spark.read.text(paths).where(F.col("value").startswith(">")).select(head_tail(F.expr("substring(value, 2)"))[0].alias("acc"))


def fasta_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """`path, acc, length, offset, line_bases, line_bytes, n_bytes`: where each record's bases are in its uncompressed file (SRC-06).

    Records have the offset that the bytes of those before them add up to, in the order of a file, so only a row for a
    record is moved. line_bases is null where lines aren't of one length but the last; such a record is read whole. Lines
    end in a newline alone. An accession's last record wins.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    pos = F.shiftleft(F.col("_metadata.file_block_start").cast("long"), 27) + row
    raw = spark.read.option("lineSep", "\n>").text(paths).select(F.col("_metadata.file_path").alias("path"), pos.alias("pos"), F.regexp_replace("value", "^>", "").alias("rec"))
    head = F.regexp_extract("rec", r"^([^\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("rec", r"^[^\n]*\n?", ""), r"\n+$", "")
    rows = raw.select("path", "pos", F.octet_length("rec").cast("long").alias("_all"), F.octet_length(head).cast("long").alias("_head"), head_tail(head)[0].alias("acc"), body.alias("body"))
    first, bases = F.length(F.substring_index("body", "\n", 1)), F.length(F.regexp_replace("body", r"\s", ""))
    rows = rows.select("path", "pos", "acc", "_head", (F.col("_all") + 2).alias("_step"), F.octet_length("body").cast("long").alias("n_bytes"), bases.cast("long").alias("length"), first.cast("long").alias("_width"))
    even = F.col("n_bytes") == F.col("length") + F.ceil(F.col("length") / F.greatest(F.col("_width"), F.lit(1))) - 1
    placed = before(rows, ["path"], ["pos"], sums={"_before": "_step"}).withColumn("line_bases", F.when(even & (F.col("_width") > 0), F.col("_width")))
    offset = F.col("_before") + F.col("_head") + 2  # ">" and the newline after the header
    last = Window.partitionBy("path", "acc").orderBy(F.desc("pos"))
    placed = placed.where("acc <> ''").withColumn("_r", F.row_number().over(last)).where("_r = 1")
    return placed.select("path", "acc", "length", offset.alias("offset"), "line_bases", (F.col("line_bases") + 1).alias("line_bytes"), "n_bytes")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., path, from, to, skip, take) to (..., slice): reads bytes from to to, drops line ends, then cuts."""
    path, file = None, None
    for batch in batches:
        out = []
        for p, a, b, skip, take in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns - 5, batch.num_columns)]):
            if p != path:
                fs, at = pafs.FileSystem.from_uri(p)
                path, file = p, fs.open_input_file(at)
            text = b"".join(file.read_at(b - a, a).split()).decode() if b > a else ""
            out.append(text[skip : skip + take])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-5], pa.array(out, pa.string())], [*batch.schema.names[:-5], "slice"])


def fasta_slices(requests: DataFrame, index: DataFrame) -> DataFrame:
    """requests `acc, start, stop` (1-based, closed; null stop: to the end) with `slice`, read from the indexed files by byte ranges.

    Tasks read the ranges asked for and nothing else, those of a file one after the other. The files must be where pyarrow's
    file systems reach them (local or mounted folders, HDFS, object stores). Unknown accessions fall out; what lies beyond
    the end is left out.
    """
    lo = F.greatest(F.col("start"), F.lit(1)).cast("long") - 1
    hi = F.least(F.coalesce(F.col("stop").cast("long"), F.col("length")), F.col("length"))
    at = lambda x: F.col("offset") + F.floor(x / F.col("line_bases")) * F.col("line_bytes") + x % F.col("line_bases")
    even = F.col("line_bases").isNotNull()
    rows = requests.join(index, "acc").withColumns({"_lo": lo, "_hi": hi})
    some = F.col("_hi") > F.col("_lo")
    rows = rows.select(
        *requests.columns, "path", F.when(~some, 0).when(even, at(F.col("_lo"))).otherwise(F.col("offset")).cast("long").alias("_from"), F.when(~some, 0).when(even, at(F.col("_hi") - 1) + 1).otherwise(F.col("offset") + F.col("n_bytes")).cast("long").alias("_to"),
        F.when(even, 0).otherwise(F.col("_lo")).cast("long").alias("_skip"), F.greatest(F.col("_hi") - F.col("_lo"), F.lit(0)).cast("long").alias("_take"),
    )
    rows = rows.repartitionByRange("path", "_from").sortWithinPartitions("path", "_from")
    return rows.mapInArrow(_slices, T.StructType([*rows.schema.fields[: len(requests.columns)], T.StructField("slice", T.StringType())]))


def coverage(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Coverage tables with `unit`, the file name up to its last dot (SRC-07)."""
    raw = spark.read.csv(paths, sep="\t", header=True, schema=COVERAGE)
    return raw.withColumn("unit", before_last(F.col("_metadata.file_name")))


def fasta_qc_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Quality tables; the k of entropy columns come from the header (SRC-08)."""
    head = spark.read.text(paths).limit(1).collect()
    ks = [int(c[7:]) for c in (head[0][0].split(",") if head else []) if c.startswith("entropy")]
    return spark.read.csv(paths, header=True, schema=fasta_qc(ks))


def _dump(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    raw = spark.read.text(path)
    parts = F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t")
    return raw.select(*[F.trim(F.get(parts, k)).alias(n) for k, n in enumerate(names)])


def taxonomy(spark: SparkSession, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(nodes `tax_id, parent_id, name, rank`, merged `old_id, new_id`) of a dump; prefix is a folder with `/` or a name prefix (SRC-09, SRC-10)."""
    names = _dump(spark, f"{prefix}names.dmp", ("tax_id", "name", "unique_name", "name_class")).where("name_class = 'scientific name'")
    nodes = _dump(spark, f"{prefix}nodes.dmp", ("tax_id", "parent_id", "rank"))
    merged = _dump(spark, f"{prefix}merged.dmp", ("old_id", "new_id"))
    long = lambda *cols: [F.col(c).cast("long").alias(c) for c in cols]
    named = nodes.select(*long("tax_id", "parent_id"), "rank").join(names.select(*long("tax_id"), "name"), "tax_id")
    return named.select("tax_id", "parent_id", "name", "rank"), merged.select(*long("old_id", "new_id"))


def host_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=VHDB)


def path_list(spark: SparkSession, path: str, *, must_exist: bool = False) -> list[str]:
    """Paths of a list file, one a line; with must_exist a missing one is Spark's error that names it (SRC-12)."""
    paths = [r[0].strip() for r in spark.read.text(path).collect() if r[0].strip()]
    if must_exist and paths:
        spark.read.format("binaryFile").load(paths).limit(0).collect()
    return paths


def many_csv(spark: SparkSession, paths: Sequence[str], *, unit: str = r"([^/]+)\.[^/]*$", sep: str = ",", schema: T.StructType | None = None) -> DataFrame:
    """Row-bound tables with `unit` taken from each path by a regex (SRC-13)."""
    reader = spark.read.option("header", True).option("sep", sep)
    raw = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(list(paths))
    return raw.withColumn("unit", F.regexp_extract(F.col("_metadata.file_path"), unit, 1))


def calls_bundle(spark: SparkSession, calls_path: str, *, min_slen: int = 0, min_reads: int = 0) -> dict[str, DataFrame]:
    """calls, hits and features by file name (`x.calls.csv`, `x.hits.csv`, `x.features.csv`), thresholds applied to all (SRC-15)."""
    read = lambda kind: spark.read.csv(calls_path.replace(".calls.", f".{kind}."), header=True, inferSchema=True)
    calls = read("calls").where(F.col("slen") >= min_slen)
    if "numreads" in calls.columns:
        calls = calls.where(F.col("numreads") >= min_reads)
    return {"calls": calls, "hits": read("hits").join(calls.select("sacc").distinct(), "sacc", "left_semi"), "features": read("features").join(calls.select(F.col("sacc").alias("acc")).distinct(), "acc", "left_semi")}


def depth(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.csv(paths, sep="\t", schema=DEPTH)


def gtf(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features of a GTF with their attributes as a map (SRC-17)."""
    cols = "chrom string, source string, type string, start int, end int, score string, strand string, frame string, attributes string"
    raw = spark.read.csv(paths, sep="\t", comment="#", schema=cols, quote="")
    pairs = F.regexp_extract_all("attributes", F.lit(r'(\w+ "[^"]*")'), F.lit(1))
    entries = F.transform(pairs, lambda p: F.struct(F.substring_index(p, " ", 1).alias("k"), F.regexp_extract(p, r'"([^"]*)"', 1).alias("v")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["k"]), e["k"]) == i + 1)
    return raw.withColumn("attributes", F.map_from_entries(first))


def quant(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Transcript quantification, `sample` from the folder (SRC-17)."""
    raw = spark.read.csv(paths, sep="\t", header=True, schema="Name string, Length int, EffectiveLength double, TPM double, NumReads double")
    return raw.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("sample"), F.col("Name").alias("feature_id"), F.col("NumReads").alias("counts"), F.col("TPM").alias("abundance"), F.col("EffectiveLength").alias("length"))


def gene_quant(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Gene level quantification, `sample` from the file name (SRC-17)."""
    cols = "gene_id string, `transcript_id(s)` string, length double, effective_length double, expected_count double, TPM double, FPKM double"
    raw = spark.read.csv(paths, sep="\t", header=True, schema=cols)
    return raw.select(sample_name(F.col("_metadata.file_name"), r"genes\.results").alias("sample"), F.col("gene_id").alias("feature_id"), F.col("expected_count").alias("counts"), F.col("TPM").alias("abundance"), F.col("effective_length").alias("length"))


def exon_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Exon counts as tables of parts and samples, to long form; a part's length from its ends (SRC-17)."""
    raw = spark.read.csv(paths, sep="\t", header=True, inferSchema=True)
    fixed = ["feature_id", "gene_id", "chrom", "start", "end", "strand"]
    long = raw.unpivot(fixed, [c for c in raw.columns if c not in fixed], "sample", "counts")
    return long.select("sample", "feature_id", "gene_id", F.col("counts").cast("double").alias("counts"), (F.col("end") - F.col("start") + 1).cast("double").alias("length"))


def run_meta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scalars of quantification runs' JSON (SCL-27)."""
    raw = spark.read.json(paths, multiLine=True)
    scalar = [f.name for f in raw.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType))]
    return raw.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3).alias("sample"), *scalar)


def whitelist(spark: SparkSession, path: str) -> list[str]:
    """Patterns, one a line (SRC-18)."""
    return path_list(spark, path)


def read_counts(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    """`path, n` of log lines that a pattern with one group matches (SRC-22)."""
    raw = spark.read.text(paths).where(F.col("value").rlike(pattern))
    return raw.select(F.col("_metadata.file_path").alias("path"), F.regexp_extract("value", pattern, 1).cast("long").alias("n"))


def benchmarks(spark: SparkSession, root: str) -> DataFrame:
    """Job benchmark files below a folder, `-` as null, with `path` (SRC-21)."""
    cols = "s double, hms string, max_rss double, max_vms double, max_uss double, max_pss double, io_in double, io_out double, mean_load double, cpu_time double"
    raw = spark.read.option("recursiveFileLookup", True).csv(root, sep="\t", header=True, nullValue="-", schema=cols)
    return raw.withColumn("path", F.col("_metadata.file_path"))


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sheet with any columns; missing fields at a row's end are null."""
    return spark.read.csv(path, header=True, inferSchema=True, mode="PERMISSIVE")


def feature_tables(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Feature tables as `acc, start, end, typ, key, value` (SRC-20).

    Files are split at their headers, so that an accession's table is one row, wherever it stands: no order of lines, no shuffle.
    """
    records = spark.read.option("lineSep", "\n>Feature ").text(paths).where(F.trim("value") != "")
    return features_of_records(records)


def parse_features(lines: DataFrame) -> DataFrame:
    """Feature table lines `file, pos, value` to rows, by running counts and forward fills within a file.

    `>Feature x|acc.1|` starts an accession (version dropped), `start end type` a feature, `start end` another part of
    it, and `key value` an annotation of all its parts. `<`, `>` and `^` are dropped; reversed parts are swapped and
    get `_reversed`; a key without value has "". A feature without annotation has one row with null key.
    """
    order = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    fill = lambda c: F.last(c, ignorenulls=True).over(order)
    f = F.split("value", "\t")
    head = F.regexp_extract("value", r"^>Feature\s+(?:[^|]*\|)?([^|\s]+)\|?", 1)
    number = lambda k: F.regexp_replace(F.coalesce(F.get(f, k), F.lit("")), r"[<>^]", "").try_cast("int")
    rows = lines.select(
        "file", "pos", F.when(head != "", F.regexp_replace(head, r"\.\d+$", "")).alias("h"), number(0).alias("a"), number(1).alias("b"),
        F.when(number(0).isNotNull() & (F.coalesce(F.get(f, 2), F.lit("")) != ""), F.get(f, 2)).alias("t"), F.nullif(F.get(f, 3), F.lit("")).alias("key"), F.coalesce(F.get(f, 4), F.lit("")).alias("value"),
    )
    rows = rows.select("*", fill("h").alias("acc"), F.sum(F.when(F.col("t").isNotNull() | F.col("h").isNotNull(), 1).otherwise(0)).over(order).alias("feature"), fill("t").alias("typ"))
    parts = rows.where("a is not null and b is not null").select("file", "acc", "feature", "typ", F.least("a", "b").alias("start"), F.greatest("a", "b").alias("end"), (F.col("a") > F.col("b")).alias("rev"))
    notes = rows.where("key is not null").select("file", "feature", "key", "value")
    both = parts.join(notes, ["file", "feature"], "left")
    flipped = parts.where("rev").select("acc", "start", "end", "typ", F.lit("_reversed").alias("key"), F.lit("").alias("value"))
    return both.select("acc", "start", "end", "typ", "key", "value").unionByName(flipped)


def select_features(features: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of `typ/key` selectors, `*` for any (FLT-20)."""
    ok = F.lit(False)
    for field in fields:
        typ, _, key = field.partition("/")
        ok |= (F.lit(typ == "*") | (F.col("typ") == typ)) & (F.lit(key in ("*", "")) | (F.col("key") == key))
    return features.where(ok)


def cache_lookup(keys: DataFrame, cache: DataFrame, name: str) -> DataFrame:
    """keys with the cached payload of a cache, null where there is none; the last entry counts (SRC-23)."""
    own = cache.where(F.col("cache") == name).groupBy("key").agg(F.max_by("payload", "written").alias("payload"))
    return keys.join(own, "key", "left")


# The ladder of genome size sources, best first.
SIZE_SOURCES = ("size_check", "refseq_complete", "refseq", "complete", "any")


def genome_sizes(taxa: DataFrame, sizes: DataFrame) -> DataFrame:
    """taxa with genome_size_source and genome_size from a table `taxid, source, size`: best source first, else (failed, 0) (API-05)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SIZE_SOURCES]), F.col("source"))
    best = sizes.where((rank > 0) & (F.col("size") > 0)).groupBy("taxid", "source").agg(F.floor(F.avg("size")).alias("size"))
    best = best.groupBy("taxid").agg(F.min_by(F.struct("source", "size"), rank).alias("s"))
    return taxa.join(best, "taxid", "left").withColumn("genome_size_source", F.coalesce("s.source", F.lit("failed"))).withColumn("genome_size", F.coalesce(F.col("s.size"), F.lit(0)).cast("double")).drop("s")
