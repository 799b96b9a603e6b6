"""Driver queries over readers and sinks: files of the domain's formats are written from the driver tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as C
from .operators import expression
from .scratch import new_path, written
from .sources import readers, writers
from .streaming import stateful
from .views import HITS_SQL, SEQ_SQL, TREE_SQL, hits, sequences, table, taxon_nodes

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def _text(df, spark, name: str) -> str:
    """Writes the one string column of df as text files."""
    path = new_path(spark, name)
    df.write.text(path)
    return path


def _line(*columns):
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])


@query(f"WITH {HITS_SQL} SELECT CAST(qacc AS VARCHAR) AS qacc, 's' || sacc AS sacc, CAST(qstart AS INTEGER) AS qstart, CAST(qend AS INTEGER) AS qend, CAST(sstart AS INTEGER) AS sstart, CAST(send AS INTEGER) AS send, pident, bitscore, CAST(taxid + 7 AS BIGINT) AS taxid_sum, 't ' || sacc AS title FROM h")
def read_blast7(spark, sf):
    """Files of two header lines, each with its own order of fields."""
    h = hits(spark, sf).withColumn("sacc", F.concat(F.lit("s"), "sacc")).withColumn("ids", F.concat(F.col("taxid").cast("string"), F.lit(";7"))).withColumn("title", F.concat(F.lit("t "), F.substring("sacc", 2, 9)))
    fields = {"qacc": "query acc.", "sacc": "subject acc.", "qstart": "q. start", "qend": "q. end", "sstart": "s. start", "send": "s. end", "pident": "% identity", "bitscore": "bit score", "ids": "subject tax ids", "title": "subject title"}
    paths = []
    for k, names in enumerate((list(fields), list(reversed(fields)))):
        head = "\n".join(("# BLASTN 2.12.0+", "# Fields: " + ", ".join(fields[c] for c in names), "# 1 hits found"))
        rows = h.where(F.col("qacc") % 2 == k).select(F.concat(F.lit(head + "\n"), _line(*names)).alias("value"))  # a header above every line, as with one query each
        paths.append(_text(rows.coalesce(4), spark, "blast7"))
    out = readers.blast7(spark, paths)
    return out.select("qacc", "sacc", "qstart", "qend", "sstart", "send", "pident", "bitscore", F.aggregate("staxids", F.lit(0).cast("long"), lambda a, x: a + x).alias("taxid_sum"), F.col("stitle").alias("title"))


@query(f"WITH {HITS_SQL} SELECT CAST(qacc AS VARCHAR) AS qseqid, CAST(sacc AS VARCHAR) AS sseqid, pident, CAST(send - sstart AS INTEGER) AS length, CAST(qstart AS INTEGER) AS qstart, CAST(qend AS INTEGER) AS qend, CAST(sstart AS INTEGER) AS sstart, CAST(send AS INTEGER) AS send, bitscore FROM h")
def read_blast6(spark, sf):
    h = hits(spark, sf).select("qacc", "sacc", "pident", (F.col("send") - F.col("sstart")).alias("length"), F.lit(0).alias("mismatch"), F.lit(0).alias("gapopen"), "qstart", "qend", "sstart", "send", F.lit(0.5).alias("evalue"), "bitscore")
    out = readers.blast6(spark, _text(h.select(_line(*h.columns).alias("value")), spark, "blast6"))
    return out.select("qseqid", "sseqid", "pident", "length", "qstart", "qend", "sstart", "send", "bitscore")


@query(f"WITH {SEQ_SQL} SELECT 'd' || acc AS acc, 'of document ' || acc AS comment, md5(seq) AS seq, CAST(length(seq) AS INTEGER) AS bp FROM s")
def read_fasta(spark, sf):
    """Records with lines of 70 bases."""
    wrapped = F.regexp_replace("seq", r"(.{70})(?=.)", "$1\n")
    rows = sequences(spark, sf).select(F.concat(F.lit(">d"), F.col("acc"), F.lit(" of document "), F.col("acc"), F.lit("\n"), wrapped).alias("value"))
    out = readers.fasta(spark, _text(rows, spark, "fasta"))
    return out.select("acc", "comment", F.md5("seq").alias("seq"), F.length("seq").alias("bp"))


@query(f"WITH {SEQ_SQL}, r AS (SELECT 'd' || acc AS acc, seq, acc * 37 % 900 + 1 AS start, CASE WHEN acc % 10 > 0 THEN acc * 37 % 900 + acc % 300 END AS stop FROM s) SELECT acc, start, stop, substr(seq, start, greatest(0, coalesce(stop, length(seq)) - start + 1)) AS slice FROM r")
def fasta_random_access(spark, sf):
    """Slices of all records by an index of byte offsets; the rest of the files isn't read. A third of the records are one line."""
    s = sequences(spark, sf)
    wrapped = F.when(F.col("acc") % 3 == 0, F.col("seq")).otherwise(F.regexp_replace("seq", r"(.{70})(?=.)", "$1\n"))
    at = _text(s.select(F.concat(F.lit(">d"), F.col("acc"), F.lit(" über "), F.col("acc"), F.lit("\n"), wrapped).alias("value")), spark, "fasta")
    start = F.col("acc") * 37 % 900 + 1
    requests = s.select(F.concat(F.lit("d"), "acc").alias("acc"), start.alias("start"), F.when(F.col("acc") % 10 > 0, start - 1 + F.col("acc") % 300).alias("stop"))
    return readers.fasta_slices(requests, readers.fasta_index(spark, at))


@query(f"WITH {SEQ_SQL} SELECT 'd' || acc AS acc FROM s")
def read_fasta_accessions(spark, sf):
    rows = sequences(spark, sf).select(F.concat(F.lit(">d"), F.col("acc"), F.lit(" x\n"), F.col("seq")).alias("value"))
    return readers.fasta_accessions(spark, _text(rows, spark, "fasta"))


@query("SELECT 'r' || (p_partkey % 100) || CASE WHEN p_partkey >= 100 THEN '_' || (p_partkey // 100) ELSE '' END AS acc, md5(p_name) AS seq FROM part")
def write_fasta(spark, sf):
    """Repeated accessions numbered in order, gzip, a folder for each bin, read back."""
    rows = table(spark, sf, "part").select(F.concat(F.lit("r"), F.col("p_partkey") % 100).alias("acc"), F.col("p_partkey").alias("ord"), F.md5("p_name").alias("seq"), (F.col("p_partkey") % 3).alias("bin"))
    path = new_path(spark, "bins")
    writers.fasta(rows, path, partition_by="bin")
    return readers.fasta(spark, f"{path}/bin=*").select("acc", "seq")


@query("""SELECT l_suppkey || '_pilon' AS rname, CAST(sum(l_quantity) AS INTEGER) AS numreads, round(avg(l_discount), 6) AS coverage FROM lineitem GROUP BY l_suppkey""")
def read_coverage(spark, sf):
    n = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").cast("int").alias("n"), F.round(F.avg("l_discount"), 6).alias("c"))
    head = "#rname\tstartpos\tendpos\tnumreads\tcovbases\tcoverage\tmeandepth\tmeanbaseq\tmeanmapq"
    rows = n.select(_line(F.concat("l_suppkey", F.lit("_pilon")), F.lit("1"), F.lit("9"), "n", F.lit("0"), "c", F.lit("0"), F.lit("0"), F.lit("0")).alias(head))
    path = new_path(spark, "coverage")
    rows.write.option("quote", "").option("sep", "\x01").csv(path, header=True)
    out = readers.coverage(spark, path)
    return out.select(F.col("#rname").alias("rname"), "numreads", "coverage")


@query("SELECT CAST(p_partkey AS VARCHAR) AS acc, CAST(p_size AS INTEGER) AS len_all, CAST(p_size / 100.0 AS DOUBLE) AS entropy1, CAST(p_size % 7 / 8.0 AS DOUBLE) AS entropy4 FROM part")
def read_fasta_qc(spark, sf):
    """The k of the entropy columns come from the header."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("acc"), F.col("p_size").alias("len_all"), F.col("p_size").alias("len_used"), (F.col("p_size") / 100.0).alias("entropy1"), (F.col("p_size") % 7 / 8.0).alias("entropy4"), F.lit(0.1).alias("frac_hp"))
    path = new_path(spark, "qc")
    writers.csv(p, path)
    return readers.fasta_qc_table(spark, path).select("acc", "len_all", "entropy1", "entropy4")


@query(f"WITH {TREE_SQL} SELECT tax_id, parent_id, name, rank, (SELECT count(*) FROM supplier) AS merged FROM nodes")
def read_taxonomy(spark, sf):
    """Dump files with their delimiters, other names than scientific ones among them, and merged ids."""
    n, at = taxon_nodes(spark, sf), new_path(spark, "taxdump")
    row = lambda *c: F.concat(F.concat_ws("\t|\t", *c), F.lit("\t|")).alias("value")
    names = n.select(row(F.col("tax_id").cast("string"), "name", F.lit(""), F.lit("scientific name"))).union(n.select(row(F.col("tax_id").cast("string"), F.lit("other"), F.lit(""), F.lit("synonym"))))
    names.write.text(f"{at}/names.dmp")
    n.select(row(F.col("tax_id").cast("string"), F.col("parent_id").cast("string"), "rank", F.lit(""))).write.text(f"{at}/nodes.dmp")
    table(spark, sf, "supplier").select(row((F.col("s_suppkey") + 50_000).cast("string"), (F.col("s_suppkey") + 1000).cast("string"))).write.text(f"{at}/merged.dmp")
    nodes, merged = readers.taxonomy(spark, f"{at}/")
    return nodes.withColumn("merged", F.lit(merged.count()).cast("long"))


@query("""WITH p AS (SELECT p_partkey AS k, p_size AS n, p_name AS name FROM part)
  SELECT 'acc' || k AS acc, CAST(10 AS INTEGER) AS start, CAST(10 + n AS INTEGER) AS "end", 'gene' AS typ, 'gene' AS key, name AS value FROM p
  UNION ALL SELECT 'acc' || k, 20, 20 + n, 'CDS', key, value FROM (SELECT k, n, unnest(['product', 'pseudo']) AS key, unnest([name, '']) AS value FROM p)
  UNION ALL SELECT 'acc' || k, 500, 500 + n, 'CDS', key, value FROM (SELECT k, n, unnest(['product', 'pseudo', '_reversed']) AS key, unnest([name, '', '']) AS value FROM p)""")
def read_features(spark, sf):
    """Feature tables: partial ends, a second part in reverse, a key without value."""
    p = table(spark, sf, "part")
    n = F.col("p_size")
    text = F.concat_ws(
        "\n", F.concat(F.lit(">Feature ref|acc"), F.col("p_partkey"), F.lit(".1|")), F.concat(F.lit("<10\t"), n + 10, F.lit("\tgene")), F.concat(F.lit("\t\t\tgene\t"), "p_name"), F.concat(F.lit("20\t>"), n + 20, F.lit("\tCDS")),
        F.concat(n + 500, F.lit("\t500")), F.concat(F.lit("\t\t\tproduct\t"), "p_name"), F.lit("\t\t\tpseudo"),
    )
    return readers.feature_tables(spark, _text(p.select(text.alias("value")), spark, "features"))


@query("SELECT 'g' || p_partkey AS gene_id, p_brand AS gene_name, CAST(p_size AS INTEGER) AS start, CAST(p_size + 9 AS INTEGER) AS \"end\" FROM part")
def read_gtf(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select(_line(F.lit("chr1"), F.lit("src"), F.lit("gene"), "p_size", (F.col("p_size") + 9).cast("string"), F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('gene_id "g'), "p_partkey", F.lit('"; gene_name "'), "p_brand", F.lit('"; tag "a"; tag "b";'))).alias("value"))
    g = readers.gtf(spark, _text(rows, spark, "gtf"))
    return g.select(F.col("attributes")["gene_id"].alias("gene_id"), F.col("attributes")["gene_name"].alias("gene_name"), "start", "end")


@query("SELECT 'x' || p_partkey AS feature_id, p_retailprice AS counts, CAST(p_size AS DOUBLE) AS abundance, CAST(p_size + 100 AS DOUBLE) AS length FROM part")
def read_quant(spark, sf):
    q = table(spark, sf, "part").select(F.concat(F.lit("x"), "p_partkey").alias("Name"), (F.col("p_size") + 200).alias("Length"), (F.col("p_size") + 100).cast("double").alias("EffectiveLength"), F.col("p_size").cast("double").alias("TPM"), F.col("p_retailprice").alias("NumReads"))
    path = new_path(spark, "quant")
    q.write.csv(path, header=True, sep="\t")
    return readers.quant(spark, path).select("feature_id", "counts", "abundance", "length")


@query("SELECT 'x' || p_partkey AS feature_id, p_retailprice AS counts, CAST(p_size AS DOUBLE) AS abundance, CAST(p_size + 100 AS DOUBLE) AS length FROM part")
def read_gene_quant(spark, sf):
    """Gene level quantification."""
    p, n = table(spark, sf, "part"), F.col("p_size")
    q = p.select(F.concat(F.lit("x"), "p_partkey").alias("gene_id"), F.lit("t1,t2").alias("transcript_id(s)"), (n + 200).alias("length"), (n + 100).alias("effective_length"), F.col("p_retailprice").alias("expected_count"), n.alias("TPM"), n.alias("FPKM"))
    path = new_path(spark, "genes")
    q.write.csv(path, header=True, sep="\t")
    return readers.gene_quant(spark, path).select("feature_id", "counts", "abundance", "length")


@query("SELECT p_partkey AS feature_id, s AS sample, CAST(p_size * s AS DOUBLE) AS counts, CAST(p_size + 1 AS DOUBLE) AS length FROM part, (VALUES (1), (2)) v(s)")
def read_exon_counts(spark, sf):
    """Exon counts, a column for each sample, to long form."""
    n = F.col("p_size")
    x = table(spark, sf, "part").select(F.col("p_partkey").alias("feature_id"), F.lit("g").alias("gene_id"), F.lit("c").alias("chrom"), F.lit(10).alias("start"), (n + 10).alias("end"), F.lit("+").alias("strand"), n.alias("s1"), (n * 2).alias("s2"))
    path = new_path(spark, "exons")
    x.write.csv(path, header=True, sep="\t")
    out = readers.exon_counts(spark, path)
    return out.select(F.col("feature_id").cast("long").alias("feature_id"), F.substring("sample", 2, 1).cast("int").alias("sample"), "counts", "length")


@query(f"WITH {HITS_SQL} SELECT 'c' || sacc AS contig, CAST(lo AS INTEGER) AS pos, CAST(count(*) AS INTEGER) AS depth FROM h GROUP BY sacc, lo")
def read_depth(spark, sf):
    d = hits(spark, sf).groupBy(F.concat(F.lit("c"), "sacc").alias("contig"), F.least("sstart", "send").alias("pos")).agg(F.count("*").alias("depth"))
    return readers.depth(spark, _text(d.select(_line("contig", "pos", "depth").alias("value")), spark, "depth"))


@query("SELECT event_type AS stage, 'p' || (user_id % 7) AS project, 'st.ack' AS stack, 's' || (user_id % 50) AS sample, CAST(sum(value) AS DOUBLE) AS s FROM events GROUP BY 1, 2, 4")
def read_benchmarks(spark, sf):
    """Job benchmark files, `-` for null, with stage, project, stack and sample from the path."""
    e = table(spark, sf, "events").groupBy(F.col("event_type").alias("stage"), F.concat(F.lit("p"), F.col("user_id") % 7).alias("project"), F.concat(F.lit("s"), F.col("user_id") % 50).alias("sample")).agg(F.sum("value").alias("s"))
    head = "s\th:m:s\tmax_rss\tmax_vms\tmax_uss\tmax_pss\tio_in\tio_out\tmean_load\tcpu_time"
    path = new_path(spark, "benchmarks")
    rows = e.select(F.concat_ws("/", F.lit("benchmarks"), "stage", F.concat("project", F.lit(".st.ack")), F.concat("sample", F.lit(".txt"))).alias("at"), _line("s", *[F.lit("-")] * 8, F.lit("1.5")).alias("line"))
    # the path of a job's file stands in the table; the reader's own path column is that of Spark's part files
    rows.select(F.col("line").alias(head), "at").write.option("quote", "").option("sep", "\x01").partitionBy("at").csv(path, header=True)
    raw = readers.benchmarks(spark, path).withColumn("path", F.url_decode(F.url_decode(F.regexp_extract("path", r"at=([^/]*)/", 1))))
    return expression.job_table(raw, "path").select("stage", "project", "stack", "sample", "s")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag, o_orderstatus || ';' || o_orderpriority AS list FROM orders")
def write_csv(spark, sf):
    """Arrays joined, booleans in words, quoted text, read back as text."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 2 == 0).alias("flag"), F.array("o_orderstatus", "o_orderpriority").alias("list"))
    path = new_path(spark, "csv")
    writers.csv(o, path, python_booleans=True)
    return spark.read.csv(path, header=True)


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'kept' ELSE 'left' END AS side, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids, (SELECT count(*) FROM orders) AS n_in FROM orders GROUP BY 1")
def write_filtered(spark, sf):
    """Records kept and left by an id list, with counts."""
    o = table(spark, sf, "orders")
    records, ids = o.select(F.col("o_orderkey").alias("acc")), o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("acc"))
    out = None
    for side, keep in (("kept", True), ("left", False)):
        rows, counts = writers.filter_records(records, ids, keep=keep)
        one = rows.agg(F.sum("acc").alias("ids")).crossJoin(counts).select(F.lit(side).alias("side"), F.col("n_out").alias("n"), "ids", "n_in")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'v2:' || c_name END AS payload FROM customer")
def cache_round_trip(spark, sf):
    """Entries appended twice to a lookup table: the last one counts, missing keys are null."""
    c, path = table(spark, sf, "customer"), new_path(spark, "cache")
    for version in ("v1:", "v2:"):
        writers.cache_put(c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit(version), "c_name").alias("payload")), path, "names")
    keys = c.select("c_custkey", F.col("c_custkey").cast("string").alias("key"))
    return readers.cache_lookup(keys, spark.read.parquet(path), "names").select("c_custkey", "payload")


@query("SELECT n_name, 'sample_' || n_nationkey AS sample, 'u' || n_nationkey AS unit FROM nation")
def names_of_files(spark, sf):
    """Samples and units out of file names."""
    n = table(spark, sf, "nation").withColumn("f", F.concat(F.lit("sample_"), "n_nationkey", F.lit(".blast7.gz"))).withColumn("g", F.concat(F.lit("u"), "n_nationkey", F.lit(".coverage")))
    return n.select("n_name", C.sample_name(F.col("f"), "blast7").alias("sample"), C.before_last(F.col("g")).alias("unit"))


@query(f"""WITH {HITS_SQL}, l AS (SELECT sample, qacc, ord, sacc, CASE WHEN lag(sacc) OVER (PARTITION BY qacc ORDER BY ord) = sacc THEN 0 ELSE 1 END AS new FROM h)
  SELECT sample, qacc, ord, CAST(sum(new) OVER (PARTITION BY qacc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l""")
def streamed_islands(spark, sf):
    """Runs of equal subjects over a stream of files, the hits of a query coming in several of them."""
    h = written(hits(spark, sf).select("sample", "qacc", "ord", "sacc"))
    at = new_path(spark, "stream")
    for k, part in enumerate(("ord % 1000 <= 2", "ord % 1000 between 3 and 4", "ord % 1000 > 4")):
        h.where(part).write.parquet(f"{at}/in/batch={k}")
        stream = spark.readStream.schema(h.schema).parquet(f"{at}/in/batch=*")
        run = stateful.islands(stream).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{at}/state").format("parquet").start(f"{at}/out")  # goes on from the state of the run before
        run.awaitTermination()
    return spark.read.parquet(f"{at}/out").select("sample", "qacc", "ord", "island")
