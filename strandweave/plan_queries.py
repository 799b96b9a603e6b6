"""Driver queries over whole commands: the report, exported scaffolds, bins, bundles of results, loads of studies, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import expression as E, report as R
from .plans import commands
from .scratch import new_path
from .sources import readers, writers
from .views import TREE_SQL, table, taxon_nodes

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# ---- the report

_CALLS = """c AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS sample, 'NC' || o_orderkey AS sacc, 'Sp ' || o_orderkey % 31 AS species, o_orderkey % 60 AS taxid,
    CASE o_orderkey % 6 WHEN 0 THEN 'Human rhinovirus A' WHEN 1 THEN 'Influenza B virus' ELSE 'Torque virus ' || o_orderkey % 31 END AS taxname,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Bacteria; B; x' ELSE 'Viruses; F' || o_orderkey % 7 || '; Sp ' || o_orderkey % 31 END AS lineage,
    CAST(o_orderkey % 101 AS DOUBLE) AS contig_coverage, 60 + o_orderkey % 400 / 10.0::DOUBLE AS pident, o_orderkey % 9 * 1000 AS genome_size, o_orderkey % 13 + o_orderkey % 3 AS numreads,
    CAST(floor(o_totalprice / 100) + floor(o_totalprice / 1000) AS DOUBLE) AS bp, round(o_orderkey % 30 / 200.0::DOUBLE * 100, 1) AS pcthp FROM orders),
  k AS (SELECT * FROM c WHERE coalesce(bp >= 200 AND bp * contig_coverage / 100 >= 150 AND numreads >= 3 AND pident >= 70 AND pcthp <= 12, false)),
  v AS (SELECT *, regexp_matches(lower(taxname), 'rhinovirus|coronavirus|influenza|metapneumovirus|enterovirus|orthopneumovirus|parainfluenza|respirovirus|rubulavirus|respiratory|bocavirus|adenovirus') AS respiratory FROM k WHERE starts_with(lineage, 'Viruses;'))"""


def _report(spark, sf):
    """All sheets, from calls, coverage by fragment, scaffold segments (one of them in two rows), quality and hosts."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    k, sample = F.col("o_orderkey"), (F.col("o_custkey") % 50).cast("string")
    key = [sample.alias("sample"), F.concat(F.lit("NC"), k).alias("sacc")]
    taxname = F.when(k % 6 == 0, "Human rhinovirus A").when(k % 6 == 1, "Influenza B virus").otherwise(F.concat(F.lit("Torque virus "), k % 31))
    lineage = F.when(k % 4 == 0, "Bacteria; B; x").otherwise(F.concat(F.lit("Viruses; F"), k % 7, F.lit("; Sp "), k % 31))
    calls = o.select(
        *key, sample.alias("unit"), F.concat(F.lit("Sp "), k % 31).alias("species"), (k % 60).cast("long").alias("taxid"), taxname.alias("taxname"), lineage.alias("lineage"), (k % 101).cast("double").alias("contig_coverage"),
        (60 + k % 400 / F.lit(10.0)).alias("pident"), (k % 9 * 1000).alias("genome_size"), (k % 997).alias("slen"), F.lit(0).alias("numreads"),
    )
    name = lambda n: F.concat_ws("", sample, F.lit(".NC"), k.cast("string"), F.lit(f"_{n}_pilon")).alias("#rname")
    coverage = o.select(name(1), (k % 13).alias("numreads")).unionByName(o.select(name(2), (k % 3).alias("numreads")))
    bp = lambda d: F.floor(F.col("o_totalprice") / d).cast("double").alias("bp")
    seg = lambda a, d: o.select(*key, F.lit(a).alias("sstart"), F.lit(a + 9).alias("send"), bp(d))
    qc = o.select(*key, (k % 30 / F.lit(200.0)).alias("frac_hp"), (k % 5 + 1).alias("len_used"), F.lit(1.5).alias("entropy2"))
    vhdb = c.select(
        (F.col("c_custkey") % 40).cast("long").alias("virus_tax_id"), F.concat(F.lit("Viruses; F"), F.col("c_custkey") % 5).alias("virus_lineage"), F.col("c_name").alias("virus_name"), F.col("c_mktsegment").alias("host_name"),
        F.concat_ws("; ", F.lit("E"), "c_mktsegment", F.lit("z")).alias("host_lineage"),
    )
    return commands.full_report(R.drop_redundant_unit(calls), R.coverage_by_call(coverage), R.segment_bp(seg(1, 100).unionByName(seg(1, 100)).unionByName(seg(50, 1000))), R.weighted_qc(qc), vhdb)


@query(f"""WITH {_CALLS}, d AS (SELECT c_custkey % 40 AS taxid, 'Viruses; F' || c_custkey % 5 AS p, c_mktsegment AS host FROM customer), i AS (SELECT taxid, string_agg(DISTINCT host, '; ' ORDER BY host) AS host FROM d GROUP BY 1),
  s AS (SELECT p, host, count(*) AS n FROM d GROUP BY ALL), a AS (SELECT p, host, n, sum(n) OVER (PARTITION BY p) AS t FROM s UNION ALL SELECT 'Viruses', host, sum(n), sum(sum(n)) OVER () FROM s GROUP BY host),
  l AS (SELECT p, string_agg(host, ';' ORDER BY host) AS host FROM a WHERE n / t >= 0.1 GROUP BY p)
  SELECT sample AS "Sample", sacc AS "Reference Accession", taxname AS "Taxonomic Name", respiratory AS "Known Respiratory Virus", CASE WHEN genome_size > 0 THEN round(bp / genome_size * 100, 0) END AS "% Genome", numreads AS "Read Count",
    coalesce(i.host, l.host, w.host) AS "Host" FROM v LEFT JOIN i USING (taxid) LEFT JOIN l ON l.p = regexp_replace(lineage, '; [^;]*$', '') LEFT JOIN l w ON w.p = 'Viruses'""")
def report_detections(spark, sf):
    """The sheet of viruses with hosts and respiratory flag, under its display names; the unit column is left out as it says no more than the sample."""
    sheet = _report(spark, sf)["Virus Detections"]
    assert "unit" not in sheet.columns
    return R.displayed(sheet.select("sample", "sacc", "taxname", "respiratory", "genome_coverage", "numreads", "host"))


@query(f"""WITH {_CALLS}, p AS (SELECT DISTINCT sample, species FROM v WHERE respiratory), n AS (SELECT 'Calls' AS d, (SELECT count(*) FROM c) AS n, 0 AS k UNION ALL SELECT 'Filtered', (SELECT count(*) FROM k), 1 UNION ALL SELECT 'Thresholds', 5, 2
    UNION ALL SELECT 'Species Found', (SELECT count(DISTINCT species) FROM k), 3 UNION ALL SELECT 'Virus Detections', (SELECT count(*) FROM v), 4 UNION ALL SELECT 'Respiratory Viruses', (SELECT count(*) FROM p), 5
    UNION ALL SELECT 'Positive Samples', (SELECT count(DISTINCT sample) FROM p), 6) SELECT CAST(k AS INTEGER) AS step, d AS description, n AS count, d AS tab FROM n""")
def report_summary(spark, sf):
    return _report(spark, sf)["Summary"]


@query(f"""WITH {_CALLS}, p AS (SELECT sample, species, max(bp) AS bp, sum(numreads) AS numreads FROM v WHERE respiratory GROUP BY ALL), u AS (SELECT c_custkey % 60 AS sample, c_name AS unit FROM customer),
  g AS (SELECT sample, string_agg(CAST(numreads AS VARCHAR), ' | ' ORDER BY numreads DESC, species) AS numreadss FROM p GROUP BY 1)
  SELECT CAST(u.sample AS VARCHAR) AS sample, unit, CASE WHEN u.sample % 2 = 0 THEN 'x' || unit END AS site, numreadss FROM u LEFT JOIN g ON g.sample = CAST(u.sample AS VARCHAR)""")
def report_sample_sheet(spark, sf):
    """All units of the sample sheet with their metadata and what was found in their sample, if anything (JOI-07)."""
    c = table(spark, sf, "customer")
    sheet = c.select((F.col("c_custkey") % 60).cast("string").alias("sample"), F.col("c_name").alias("unit"))
    meta = c.where("c_custkey % 60 % 2 = 0").select((F.col("c_custkey") % 60).cast("string").alias("sample"), F.col("c_name").alias("unit"), F.concat(F.lit("x"), "c_name").alias("site"))
    return R.with_sheet(sheet, meta, _report(spark, sf)["Positive Samples"]).select("sample", "unit", "site", "numreadss")


# ---- scaffolds and bins

_PARTS = """p AS (SELECT p_partkey AS k, translate(rpad(regexp_replace(lower(p_name), '[^a-z]', '', 'g'), 40, 'acgt'), 'abcdefghijklmnopqrstuvwxyz', 'ACCGGTTACGTACGTACGTACGTACA') AS s, 'Sp/' || p_partkey % 17 || ' x' AS species,
    'Viruses; F' || (p_partkey % 17) % 4 || '; ' || p_partkey AS lineage FROM part)"""


def _part_calls(spark, sf):
    k = F.col("p_partkey")
    lineage = F.concat(F.lit("Viruses; F"), k % 17 % 4, F.lit("; "), k)
    return table(spark, sf, "part").select(F.lit("p").alias("sample"), k.alias("sacc"), F.concat(F.lit("Sp/"), k % 17, F.lit(" x")).alias("species"), lineage.alias("lineage"))


@query(f"""WITH {_PARTS} SELECT k AS sacc, k || '_0+' || k || '_1' AS acc, 'Sp_' || k % 17 || '_x' AS bin, '25 bp' AS comment, substr(s, 1, 25) AS seq FROM p WHERE (k % 17) % 4 IN (1, 2)""")
def exported_scaffolds(spark, sf):
    """Scaffolds of the calls whose bin's first lineage begins with a pattern, named by species."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("sacc"), F.translate(F.rpad(F.regexp_replace(F.lower("p_name"), "[^a-z]", ""), 40, "acgt"), "abcdefghijklmnopqrstuvwxyz", "ACCGGTTACGTACGTACGTACGTACA").alias("s"))
    rows = p.select("sacc", "s", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, a, b in ((0, 1, 18), (1, 12, 25))])).alias("x"))
    rows = rows.select(F.lit("p").alias("sample"), "sacc", F.concat_ws("_", "sacc", "x.k").alias("qacc"), F.substring("s", F.col("x.a"), F.col("x.b") - F.col("x.a") + 1).alias("seq"), F.col("x.a").alias("sstart"), F.col("x.b").alias("send"), F.col("x.k").alias("ord"))
    rows = rows.withColumn("qstart", F.lit(1)).withColumn("qend", F.length("seq")).withColumn("btop", F.length("seq").cast("string"))
    out = commands.export_fasta(_part_calls(spark, sf), rows.drop("seq"), rows.select(F.col("qacc").alias("acc"), "seq"), lineage="Viruses; F[12];", bin_by="species")
    return out["sequences"].select("sacc", "acc", "bin", "comment", "seq")


@query(f"""WITH {_PARTS}, r AS (SELECT 'p.' || (k * 3) || '_1_pilon' AS acc, CAST(k * 3 AS VARCHAR) AS sacc FROM p) SELECT r.acc, r.sacc, 'Sp_' || k % 17 || '_x' AS bin FROM r JOIN p ON CAST(p.k AS VARCHAR) = r.sacc WHERE (k % 17) % 4 IN (1, 2)""")
def bins_of_records(spark, sf):
    """Records with the bin of their call; those without a call of the lineage fall out."""
    calls = _part_calls(spark, sf).withColumn("sacc", F.col("sacc").cast("string"))
    records = table(spark, sf, "part").select(F.concat(F.lit("p."), F.col("p_partkey") * 3, F.lit("_1_pilon")).alias("acc"))
    return commands.find_bins(calls, records, lineage="Viruses; F[12];")[0].select("acc", "sacc", "bin")


# ---- written and read back


@query(f"WITH {TREE_SQL} SELECT tax_id, lineage FROM paths UNION ALL SELECT 100 + n_nationkey, r_name || '; ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 10 + r_regionkey, r_name FROM region UNION ALL SELECT 1, ''")
def indexed_tree(spark, sf):
    """Lineages written once and read back (SRC-11)."""
    at = new_path(spark, "tree")
    commands.index_tree(taxon_nodes(spark, sf), at)
    return spark.read.parquet(at).select("tax_id", F.array_join("names", "; ").alias("lineage"))


@query("SELECT c_custkey, c_name, 'n' || c_nationkey % 3 AS unit FROM customer")
def stacked_tables(spark, sf):
    """Tables of several files with the unit from each path (SRC-13)."""
    c, at = table(spark, sf, "customer"), new_path(spark, "units")
    for k in range(3):
        c.where(F.col("c_nationkey") % 3 == k).select("c_custkey", "c_name").write.option("header", True).csv(f"{at}/n{k}.csv")
    return readers.many_csv(spark, [f"{at}/n{k}.csv" for k in range(3)], unit=r"/(n\d)\.csv/").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "unit")


@query("""WITH c AS (SELECT o_orderkey AS k, o_custkey % 50 AS sample, 's' || o_orderkey % 900 AS sacc, o_orderkey % 700 AS slen, o_orderkey % 11 AS numreads FROM orders), k AS (SELECT * FROM c WHERE slen >= 200 AND numreads >= 3), d AS (SELECT DISTINCT sacc FROM k)
  SELECT 'calls' AS part, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM k UNION ALL SELECT 'hits', count(*), CAST(sum(k) AS BIGINT) FROM c JOIN d USING (sacc) UNION ALL SELECT 'features', count(*), CAST(sum(k) AS BIGINT) FROM c JOIN d USING (sacc)""")
def bundled_calls(spark, sf):
    """Calls, hits and features of a result bundle, under thresholds of the calls (SRC-15)."""
    k, at = F.col("o_orderkey"), new_path(spark, "bundle")
    c = table(spark, sf, "orders").select(k.alias("k"), (F.col("o_custkey") % 50).alias("sample"), F.concat(F.lit("s"), k % 900).alias("sacc"), (k % 700).alias("slen"), (k % 11).alias("numreads"))
    for kind, rows in (("calls", c), ("hits", c.select("k", "sacc")), ("features", c.select("k", F.col("sacc").alias("acc")))):
        rows.write.option("header", True).csv(f"{at}/x.{kind}.csv")
    out = readers.calls_bundle(spark, f"{at}/x.calls.csv", min_slen=200, min_reads=3)
    one = lambda name: out[name].agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.sum(F.col("k").cast("long")).alias("total"))
    return one("calls").unionByName(one("hits")).unionByName(one("features"))


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer GROUP BY 1) SELECT 'sheet' AS kind, k, n, total FROM a UNION ALL SELECT 'bundle', k, n * 2, total FROM a""")
def sheets_and_bundles(spark, sf):
    """Sheets as CSV files under their names, and tables of a bundle, read back (SNK-07, SNK-08)."""
    c, at = table(spark, sf, "customer"), new_path(spark, "report")
    sheet = c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("total"))
    paths = writers.sheets({"Nation Counts": sheet, "Rest": sheet.limit(1)}, at)
    assert paths[0] == f"{at}/result_nation_counts.csv"
    writers.bundle({"more": sheet.withColumn("n", F.col("n") * 2)}, at)
    kind = "k long, n long, total long"
    read = spark.read.csv(paths[0], header=True, schema=kind).withColumn("kind", F.lit("sheet")).unionByName(spark.read.parquet(f"{at}/more").withColumn("kind", F.lit("bundle")))
    return read.select("kind", F.col("k").cast("long").alias("k"), "n", F.col("total").cast("long").alias("total"))


@query("SELECT o_orderkey % 100 AS file, CAST(o_orderkey AS BIGINT) AS n FROM orders WHERE o_orderkey % 7 > 0")
def read_counts_of_logs(spark, sf):
    """Numbers that log lines of a pattern hold, with their file (SRC-22)."""
    o, at, k = table(spark, sf, "orders"), new_path(spark, "logs"), F.col("o_orderkey")
    line = F.when(k % 7 > 0, F.concat(F.lit("Input reads: "), k, F.lit(" done"))).otherwise(F.concat(F.lit("no reads "), k))
    o.select((k % 100).alias("file"), line.alias("value")).write.partitionBy("file").text(at)
    out = readers.read_counts(spark, at, r"^Input reads: (\d+)")
    return out.select(F.regexp_extract("path", r"file=(\d+)", 1).cast("long").alias("file"), "n")


@query("SELECT p_partkey FROM part WHERE regexp_matches(lower(p_name), '(^[a-f]|green|1[0-4]$)')")
def patterns_of_a_file(spark, sf):
    """Rows that any pattern of a list file matches, in any case (SRC-18, FLT-13)."""
    at = new_path(spark, "patterns")
    spark.createDataFrame([("^[A-F]",), ("GREEN",), ("",), ("1[0-4]$",)], "value string").write.text(at)
    return R.whitelisted(table(spark, sf, "part"), readers.whitelist(spark, at), "p_name").select("p_partkey")


# ---- tables of samples


@query("""WITH c AS (SELECT 'c' || c_custkey AS id, 'c' || c_custkey % 500 AS other, CAST(NULL AS VARCHAR) AS empty, 'S' AS study, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS half FROM customer),
  p AS (SELECT 'id' AS name, count(id) AS n, count(DISTINCT id) AS d, min(id) AS v, true AS known FROM c UNION ALL SELECT 'other', count(other), count(DISTINCT other), '', true FROM c UNION ALL SELECT 'empty', count(empty), count(DISTINCT empty), NULL, true FROM c
    UNION ALL SELECT 'study', count(study), count(DISTINCT study), min(study), false FROM c UNION ALL SELECT 'nation', count(nation), count(DISTINCT nation), '', false FROM c UNION ALL SELECT 'half', count(half), count(DISTINCT half), '', false FROM c), r AS (SELECT count(*) AS r FROM c)
  SELECT name, n > 0 AS filled, d <= 1 AND n IN (0, r) AS constant, CASE WHEN d <= 1 AND n IN (0, r) THEN v END AS value, n = r AND d = r AND known AS ids FROM p, r""")
def column_kinds(spark, sf):
    """Columns of a sample table: empty, constant with their value, and those that hold ids (PRJ-09, PRJ-10, AGG-26, AGG-42)."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(F.concat(F.lit("c"), k).alias("id"), F.concat(F.lit("c"), k % 500).alias("other"), F.lit(None).cast("string").alias("empty"), F.lit("S").alias("study"), F.col("c_nationkey").cast("string").alias("nation"), F.when(k % 2 == 0, "x").alias("half"))
    filled, (constant, rest), ids = E.drop_empty_columns(c).columns, E.split_constant(c), E.id_columns(c, c.select("id"))
    E.assert_constant(c, ["study", "empty"])
    assert set(constant) | set(rest.columns) == set(c.columns)
    return spark.createDataFrame([(x, x in filled, x in constant, constant.get(x), x in ids) for x in c.columns], "name string, filled boolean, constant boolean, value string, ids boolean")


@query("""WITH r AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'Q' ELSE 'R' END || p_partkey || '.9' AS acc, p_partkey AS k FROM part) SELECT acc FROM r WHERE split_part(acc, '.', 1) IN (SELECT 'Q' || p_partkey FROM part WHERE p_size * 4 >= 60)""")
def references_left_out(spark, sf):
    """References that weren't taken, as their accession is there already (SET-07)."""
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    q = p.select(F.concat(F.lit("Q"), k, F.lit(".1_pilon")).alias("acc"), F.repeat(F.lit("ACGT"), F.col("p_size").cast("int")).alias("seq"))
    r = p.select(F.concat(F.when(k % 2 == 0, "Q").otherwise("R"), k, F.lit(".9")).alias("acc"), F.lit("ACGT").alias("seq"))
    return commands.prepare_phylo(q, r, min_bp=60)[1]


@query("""WITH j AS (SELECT event_type AS stage, user_id, sum(value) AS s, sum(value * (event_id % 5)) AS c FROM events GROUP BY ALL), t AS (SELECT *, CASE stage WHEN 'click' THEN 2 WHEN 'view' THEN 4 WHEN 'purchase' THEN 8 ELSE -1 END AS threads FROM j)
  SELECT stage, user_id, threads, round(c / (s * threads), 6) AS efficiency FROM t WHERE threads > 2""")
def job_efficiency(spark, sf):
    """CPU seconds by seconds and threads, of jobs of more than two threads (STA-05, FLT-22)."""
    j = table(spark, sf, "events").select(F.col("event_type").alias("stage"), "user_id", F.col("value").alias("s"), (F.col("value") * (F.col("event_id") % 5)).alias("cpu_time"))
    out = E.core_hours(j, {"click": 2, "view": 4, "purchase": 8}, keys=("stage", "user_id"), more_than=2)
    return out.select("stage", "user_id", "threads", F.round("efficiency", 6).alias("efficiency"))


# ---- studies


@query("""WITH c AS (SELECT o_orderpriority AS study, o_custkey % 400 AS sample, CASE WHEN o_orderkey % 5 > 0 THEN 'V' || o_orderkey % 4 END AS virus, o_orderkey % 9000 + 1000 AS raw, o_orderkey % 900 + 100 AS filtered, o_orderkey % 20000 + 5000 AS genome, o_orderkey % 77 AS n FROM orders),
  g AS (SELECT study, sample, string_agg(DISTINCT virus, '+' ORDER BY virus) AS virus, sum(raw) AS t, sum(filtered) AS h, max(genome) AS g, sum(n) AS v FROM c WHERE virus IS NOT NULL GROUP BY ALL)
  SELECT study, sample, virus, round(v / t * 100, 6) AS pct_viral, round(v / h * 100, 6) AS pct_viral_nonhuman, round(v / g * 100, 6) AS viral_per_genome, round(v / (g / 1000) / (t / 1000000), 4) AS rpkm_all, round(v / (g / 1000) / (h / 1000000), 4) AS rpkm_nonhuman FROM g""")
def viral_loads(spark, sf):
    k = F.col("o_orderkey")
    calls = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("study"), (F.col("o_custkey") % 400).alias("sample"), F.when(k % 5 > 0, F.concat(F.lit("V"), k % 4)).alias("virus"), (k % 9000 + 1000).alias("raw_reads"), (k % 900 + 100).alias("filtered_reads"),
        (k % 20000 + 5000).alias("genome_length"), (k % 77).alias("numreads"),
    )
    out = E.viral_loads(calls)
    return out.select("study", "sample", "virus", *[F.round(c, 6).alias(c) for c in ("pct_viral", "pct_viral_nonhuman", "viral_per_genome")], *[F.round(c, 4).alias(c) for c in ("rpkm_all", "rpkm_nonhuman")])
