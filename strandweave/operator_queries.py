"""Driver queries over single operators of filters, joins, report, expression, intervals and taxonomy, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as C
from .operators import chains, expression as E, hits as H, intervals as I, report as R, taxonomy as T
from .plans import commands
from .scratch import written
from .sources import readers
from .views import HITS_SQL, TREE_SQL, hits, table, taxon_nodes

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


_UNITS = "u AS (SELECT l_orderkey % 50 AS sample, l_orderkey AS qacc, CAST(sum(l_linenumber) AS BIGINT) AS numreads FROM lineitem WHERE l_linenumber <> 2 GROUP BY ALL)"


def _coverage(spark, sf):
    """Reads of queries by unit, of which a query has several or none."""
    return table(spark, sf, "lineitem").where("l_linenumber <> 2").select((F.col("l_orderkey") % 50).alias("sample"), F.col("l_orderkey").alias("qacc"), F.col("l_linenumber").alias("numreads"))


@query(f"WITH {HITS_SQL}, {_UNITS} SELECT h.ord FROM h JOIN u ON h.sample = u.sample AND h.qacc = u.qacc WHERE u.numreads >= 8")
def min_reads(spark, sf):
    return H.min_reads(hits(spark, sf), _coverage(spark, sf), 8).select("ord")


@query(f"WITH {HITS_SQL} SELECT h.ord FROM h JOIN orders ON h.qacc = o_orderkey WHERE CAST(o_orderkey % 40 AS DOUBLE) / 100 * 100 <= 15")
def max_homopolymer(spark, sf):
    qc = table(spark, sf, "orders").select(F.col("o_orderkey").alias("acc"), ((F.col("o_orderkey") % 40).cast("double") / 100).alias("frac_hp"))
    return H.max_homopolymer(hits(spark, sf), qc, 15.0).select("ord")


@query(f"WITH {TREE_SQL}, b AS (SELECT n.tax_id FROM nodes n JOIN nodes p ON n.parent_id = p.tax_id WHERE p.name = 'ASIA' OR n.name = 'ASIA' OR n.parent_id IN (SELECT tax_id FROM nodes WHERE parent_id = (SELECT tax_id FROM nodes WHERE name = 'ASIA'))) SELECT tax_id FROM b WHERE tax_id NOT IN (SELECT n.tax_id FROM nodes n LEFT JOIN nodes p ON n.parent_id = p.tax_id WHERE n.name = 'NATION_12' OR p.name = 'NATION_12')")
def allowed_ids(spark, sf):
    return T.allowed_ids(T.lineage(taxon_nodes(spark, sf)), ["ASIA"], ["NATION_12"])


@query(f"WITH {HITS_SQL}, {TREE_SQL}, x AS (SELECT DISTINCT h.sample, h.qacc, h.taxid, h.bitscore, first_value(h.ord) OVER (PARTITION BY h.sample, h.qacc, h.taxid, h.bitscore ORDER BY ord) AS ord FROM h),"
       " r AS (SELECT sample, qacc, bitscore AS w, generate_subscripts(path, 1) - 1 AS depth, unnest(path) AS node, ord FROM x JOIN paths ON taxid = tax_id),"
       " n AS (SELECT sample, qacc, depth, node, sum(w) AS w, min(ord) AS first FROM r GROUP BY ALL), d AS (SELECT sample, qacc, depth, sum(w) AS tot, max(w) AS top FROM n GROUP BY ALL), t AS (SELECT sample, qacc, max(tot) AS total FROM d GROUP BY ALL),"
       " g AS (SELECT d.* FROM d JOIN t USING (sample, qacc) WHERE tot >= total * 0.9 - 1e-9 AND top >= tot * 0.9 - 1e-9), m AS (SELECT sample, qacc, max(depth) AS depth FROM g GROUP BY ALL)"
       " SELECT n.sample, n.qacc, arg_min(n.node, n.first) AS taxid, round(max(g.top / g.tot), 6) AS score FROM m JOIN g USING (sample, qacc, depth) JOIN n USING (sample, qacc, depth) WHERE n.w >= g.top - 1e-9 GROUP BY n.sample, n.qacc")  # fmt: skip
def classify_contigs(spark, sf):
    return T.classify_contigs(hits(spark, sf), T.lineage(taxon_nodes(spark, sf))).withColumn("score", F.round("score", 6))


@query(f"WITH {TREE_SQL}, q AS (SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey + 1000 WHEN 1 THEN s_suppkey + 50000 ELSE -1 END AS id FROM supplier) SELECT q.k, coalesce(n.tax_id, m.s_suppkey + 1000) AS tax_id FROM q LEFT JOIN nodes n ON n.tax_id = q.id LEFT JOIN supplier m ON m.s_suppkey + 50000 = q.id")
def resolve_merged(spark, sf):
    """Ids that are valid, merged into another, and unknown."""
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    ids = s.select(k.alias("k"), F.when(k % 3 == 0, k + 1000).when(k % 3 == 1, k + 50_000).otherwise(-1).cast("long").alias("tax_id"))
    merged = s.select((k + 50_000).cast("long").alias("old_id"), (k + 1000).cast("long").alias("new_id"))
    return T.resolve(ids, T.lineage(taxon_nodes(spark, sf)), merged).select("k", "tax_id")


@query(f"WITH {TREE_SQL} SELECT o_orderkey, coalesce(s_name, 'Unknown') AS taxname, coalesce(s_name, 'Unknown') AS species, coalesce(lineage, 'Unknown') AS lineage, CASE WHEN lineage IS NULL THEN 'no rank' ELSE 'phylum; genus; species' END AS lineage_ranks FROM orders LEFT JOIN paths ON o_orderkey % 150 + 1001 = tax_id LEFT JOIN supplier ON tax_id = s_suppkey + 1000")
def annotate_lineage(spark, sf):
    """Names, species and lineages of ids, some of which the tree lacks."""
    calls = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 150 + 1001).cast("long").alias("taxid"))
    return T.annotate(calls, T.lineage(taxon_nodes(spark, sf))).select("o_orderkey", "taxname", "species", "lineage", "lineage_ranks")


@query(f"WITH {TREE_SQL} SELECT name, tax_id FROM nodes WHERE name IN ('NATION_3', 'EUROPE')")
def ids_by_name(spark, sf):
    return T.ids_by_name(T.lineage(taxon_nodes(spark, sf)), ["NATION_3", "EUROPE", "no such name"])


@query("SELECT p_partkey, regexp_replace(p_type, ' [^ ]*$', '') AS parent, string_split(p_type, ' ')[1] AS top, CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) END AS a, CASE WHEN p_size > 25 THEN p_partkey ELSE NULL END AS b FROM part")
def lineage_ends(spark, sf):
    """Lineages without their last, and with their first element only; a conditional swap."""
    p = table(spark, sf, "part")
    a, b = C.swap_if(F.col("p_size") > 25, F.lit(None).cast("long"), F.col("p_size").cast("long"))
    keep = F.when(F.col("p_size") > 25, F.col("p_partkey"))
    return p.select("p_partkey", C.drop_last(F.col("p_type"), " ").alias("parent"), C.first_elements(F.col("p_type"), 1, " ").alias("top"), F.when(b.isNull(), a).alias("a"), keep.alias("b"))


@query("SELECT p_partkey, CASE WHEN p_size > 0 AND p_size % 3 <> 0 THEN round(CAST(p_partkey AS DOUBLE) / p_size * 100, 0) END AS pct, round((p_size * 0.625 - ln(0.41)) / ln(2.0), 6) AS bits, CASE WHEN p_type LIKE '%BRASS%' THEN 'brass' WHEN p_type LIKE 'STANDARD%' THEN 'standard' ELSE 'other' END AS kind FROM part")
def scalar_ratios(spark, sf):
    """Genome coverage, bit scores, and a CASE over regexes whose last match wins."""
    size = F.when(F.col("p_size") % 3 != 0, F.col("p_size"))
    kind = C.last_match(F.col("p_type"), [("^STANDARD", "standard"), ("BRASS", "brass")], "other")
    return table(spark, sf, "part").select("p_partkey", C.genome_coverage(F.col("p_partkey").cast("double"), size).alias("pct"), F.round(C.bit_score(F.col("p_size")), 6).alias("bits"), kind.alias("kind"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS a, CASE WHEN len(string_split(p_name, ' ')) > 1 THEN array_to_string(string_split(p_name, ' ')[2:], ' ') END AS b, string_split(p_type, ' ')[2] AS c FROM part")
def separate_columns(spark, sf):
    a, b = C.separate(F.col("p_name"), ["a", "b"], " ", merge=True)
    _, c = C.separate(F.col("p_type"), ["x", "c"], " ")
    return table(spark, sf, "part").select("p_partkey", a, b, c)


@query("WITH x AS (SELECT p_brand, string_split(p_type, ' ') AS ps FROM part) SELECT p_brand, array_to_string(list_sort(list_distinct(flatten(list(ps)))), ';') AS types FROM x GROUP BY 1")
def merge_lists(spark, sf):
    p = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_list(F.replace("p_type", F.lit(" "), F.lit(";"))).alias("v"))
    return p.select("p_brand", C.merge_lists(F.col("v"), ";").alias("types"))


# ---- report


@query("SELECT 's' || (l_orderkey % 9) AS sample, 'NC' || (l_suppkey % 99) || '.1' AS sacc, CAST(sum(l_linenumber) AS BIGINT) AS numreads FROM lineitem GROUP BY 1, 2")
def coverage_by_call(spark, sf):
    """Reads over the fragments of scaffold names."""
    name = F.concat(F.lit("s"), F.col("l_orderkey") % 9, F.lit(".NC"), F.col("l_suppkey") % 99, F.lit("_"), F.col("l_linenumber"), F.lit("_pilon"))
    cov = table(spark, sf, "lineitem").select(name.alias("#rname"), F.col("l_linenumber").alias("numreads"))
    return R.coverage_by_call(cov).select("sample", F.concat("sacc", F.lit(".1")).alias("sacc"), "numreads")


@query("SELECT o_orderkey, o_orderstatus AS status, c_name, n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey LEFT JOIN nation ON o_custkey % 40 = n_nationkey")
def join_parts(spark, sf):
    """Left joins of parts by key; a column that a part brings replaces that of the calls."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 40).alias("n"), F.col("o_orderstatus").alias("status"), F.lit("old").alias("c_name"))
    c = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("n"), "n_name")
    return R.join_parts(R.join_parts(o, c, keys=("o_custkey",)), n, keys=("n",)).select("o_orderkey", "status", "c_name", "n_name")


@query("SELECT o_orderkey, 'v' || o_custkey % 7 AS sample FROM orders WHERE o_comment_like AND o_totalprice > 0".replace("o_comment_like", "o_orderpriority LIKE '1-%' OR lower(o_orderpriority) LIKE '%low%'").replace("WHERE ", "WHERE (").replace(" AND o_total", ") AND o_total"))
def whitelist_and_names(spark, sf):
    """Rows that a case-insensitive pattern matches; sample names cut to a group."""
    o = table(spark, sf, "orders").where("o_totalprice > 0").withColumn("sample", F.concat(F.lit("v"), F.col("o_custkey") % 7, F.lit("_L001_x")))
    return R.rewrite_sample(R.whitelisted(o, ["^1-", "low"], "o_orderpriority"), r"^(v\d+)_").select("o_orderkey", "sample")


@query("SELECT c_nationkey AS sample, string_agg(c_name, ', ' ORDER BY c_name) AS units, count(*) AS n_units, CAST(sum(c_custkey) AS BIGINT) AS processed, CAST(sum(c_custkey % 10) AS BIGINT) AS mapped FROM customer GROUP BY 1")
def sheet_rollup(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("sample"), F.col("c_name").alias("unit"), F.col("c_custkey").alias("processed"), (F.col("c_custkey") % 10).alias("mapped"))
    return R.sheet_rollup(c)


@query("""WITH r AS (SELECT o_custkey % 50 AS k, CASE WHEN o_orderkey % 11 > 0 THEN 'h' || o_orderkey % 31 END AS host,
    CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 50 < 40 OR o_custkey % 50 = 49 THEN NULL WHEN o_orderkey % 20 = 1 THEN 'X; rare; z' WHEN o_orderkey % 2 = 0 THEN 'A; b; c; ' || o_orderkey ELSE 'A; d; e' END AS lineage FROM orders),
  f AS (SELECT *, string_split(lineage, ';') AS p FROM r WHERE host IS NOT NULL AND lineage IS NOT NULL), t AS (SELECT k, count(*) AS n FROM r GROUP BY k),
  x AS (SELECT *, count(*) OVER (PARTITION BY k, p[1]) AS a FROM f), y AS (SELECT x.*, count(*) OVER (PARTITION BY k, p[1:2]) AS b FROM x JOIN t USING (k) WHERE a / n >= 0.1),
  z AS (SELECT y.*, count(*) OVER (PARTITION BY k, p[1:3]) AS c FROM y JOIN t USING (k) WHERE b / n >= 0.1), s AS (SELECT k, string_agg(DISTINCT host, ';' ORDER BY host) AS host FROM z JOIN t USING (k) WHERE c / n >= 0.1 GROUP BY k)
  SELECT k, coalesce(host, '') AS host FROM t LEFT JOIN s USING (k)""")
def host_summary(spark, sf):
    """Hosts whose lineage levels each hold a tenth of a key's rows, those without a name or a lineage included in the total."""
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 50
    lineage = F.when(((k % 3 == 0) & (c < 40)) | (c == 49), F.lit(None)).when(k % 20 == 1, "X; rare; z").when(k % 2 == 0, F.concat(F.lit("A; b; c; "), k)).otherwise("A; d; e")
    rows = table(spark, sf, "orders").select(c.alias("k"), F.when(k % 11 > 0, F.concat(F.lit("h"), k % 31)).alias("host_name"), lineage.alias("lineage"))
    return R.host_summary(rows, "k", "host_name", "lineage")


@query("""WITH v AS (SELECT c_custkey, CASE WHEN c_custkey % 9 > 0 THEN c_mktsegment END AS host, CASE WHEN c_custkey % 7 > 0 THEN 'H' || c_custkey % 3 || '; ' || c_mktsegment || '; z' END AS host_lineage,
    r_name || CASE WHEN n_nationkey % 5 = 0 THEN '; unplaced' WHEN n_nationkey % 2 = 1 THEN '; ' || n_name || '-like' ELSE '; ' || n_name END || '; ' || c_name AS lin FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  q AS (SELECT s_suppkey, r_name || '; ' || n_name || '; ' || s_name AS lineage, [r_name || '; ' || n_name || '; ' || s_name, r_name || '; ' || n_name, r_name] AS ups FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT -1 - c_custkey, lin, [lin, regexp_replace(lin, '; [^;]*$', ''), split_part(lin, '; ', 1)] FROM v),
  u AS (SELECT DISTINCT lineage, ups[i] AS prefix, i FROM q, range(1, 4) g(i)), l AS (SELECT lineage, arg_min(prefix, i) AS prefix FROM u WHERE EXISTS (SELECT 1 FROM v WHERE starts_with(v.lin, u.prefix)) GROUP BY lineage),
  m AS (SELECT p.prefix, v.* FROM (SELECT DISTINCT prefix FROM l) p JOIN v ON starts_with(v.lin, p.prefix)), t AS (SELECT prefix, count(*) AS n FROM m GROUP BY 1),
  c AS (SELECT prefix, host_lineage, count(*) AS k FROM m WHERE host IS NOT NULL AND host_lineage IS NOT NULL GROUP BY ALL),
  s AS (SELECT m.prefix, string_agg(DISTINCT host, ';' ORDER BY host) AS host FROM m JOIN t ON m.prefix = t.prefix JOIN c ON c.prefix = m.prefix AND c.host_lineage = m.host_lineage WHERE host IS NOT NULL AND k / n >= 0.1 GROUP BY 1)
  SELECT q.s_suppkey AS call, q.lineage, CASE WHEN l.prefix IS NOT NULL THEN coalesce(s.host, '') END AS host FROM q LEFT JOIN l USING (lineage) LEFT JOIN s ON l.prefix = s.prefix""")
def hosts_by_string_prefix(spark, sf):
    """Hosts of lineages by the longest prefix that any known virus begins with, prefixes that end inside a name (`NATION_1` of `NATION_12`) included."""
    n, r, c, s = (table(spark, sf, t) for t in ("nation", "region", "customer", "supplier"))
    places = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    k, genus = F.col("n_nationkey"), F.col("n_name")
    genus = F.when(k % 5 == 0, "unplaced").when(k % 2 == 1, F.concat(genus, F.lit("-like"))).otherwise(genus)
    own = c.join(places, F.col("c_nationkey") == k)
    vhdb = own.select(
        F.col("c_custkey").cast("long").alias("virus_tax_id"), F.concat_ws("; ", "r_name", genus).alias("virus_lineage"), F.col("c_name").alias("virus_name"), F.when(F.col("c_custkey") % 9 > 0, F.col("c_mktsegment")).alias("host_name"),
        F.when(F.col("c_custkey") % 7 > 0, F.concat(F.lit("H"), F.col("c_custkey") % 3, F.lit("; "), "c_mktsegment", F.lit("; z"))).alias("host_lineage"),
    )
    calls = s.join(places, F.col("s_nationkey") == k).select(F.col("s_suppkey").cast("long").alias("call"), F.concat_ws("; ", "r_name", "n_name", "s_name").alias("lineage"))
    calls = calls.unionByName(vhdb.select((-1 - F.col("virus_tax_id")).alias("call"), F.concat_ws("; ", "virus_lineage", "virus_name").alias("lineage"))).withColumn("taxid", F.lit(-1).cast("long"))
    return R.annotate_hosts(calls, vhdb, mode="string").select("call", "lineage", "host")


@query("WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS r FROM orders) SELECT o_orderkey, CAST(r // 40 + 1 AS BIGINT) AS page FROM n")
def page_numbers(spark, sf):
    """Pages of 40 rows in a global order, numbered over a range partitioning."""
    return R.pages(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 40, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "page")


@query(f"WITH {HITS_SQL}, s AS (SELECT sacc, min(lo) AS a, max(lo) AS b FROM h GROUP BY 1), r AS (SELECT h.sacc, lo, score, CAST(floor(CAST((lo - a) * 50 AS DOUBLE) / (b - a + 1)) AS BIGINT) AS bin FROM h JOIN s ON h.sacc = s.sacc) SELECT sacc, bin, min(lo) AS start, max(lo) AS \"end\", median(score) AS median FROM r GROUP BY ALL")
def binned_median(spark, sf):
    return R.binned_median(hits(spark, sf).select("sacc", F.least("sstart", "send").alias("pos"), "score"), ["sacc"], "score", 50)


@query("SELECT p_brand AS acc, p_size % 5 AS gstart, p_size % 5 + 90 AS gstop, 'k' AS key, p_type AS value, min(p_size) AS start, max(p_size + 3) AS stop FROM part GROUP BY ALL")
def merge_annotations(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("acc"), (F.col("p_size") % 5).alias("gstart"), (F.col("p_size") % 5 + 90).alias("gstop"), F.lit("k").alias("key"), F.col("p_type").alias("value"), F.col("p_size").alias("start"), (F.col("p_size") + 3).alias("stop"))
    return R.merge_annotations(p)


# ---- expression


_GENES = "g AS (SELECT p_partkey AS gene_id, CASE WHEN p_partkey % 50 = 0 THEN 'MT-' || p_partkey ELSE 'G' || p_partkey END AS gene_name, CASE p_size % 5 WHEN 0 THEN 'rRNA' WHEN 1 THEN 'lncRNA' WHEN 2 THEN 'IG_V_gene' WHEN 3 THEN NULL ELSE 'protein_coding' END AS biotype FROM part)"


def _genes(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size") % 5
    return table(spark, sf, "part").select(k.alias("gene_id"), F.when(k % 50 == 0, F.concat(F.lit("MT-"), k)).otherwise(F.concat(F.lit("G"), k)).alias("gene_name"), F.when(n == 0, "rRNA").when(n == 1, "lncRNA").when(n == 2, "IG_V_gene").when(n == 4, "protein_coding").alias("biotype"))


@query(f"WITH {_GENES}, x AS (SELECT l_partkey AS gene_id, l_orderkey % 30 AS sample, sum(l_quantity) AS counts FROM lineitem GROUP BY ALL), c AS (SELECT x.*, CASE WHEN gene_name LIKE 'MT-%' THEN 'mito' WHEN biotype = 'rRNA' THEN 'ribo' WHEN biotype <> 'protein_coding' THEN 'noncoding' ELSE 'coding' END AS class FROM x JOIN g ON x.gene_id = g.gene_id)"
       " SELECT sample, sum(counts) AS total, count(*) FILTER (WHERE counts > 0) AS n_expressed, coalesce(sum(counts) FILTER (WHERE class = 'mito'), 0) AS mito, coalesce(sum(counts) FILTER (WHERE class = 'ribo'), 0) AS ribo, coalesce(sum(counts) FILTER (WHERE class = 'coding'), 0) AS coding, round(coalesce(sum(counts) FILTER (WHERE class = 'noncoding'), 0) / sum(counts) * 100, 2) AS pct_noncoding FROM c GROUP BY sample")  # fmt: skip
def sample_qc(spark, sf):
    x = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("gene_id"), (F.col("l_orderkey") % 30).alias("sample")).agg(F.sum("l_quantity").alias("counts"))
    return E.sample_qc(x, _genes(spark, sf)).select("sample", "total", "n_expressed", "mito", "ribo", "coding", "pct_noncoding")


@query("WITH t AS (SELECT l_partkey % 100 AS gene_id, l_orderkey % 20 AS sample, l_quantity AS c, l_discount AS a, l_extendedprice AS n FROM lineitem) SELECT gene_id, sample, sum(c) AS counts, round(sum(a), 6) AS abundance, round(CASE WHEN sum(a) > 0 THEN sum(n * a) / sum(a) ELSE avg(n) END, 3) AS length FROM t GROUP BY ALL")
def gene_summary(spark, sf):
    tx = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("feature_id"), (F.col("l_orderkey") % 20).alias("sample"), F.col("l_quantity").alias("counts"), F.col("l_discount").alias("abundance"), F.col("l_extendedprice").alias("length"))
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("feature_id"), (F.col("p_partkey") % 100).alias("gene_id"))
    return E.gene_summary(tx, names).withColumn("abundance", F.round("abundance", 6)).withColumn("length", F.round("length", 3))


@query("""WITH x AS (SELECT l_partkey % 200 AS f, l_orderkey % 12 AS s, CAST(sum(l_linenumber - 1) AS DOUBLE) AS c FROM lineitem GROUP BY ALL), g AS (SELECT f, exp(sum(CASE WHEN c > 0 THEN ln(c) ELSE 0 END) / 12) AS gm FROM x GROUP BY 1 HAVING max(c) > 0),
  r AS (SELECT s, exp(median(ln(c / gm))) AS sf FROM x JOIN g ON x.f = g.f WHERE c > 0 GROUP BY 1) SELECT s AS sample, round(sf / exp((SELECT avg(ln(sf)) FROM r)), 6) AS sf FROM r""")
def size_factors(spark, sf):
    x = table(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 200).alias("feature_id"), (F.col("l_orderkey") % 12).alias("sample")).agg(F.sum(F.col("l_linenumber") - 1).cast("double").alias("counts"))
    return E.size_factors(x).select("sample", F.round("sf", 6).alias("sf"))


@query("""WITH x AS (SELECT l_partkey % 200 AS f, l_orderkey % 12 AS s, CAST(sum(l_linenumber - 1) AS DOUBLE) AS c FROM lineitem GROUP BY ALL), g AS (SELECT f, exp(sum(CASE WHEN c > 0 THEN ln(c) ELSE 0 END) / 12) AS gm FROM x GROUP BY 1 HAVING max(c) > 0),
  r AS (SELECT s, exp(median(ln(c / gm))) AS sf FROM x JOIN g ON x.f = g.f WHERE c > 0 GROUP BY 1), z AS (SELECT s, sf / exp((SELECT avg(ln(sf)) FROM r)) AS sf FROM r), v AS (SELECT f, x.s, log2(c / sf + 1) AS v FROM x JOIN z ON x.s = z.s),
  n AS (SELECT DISTINCT f FROM v), w AS (SELECT n.f, z.s, coalesce(v.v, 0) AS v FROM n CROSS JOIN z LEFT JOIN v ON v.f = n.f AND v.s = z.s), m AS (SELECT f, s, v - avg(v) OVER (PARTITION BY f) AS v FROM w),
  k AS (SELECT a.s AS i, b.s AS j, sum(a.v * b.v) / 11 AS k FROM m a JOIN m b ON a.f = b.f GROUP BY ALL), k2 AS (SELECT a.i, b.j, sum(a.k * b.k) AS k FROM k a JOIN k b ON a.j = b.i GROUP BY ALL), k3 AS (SELECT a.i, b.j, sum(a.k * b.k) AS k FROM k2 a JOIN k b ON a.j = b.i GROUP BY ALL),
  k4 AS (SELECT a.i, b.j, sum(a.k * b.k) AS k FROM k2 a JOIN k2 b ON a.j = b.i GROUP BY ALL)
  SELECT 1 AS power, round(sum(k), 4) AS total FROM k WHERE i = j UNION ALL SELECT 2, round(sum(k), 4) FROM k2 WHERE i = j UNION ALL SELECT 3, round(sum(k), 4) FROM k3 WHERE i = j UNION ALL SELECT 4, round(sum(k), 4) FROM k4 WHERE i = j""")
def component_variances(spark, sf):
    """Sums of the first four powers of the components' variances, which are traces of powers of the samples' covariances."""
    x = table(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 200).alias("feature_id"), (F.col("l_orderkey") % 12).alias("sample")).agg(F.sum(F.col("l_linenumber") - 1).cast("double").alias("counts"))
    variances = E.log_components(x)[2]
    return spark.createDataFrame([(p, round(float((variances**p).sum()), 4)) for p in (1, 2, 3, 4)], "power int, total double")


@query("SELECT n_nationkey AS id, 'id' || n_nationkey AS fastq, CASE WHEN n_nationkey % 2 = 0 THEN 'R1' ELSE 'R2' END AS mate, CAST(n_nationkey * 10 AS BIGINT) AS reads, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 35 ELSE 101 END AS INTEGER) AS read_len_min, CAST(101 AS INTEGER) AS read_len_max, CAST(n_regionkey + 40 AS DOUBLE) AS pct_gc FROM nation".replace("n_nationkey AS id, 'id' || n_nationkey AS fastq", "'id' || n_nationkey AS id"))
def fastqc_columns(spark, sf):
    k = F.col("n_nationkey")
    raw = table(spark, sf, "nation").select(
        F.concat(F.lit("id"), k, F.when(k % 2 == 0, "_R1").otherwise("_R2")).alias("Sample"), F.when(k % 3 == 0, "35-101").otherwise("101").alias("Sequence length"), (k * 10).alias("Total Sequences"), (F.col("n_regionkey") + 40).alias("%GC"),
    )
    return E.fastqc_columns(raw)


@query("WITH i AS (SELECT o_custkey % 5 AS study, o_orderpriority AS virus, o_custkey AS sample FROM orders WHERE o_orderstatus = 'F'), t AS (SELECT c_custkey % 5 AS study, count(*) AS n_samples FROM customer GROUP BY 1), a AS (SELECT study, count(DISTINCT sample) AS n_infected FROM i GROUP BY 1), n AS (SELECT study, virus, count(DISTINCT sample) AS n FROM i GROUP BY ALL)"
       " SELECT n.study, virus, n, n_samples, n_infected, round(n / n_samples, 9) AS rate, round(n / n_infected, 9) AS prevalence FROM n JOIN t ON n.study = t.study JOIN a ON n.study = a.study")  # fmt: skip
def infection_rates(spark, sf):
    calls = table(spark, sf, "orders").where("o_orderstatus = 'F'").select((F.col("o_custkey") % 5).alias("study"), F.col("o_orderpriority").alias("virus"), F.col("o_custkey").alias("sample"))
    samples = table(spark, sf, "customer").select((F.col("c_custkey") % 5).alias("study"), F.col("c_custkey").alias("sample"))
    return E.infection_rates(calls, samples).withColumn("rate", F.round("rate", 9)).withColumn("prevalence", F.round("prevalence", 9))


@query("SELECT n_name AS k, 'a' AS study, n_regionkey AS x, NULL AS y FROM nation UNION ALL SELECT r_name, 'b', NULL, r_regionkey FROM region")
def stack_studies(spark, sf):
    a = table(spark, sf, "nation").select(F.col("n_name").alias("k"), F.col("n_regionkey").alias("x"))
    b = table(spark, sf, "region").select(F.col("r_name").alias("k"), F.col("r_regionkey").alias("y"))
    return E.stack_studies({"a": a, "b": b})


@query("WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS r FROM customer), b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders) SELECT c_custkey, o_orderkey FROM a JOIN b ON a.r = b.r")
def bind_columns(spark, sf):
    """Two tables side by side by their place in global orders."""
    a, b = table(spark, sf, "customer").select("c_custkey", "c_acctbal"), table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return E.bind_columns(a, b, ["c_acctbal", "c_custkey"], ["o_totalprice", "o_orderkey"]).select("c_custkey", "o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def failed_files(spark, sf):
    return E.failed_files(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# ---- intervals


@query("""WITH x AS (SELECT p_size % 4 AS chrom, 'g' || (p_partkey // 5) AS gene, p_partkey * 11 + 1 AS s, p_partkey * 11 + p_size * 2 AS e FROM part), p AS (SELECT DISTINCT chrom, unnest([s, e + 1]) AS a FROM x),
  g AS (SELECT chrom, a AS start, lead(a) OVER (PARTITION BY chrom ORDER BY a) - 1 AS "end" FROM p), m AS (SELECT g.chrom, g.start, g."end", count(DISTINCT gene) AS n, min(gene) AS gene FROM g JOIN x ON g.chrom = x.chrom AND x.s <= g.start AND x.e >= g."end" GROUP BY ALL) SELECT chrom, start, "end", gene FROM m WHERE n = 1""")
def disjoint_parts(spark, sf):
    """Exonic parts of exactly one gene."""
    k = F.col("p_partkey")
    x = table(spark, sf, "part").select((F.col("p_size") % 4).alias("chrom"), F.concat(F.lit("g"), F.floor(k / 5)).alias("gene"), (k * 11 + 1).alias("start"), (k * 11 + F.col("p_size") * 2).alias("end"))
    return I.disjoint_parts(x, ["chrom"], "gene")


@query("""WITH r AS (SELECT l_suppkey % 7 AS chrom, l_orderkey AS fragment, l_partkey * 13 % 4000 + 1 AS a, l_partkey * 13 % 4000 + 90 AS b, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand FROM lineitem), p AS (SELECT p_partkey AS part, p_partkey % 7 AS chrom, p_partkey * 29 % 4000 + 1 AS s, p_partkey * 29 % 4000 + p_size AS e FROM part)
  SELECT p.chrom, part, count(DISTINCT fragment) AS n FROM r JOIN p ON r.chrom = p.chrom AND a <= e AND s <= b GROUP BY ALL""")
def count_fragments(spark, sf):
    """Distinct fragments over parts."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    at = F.col("l_partkey") * 13 % 4000
    reads = li.select((F.col("l_suppkey") % 7).alias("chrom"), F.col("l_orderkey").alias("fragment"), (at + 1).alias("start"), (at + 90).alias("end"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"))
    parts = p.select((F.col("p_partkey") % 7).alias("chrom"), F.col("p_partkey").alias("part"), (F.col("p_partkey") * 29 % 4000 + 1).alias("start"), (F.col("p_partkey") * 29 % 4000 + F.col("p_size")).alias("end"))
    return I.count_fragments(reads, parts, ["chrom"], ["part"])


@query(f"WITH {HITS_SQL}, r AS (SELECT sacc, lo, hi, max(hi) OVER (PARTITION BY sacc, sample ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, sample FROM (SELECT qacc AS sample, sacc, lo, hi FROM h)),"
       " i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo - reach > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY sacc, sample ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS k FROM r), b AS (SELECT sacc, sample, min(lo) AS s, max(hi) AS e FROM i GROUP BY sacc, sample, k)"
       " SELECT sacc, sample, s AS start, e AS \"end\", CAST(coalesce(sum(e - s + 1 + 20) OVER (PARTITION BY sacc, sample ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 - s AS BIGINT) AS \"offset\" FROM b")  # fmt: skip
def compressed_axis(spark, sf):
    """Blocks of all contigs on an axis whose gaps are 20 wide."""
    b = hits(spark, sf).select("sacc", F.col("qacc").alias("sample"), F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end"))
    return I.compressed_axis(b, ["sacc", "sample"], 20)


@query(f"""WITH {HITS_SQL}, p AS (SELECT sample, sacc, ord, ord * 7 % 6000 AS pos FROM h), b AS (SELECT DISTINCT sample, sacc, unnest([lo, hi + 1]) AS s FROM h), g AS (SELECT sample, sacc, s, lead(s) OVER (PARTITION BY sample, sacc ORDER BY s) - 1 AS e FROM b),
  n AS (SELECT p.ord, count(h.ord) AS n FROM p LEFT JOIN h ON p.sample = h.sample AND p.sacc = h.sacc AND lo <= pos AND hi >= pos GROUP BY 1)
  SELECT p.ord, pos, g.s AS start, g.e AS "end", n FROM p JOIN n USING (ord) LEFT JOIN g ON p.sample = g.sample AND p.sacc = g.sacc AND g.s <= pos AND g.e >= pos""")
def segments_at_points(spark, sf):
    """The segment over each of many positions, and how many hits it holds."""
    h = hits(spark, sf)
    segs = I.segments(h, ["sample", "sacc"], "sstart", "send", "qacc", "ord")
    counted = segs.select("sample", "sacc", "start", "end", F.size("payload").cast("long").alias("n"))
    points = h.select("sample", "sacc", "ord", (F.col("ord") * 7 % 6000).alias("pos"))
    return I.at_points(points, counted, ["sample", "sacc"], "pos").select("ord", "pos", "start", "end", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query(f"""WITH {HITS_SQL}, k AS (SELECT * FROM h WHERE score >= 40), p AS (SELECT DISTINCT sample, sacc, unnest([lo, hi + 1]) AS s FROM k), g AS (SELECT sample, sacc, s AS start, lead(s) OVER (PARTITION BY sample, sacc ORDER BY s) - 1 AS "end" FROM p)
  SELECT g.sample, g.sacc, g.start, g."end", coalesce(string_agg(CAST(k.ord AS VARCHAR), ',' ORDER BY k.ord), '') AS hits
  FROM g LEFT JOIN k ON g.sample = k.sample AND g.sacc = k.sacc AND k.lo <= g.start AND k.hi >= g."end" WHERE g."end" IS NOT NULL GROUP BY ALL""")
def removed_payloads(spark, sf):
    """Segments of all hits from which the weak ones were removed, neighbours merged: as if these had never been there."""
    h = hits(spark, sf)
    out = I.segments_without(h, h.where("score < 40"), ["sample", "sacc"], "sstart", "send", "ord", "ord")
    return out.select("sample", "sacc", "start", "end", F.array_join(F.transform("payload", lambda x: x.cast("string")), ",").alias("hits"))


_AXIS = f"""{HITS_SQL}, r AS (SELECT qacc, lo, hi, max(hi) OVER (PARTITION BY qacc ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo - reach > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY qacc ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS k FROM r), b AS (SELECT qacc, k, min(lo) AS s, max(hi) AS e FROM i GROUP BY qacc, k),
  a AS (SELECT qacc, s, e, coalesce(sum(e - s + 1 + 20) OVER (PARTITION BY qacc ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS t FROM b)"""


@query(f"""WITH {_AXIS}, n AS (SELECT *, t + e - s AS u, lead(s) OVER o AS s2, lead(t) OVER o AS t2, s = min(s) OVER (PARTITION BY qacc) AS head FROM a WINDOW o AS (PARTITION BY qacc ORDER BY s)), p AS (SELECT qacc, ord, ord * 13 % 6000 AS pos, ord * 13 % 900 AS place FROM h)
  SELECT p.ord, p.pos, round(CASE WHEN pos <= x.e THEN x.t + pos - x.s WHEN x.s2 IS NULL THEN x.u + pos - x.e ELSE x.u + (pos - x.e) * CAST(x.t2 - x.u AS DOUBLE) / (x.s2 - x.e) END, 9) AS mapped,
    round(CASE WHEN place <= y.u THEN y.s + place - y.t WHEN y.s2 IS NULL THEN y.e + place - y.u ELSE y.e + (place - y.u) * CAST(y.s2 - y.e AS DOUBLE) / (y.t2 - y.u) END, 9) AS inverse
  FROM p JOIN n x ON x.qacc = p.qacc AND (x.s <= pos OR x.head) AND (x.s2 IS NULL OR pos < x.s2) JOIN n y ON y.qacc = p.qacc AND (y.t <= place OR y.head) AND (y.t2 IS NULL OR place < y.t2)""")
def axis_both_ways(spark, sf):
    """Positions on the compressed axis of each query, those in gaps and outside too, and back from it."""
    h = hits(spark, sf)
    axis = written(I.compressed_axis(h.select("qacc", F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end")), ["qacc"], 20, merge_gap=50))
    points = h.select("qacc", "ord", (F.col("ord") * 13 % 6000).alias("pos"), (F.col("ord") * 13 % 900).alias("place"))
    there = I.to_axis(points, axis, ["qacc"], "pos")
    both = I.to_axis(there.withColumnRenamed("mapped", "there"), axis, ["qacc"], "place", back=True)
    return both.select("ord", "pos", F.round("there", 9).alias("mapped"), F.round("mapped", 9).alias("inverse"))


@query(f"""WITH RECURSIVE {HITS_SQL}, r AS (SELECT sample, sacc, ord, lo, hi, row_number() OVER (PARTITION BY sample, sacc ORDER BY lo, hi, ord) AS k FROM h),
  s AS (SELECT DISTINCT sample, sacc, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS ord, CAST(0 AS BIGINT) AS lane, CAST([] AS BIGINT[]) AS ends FROM h
    UNION ALL SELECT sample, sacc, k, ord, lane, list_concat(list_concat(ends[:lane - 1], [hi]), ends[lane + 1:]) FROM (
      SELECT s.sample, s.sacc, r.k, r.ord, r.hi, s.ends, coalesce(nullif(list_position(list_transform(s.ends, lambda x: x < r.lo), true), 0), len(s.ends) + 1) AS lane FROM s JOIN r ON r.sample = s.sample AND r.sacc = s.sacc AND r.k = s.k + 1))
  SELECT sample, sacc, ord, CAST(lane AS INTEGER) AS lane FROM s WHERE k > 0""")
def lanes(spark, sf):
    """Hits of each subject packed into lanes, first fit."""
    h = hits(spark, sf).select("sample", "sacc", "ord", F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end"))
    return I.pack_lanes(h, ["sample", "sacc"], ["start", "end", "ord"]).select("sample", "sacc", "ord", "lane")


@query(f"WITH {HITS_SQL}, o AS (SELECT *, max(hi) OVER (PARTITION BY sample, sacc ORDER BY lo, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h) SELECT ord, CAST(sum(CASE WHEN reach - lo + 1 <= 5 THEN 0 ELSE 1 END) OVER (PARTITION BY sample, sacc ORDER BY lo, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chain FROM o")
def build_chains(spark, sf):
    return chains.build_chains(hits(spark, sf), max_overlap=5).select("ord", "chain")


@query(f"WITH {HITS_SQL}, s AS (SELECT sample, sacc FROM h GROUP BY ALL HAVING max(score) >= 100) SELECT h.sample, h.sacc, h.qacc, h.qlen, h.pident, h.bitscore, h.qstart, h.qend, h.sstart, h.send FROM h JOIN s ON h.sample = s.sample AND h.sacc = s.sacc WHERE h.qacc NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def hits_of_chains(spark, sf):
    """Detail rows of selected chains, without the queries that were used."""
    h = hits(spark, sf)
    chosen = h.groupBy("sample", "sacc").agg(F.max("score").alias("m")).where("m >= 100")
    used = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("qacc"))
    return chains.chain_hits(chosen, chains.without_queries(h, used, ("qacc",)))


@query("SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'HRV' WHEN 1 THEN 'HRV' WHEN 2 THEN 'RSV' WHEN 3 THEN 'EV' WHEN 4 THEN 'Influenza' ELSE 'HRV' END AS virus, CASE p_size % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'A' WHEN 2 THEN NULL WHEN 3 THEN 'D68' WHEN 4 THEN 'A' ELSE 'B' END AS strain FROM part")
def virus_names(spark, sf):
    """Names by the nine steps, cut to virus and strain."""
    n = F.col("p_size") % 6
    names = F.when(n == 0, F.concat(F.lit("Human rhinovirus C"), F.col("p_partkey"))).when(n == 1, "rhinovirus 1B").when(n == 2, "Human orthopneumovirus").when(n == 3, "Human enterovirus D68/x").when(n == 4, "Influenza A virus (A/1)").otherwise("rhinovirus sp. virus")
    meta = table(spark, sf, "part").select(F.lit("a").alias("study"), F.col("p_partkey").alias("sample"), F.lit("u").alias("unit"))
    calls = table(spark, sf, "part").select(F.lit("a").alias("study"), F.col("p_partkey").alias("sample"), F.lit("u").alias("unit"), names.alias("taxname"))
    return E.calls_of_samples(meta, calls).select(F.col("sample").alias("p_partkey"), "virus", "strain")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status, CAST(o_orderkey % 77 AS VARCHAR) AS contig, 'Some name ' || o_custkey AS species, CAST(o_orderkey % 50 * 3600 + 61 AS DOUBLE) AS seconds, 't' || o_orderkey AS title, round_even(o_totalprice / 8, 0) AS e FROM orders")
def names_and_clocks(spark, sf):
    """Values renamed, contig numbers, species of paths, clock times, texts of XML, whole columns rounded half to even."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    xml = F.concat(F.lit("<a><b x='1'><t>t"), k, F.lit("</t></b><b x='2'><t>no</t></b></a>"))
    out = o.select(
        C.contig_number(F.concat(F.lit("NODE_"), k % 77, F.lit("_length_9"))).alias("contig"), "o_orderkey", C.recode_values(F.col("o_orderstatus"), {"F": "done", "O": "open"}).alias("status"),
        C.species_of_path(F.concat(F.lit("/data/Some_name_"), "o_custkey", F.lit(".fasta.gz"))).alias("species"), C.clock_seconds(F.concat(k % 50, F.lit(":01:01"))).alias("seconds"), F.get(C.xml_text(xml, "a/b[@x='1']/t"), 0).alias("title"),
        (F.col("o_totalprice") / 8).alias("e"),
    )
    return R.relocated(R.rounded(out, ("e",)), ["status"], after="o_orderkey")


@query(f"WITH {HITS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY sacc, qacc ORDER BY qstart, sstart) AS r FROM h), c AS (SELECT sacc, qacc, (sstart + send) / 2.0 - (qstart + qend) / 2.0 + 1 AS cstart, (sstart + send) / 2.0 - (qstart + qend) / 2.0 + 1 + qlen AS cend FROM r WHERE r = 1) SELECT h.ord, c.cstart, c.cend FROM h LEFT JOIN c ON h.sacc = c.sacc AND h.qacc = c.qacc")
def placed_contigs(spark, sf):
    return R.placed(hits(spark, sf)).select("ord", "cstart", "cend")


@query("SELECT c_custkey AS sample, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 = 0 THEN '/f/' || c_custkey END AS path FROM customer")
def run_meta_and_paths(spark, sf):
    """Samples with the scalars of their runs, and with the paths of their files by id and mate."""
    c = table(spark, sf, "customer")
    meta = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("sample"), F.col("c_name").alias("name"))
    paths = c.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("id"), F.lit("R1").alias("mate"), F.concat(F.lit("/f/"), "c_custkey").alias("path"))
    rows = E.with_run_meta(c.select(F.col("c_custkey").alias("sample")), meta).withColumn("id", F.col("sample")).withColumn("mate", F.lit("R1"))
    return E.with_fastq_paths(rows, paths).select("sample", "name", "path")


# ---- plans


@query("""WITH q AS (SELECT 'Q' || p_partkey || '.1' AS acc, repeat('ACGT', p_size) || repeat('n', p_partkey % 5) AS seq, p_size * 4 AS bp FROM part), k AS (SELECT CASE WHEN bp < 60 THEN acc || '_partial' ELSE acc END AS acc, seq FROM q WHERE length(seq) - bp <= 3),
  r AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'Q' ELSE 'R' END || p_partkey || '.9' AS acc, 'ACGT' AS seq FROM part) SELECT acc, length(seq) AS n FROM k UNION ALL SELECT acc, length(seq) FROM r WHERE split_part(acc, '.', 1) NOT IN (SELECT split_part(acc, '.', 1) FROM k)""")
def prepare_phylo(spark, sf):
    """Queries of enough certain bases, short ones marked, and references that aren't there yet."""
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    q = p.select(F.concat(F.lit("Q"), k, F.lit(".1_pilon")).alias("acc"), F.concat(F.repeat(F.lit("ACGT"), F.col("p_size").cast("int")), F.repeat(F.lit("n"), (k % 5).cast("int"))).alias("seq"))
    r = p.select(F.concat(F.when(k % 2 == 0, "Q").otherwise("R"), k, F.lit(".9")).alias("acc"), F.lit("ACGT").alias("seq"))
    taken, _ = commands.prepare_phylo(q, r, min_bp=60, max_ambiguous=3, include_short=True)
    return taken.select("acc", F.length("seq").cast("long").alias("n"))


@query("SELECT 'a' || p_partkey AS acc, CASE WHEN p_size > 25 THEN 'CDS' ELSE 'gene' END AS typ, 'product' AS key FROM part WHERE p_size > 25 UNION ALL SELECT 'b' || p_partkey, 'gene', 'note' FROM part")
def select_features(spark, sf):
    p = table(spark, sf, "part")
    f = p.select(F.concat(F.lit("a"), "p_partkey").alias("acc"), F.when(F.col("p_size") > 25, "CDS").otherwise("gene").alias("typ"), F.lit("product").alias("key"))
    f = f.unionByName(p.select(F.concat(F.lit("b"), "p_partkey").alias("acc"), F.lit("gene").alias("typ"), F.lit("note").alias("key")))
    return readers.select_features(f, ["CDS/*", "*/note"])


@query("SELECT p_partkey FROM part WHERE p_size % 10 = 3 AND p_retailprice BETWEEN 1000 * (1 - 0.2) AND 1000 * (1 + 0.2)")
def genomes_of_a_size(spark, sf):
    g = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 10).alias("taxid"), F.col("p_retailprice").alias("length"))
    return commands.download_candidates(g, 3, 1000.0).select("p_partkey")


@query(f"""WITH {TREE_SQL}, up AS (SELECT tax_id, unnest(path) AS node FROM paths UNION ALL SELECT n_nationkey + 100, unnest([1, n_regionkey + 10, n_nationkey + 100]) FROM nation),
  g AS (SELECT 's' || s_suppkey AS acc, s_suppkey AS ord, s_suppkey + 1000 AS taxid, s_acctbal AS length, s_suppkey % 6 = 0 AS ref FROM supplier UNION ALL SELECT 'c' || c_custkey, 1000000 + c_custkey, c_nationkey + 100, c_acctbal, c_nationkey % 4 = 1 AND c_custkey % 3 = 0 FROM customer),
  a AS (SELECT acc, ord, length, ref, node FROM g JOIN up ON taxid = tax_id), t AS (SELECT tax_id, CASE WHEN tax_id % 5 > 0 THEN 3000.0 + tax_id * 10 END AS size, rank, parent_id FROM nodes WHERE rank IN ('genus', 'species')),
  f AS (SELECT node, arg_min(acc, ord) AS acc FROM a WHERE ref GROUP BY node)
  SELECT t.tax_id AS taxid, node AS source, acc FROM t JOIN a ON node = t.tax_id WHERE length BETWEEN coalesce(size * 0.8, 500) AND coalesce(size * 1.2, 50000)
  UNION ALL SELECT t.tax_id, f.node, f.acc FROM t JOIN nodes n ON n.parent_id = t.parent_id AND n.rank = t.rank AND n.tax_id <> t.tax_id JOIN f ON f.node = n.tax_id""")
def genomes_and_outgroups(spark, sf):
    """Genomes of every genus and species, and the first reference genome of each of its siblings."""
    c, s_ = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nodes = taxon_nodes(spark, sf)
    g = s_.select(F.concat(F.lit("s"), "s_suppkey").alias("acc"), F.col("s_suppkey").cast("long").alias("ord"), (F.col("s_suppkey") + 1000).cast("long").alias("taxid"), F.col("s_acctbal").alias("length"), (F.col("s_suppkey") % 6 == 0).alias("reference"))
    own = (F.col("c_nationkey") % 4 == 1) & (F.col("c_custkey") % 3 == 0)
    g = g.unionByName(c.select(F.concat(F.lit("c"), "c_custkey").alias("acc"), (F.col("c_custkey") + 1000000).cast("long").alias("ord"), (F.col("c_nationkey") + 100).cast("long").alias("taxid"), F.col("c_acctbal").alias("length"), own.alias("reference")))
    taxa = nodes.where("rank in ('genus', 'species')").select(F.col("tax_id").alias("taxid"), F.when(F.col("tax_id") % 5 > 0, 3000.0 + F.col("tax_id") * 10).alias("size"))
    return commands.genome_sets(g, nodes, T.lineage(nodes), taxa, outgroup="yes")


@query("WITH r AS (SELECT l_partkey AS chrom, l_linenumber AS pos, l_returnflag AS strand, l_suppkey % 3 AS umi FROM lineitem) SELECT chrom, pos, strand, CAST(umi AS VARCHAR) AS umi FROM r GROUP BY ALL")
def umi_dedup(spark, sf):
    """One read for each position, strand and UMI of the id."""
    r = table(spark, sf, "lineitem").select(F.concat(F.lit("read"), "l_orderkey", F.lit("_UMI:"), F.col("l_suppkey") % 3).alias("read_id"), F.col("l_partkey").alias("chrom"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("strand"))
    return commands.umi_dedup(r, r"_UMI:(\w+)$").select("chrom", "pos", "strand", "umi")


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey & 5) = 5 AND o_orderkey % 1000 + 1 BETWEEN 100 AND 700")
def flags_and_junctions(spark, sf):
    """Alignments with all of some flag bits, junctions of a range of lengths."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("flag"), F.lit(10).alias("start"), (F.col("o_orderkey") % 1000 + 10).alias("end"))
    return commands.junctions(commands.flagged(o, 5), 100, 700).select("o_orderkey")
