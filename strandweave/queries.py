"""Queries of the driver contract over the library's operators, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as C
from .functions import sequence as S
from .functions import tables
from .operators import chains, expression, hits as H, intervals, report, scaffold, taxonomy
from .plans import commands
from .sources import readers, writers
from .views import HITS_SQL, SEQ_SQL, TREE_SQL, hits, sequences, table, taxon_nodes

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


UNION = "sum(greatest(0, hi - greatest(lo, coalesce(reach + 1, lo)) + 1))"
REACH = "max(hi) OVER (PARTITION BY {0} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach"


# ---- chains and intervals


@query(f"""WITH {HITS_SQL}, c AS (SELECT qacc, sacc, sum(score) - 20 * (count(*) - 1) AS score, count(*) AS n, min(ord) AS ord, max(qlen) AS qlen FROM h GROUP BY qacc, sacc),
  u AS (SELECT qacc, sacc, CAST({UNION} AS BIGINT) AS slen FROM (SELECT *, {REACH.format("qacc, sacc")} FROM h) GROUP BY qacc, sacc),
  r AS (SELECT *, row_number() OVER (PARTITION BY qacc ORDER BY score DESC, ord) AS r FROM c JOIN u USING (qacc, sacc))
  SELECT qacc, sacc, qlen, slen, n, score FROM r WHERE r = 1""")
def best_chain_per_query(spark, sf):
    return chains.best_chain_per_query(hits(spark, sf))


@query(f"""WITH {HITS_SQL}, c AS (SELECT qacc, sacc, sum(score) - 20 * (count(*) - 1) AS score, count(*) AS n, min(ord) AS ord FROM h GROUP BY qacc, sacc),
  u AS (SELECT qacc, sacc, CAST({UNION} AS BIGINT) AS slen FROM (SELECT *, {REACH.format("qacc, sacc")} FROM h) GROUP BY qacc, sacc),
  r AS (SELECT *, row_number() OVER (PARTITION BY qacc ORDER BY score DESC, ord) AS r FROM c JOIN u USING (qacc, sacc))
  SELECT o_orderkey AS acc FROM orders WHERE o_orderkey NOT IN (SELECT qacc FROM r WHERE r = 1 AND slen >= 150) """)
def filter_blast(spark, sf):
    contigs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("acc"))
    return commands.filter_blast(hits(spark, sf), contigs, max_aligned=150)


_SEG = f"""{HITS_SQL}, p AS (SELECT DISTINCT sample, sacc, unnest([lo, hi + 1]) AS s FROM h),
  g AS (SELECT sample, sacc, s AS start, lead(s) OVER (PARTITION BY sample, sacc ORDER BY s) - 1 AS "end" FROM p)"""


@query(f"""WITH {_SEG} SELECT g.sample, g.sacc, g.start, g."end", count(h.ord) AS n, coalesce(string_agg(CAST(h.qacc AS VARCHAR), ',' ORDER BY h.ord), '') AS queries
  FROM g LEFT JOIN h ON g.sample = h.sample AND g.sacc = h.sacc AND h.lo <= g.start AND h.hi >= g."end" WHERE g."end" IS NOT NULL GROUP BY ALL""")
def region_segments(spark, sf):
    seg = intervals.segments(hits(spark, sf), ["sample", "sacc"], "sstart", "send", "qacc", "ord")
    return seg.select("sample", "sacc", "start", "end", F.size("payload").cast("long").alias("n"), F.array_join(F.col("payload").cast("array<string>"), ",").alias("queries"))


@query(f"WITH {HITS_SQL} SELECT sample, sacc, CAST({UNION} AS BIGINT) AS slen FROM (SELECT *, {REACH.format('sample, sacc')} FROM h) GROUP BY sample, sacc")
def union_length(spark, sf):
    return intervals.union_length(hits(spark, sf), ["sample", "sacc"], "sstart", "send", "slen")


@query(f"""WITH {_SEG}, v AS (SELECT g.sample, g.sacc, g.start, g."end", max(h.pident) AS m FROM g JOIN h ON g.sample = h.sample AND g.sacc = h.sacc AND h.lo <= g.start AND h.hi >= g."end" GROUP BY ALL)
  SELECT sample, sacc, round(sum(("end" - start + 1) * m) / sum("end" - start + 1), 3) AS pident FROM v GROUP BY sample, sacc""")
def weighted_identity(spark, sf):
    return intervals.weighted_over_segments(hits(spark, sf), ["sample", "sacc"], "sstart", "send", "pident", digits=3, name="pident")


@query(f"""WITH {HITS_SQL}, r AS (SELECT sample, sacc, lo, hi, {REACH.format("sample, sacc")} FROM h),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo - reach - 1 >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY sample, sacc ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS k FROM r)
  SELECT sample, sacc, min(lo) AS start, max(hi) AS "end", count(*) AS n FROM i GROUP BY sample, sacc, k""")
def merge_intervals_gap(spark, sf):
    return intervals.merged(hits(spark, sf), ["sample", "sacc"], "sstart", "send", min_gap=5)


@query(f"""WITH {HITS_SQL}, f AS (SELECT p_partkey % 7 AS sacc, p_partkey * 13 % 4800 + 1 AS fs, p_partkey * 13 % 4800 + p_size * 3 AS fe, p_partkey AS feature FROM part)
  SELECT h.sacc, h.ord, f.feature, greatest(h.lo, f.fs) AS start, least(h.hi, f.fe) AS "end" FROM h JOIN f ON h.sacc = f.sacc AND h.lo <= f.fe AND f.fs <= h.hi""")
def interval_overlap_join(spark, sf):
    a = hits(spark, sf).select("sacc", "ord", F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end"))
    b = table(spark, sf, "part").select((F.col("p_partkey") % 7).alias("sacc"), F.col("p_partkey").alias("feature"), (F.col("p_partkey") * 13 % 4800 + 1).alias("start"), (F.col("p_partkey") * 13 % 4800 + F.col("p_size") * 3).alias("end"))
    return intervals.overlap_join(a, b, ["sacc"], bin_width=500).select("sacc", F.col("a_ord").alias("ord"), F.col("b_feature").alias("feature"), "start", "end")


@query(f"""WITH {HITS_SQL}, q AS (SELECT sample, sacc, qacc, arg_min(qlen, ord) AS qlen, sum(score) AS s, count(*) AS n FROM h GROUP BY ALL),
  m AS (SELECT sample, sacc, CAST(sum(qlen) AS BIGINT) AS qlen, sum(s) - 20 * (sum(n) - 1) AS raw_score, CAST(sum(n) AS INTEGER) AS n_frag FROM q GROUP BY ALL),
  u AS (SELECT sample, sacc, CAST({UNION} AS BIGINT) AS slen FROM (SELECT *, {REACH.format("sample, sacc")} FROM h) GROUP BY ALL),
  qu AS (SELECT sample, sacc, sum(c) AS c FROM (SELECT sample, sacc, qacc, sum(greatest(0, qend - greatest(qstart, coalesce(reach + 1, qstart)) + 1)) AS c
    FROM (SELECT *, max(qend) OVER (PARTITION BY sample, sacc, qacc ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h) GROUP BY ALL) GROUP BY ALL)
  SELECT sample, sacc, qlen, n_frag, slen, raw_score, round(c * 100.0 / qlen, 1) AS contig_coverage,
    round((raw_score * -0.625 + ln(0.41) + ln(1004024614.0) + ln(CAST(qlen AS DOUBLE))) / ln(10.0), 2) AS log_evalue FROM m JOIN u USING (sample, sacc) JOIN qu USING (sample, sacc)""")
def chain_metrics(spark, sf):
    return chains.chain_metrics(hits(spark, sf)).select("sample", "sacc", "qlen", "n_frag", "slen", "raw_score", "contig_coverage", "log_evalue")


#: Greedy selection one chain after the other: `step` has the selected chain of each step and the queries used up to it,
#: `m` the measures of all chains that are left at a step. Over `hh`, the hits, with log e-values as in chain_metrics.
GREEDY_SQL = f"""
  e AS (SELECT sample, sacc, qacc, arg_min(qlen, ord) AS qlen, sum(score) AS s, count(*) AS n, min(first) AS first FROM hh GROUP BY sample, sacc, qacc),
  step AS (
    SELECT DISTINCT sample, CAST(-1 AS INTEGER) AS bin, CAST(NULL AS BIGINT) AS best, CAST([] AS BIGINT[]) AS used FROM e
    UNION ALL SELECT sample, bin + 1, arg_min(sacc, struct_pack(ev, first)), list_concat(used, arg_min(queries, struct_pack(ev, first))) FROM (
      SELECT t.sample, t.bin, t.used, e.sacc, e.first, list(e.qacc) AS queries, round(((sum(s) - 20 * (sum(n) - 1)) * -0.625 + ln(0.41) + ln(1004024614.0) + ln(CAST(sum(e.qlen) AS DOUBLE))) / ln(10.0), 2) AS ev
      FROM step t JOIN e ON e.sample = t.sample AND NOT list_contains(t.used, e.qacc) GROUP BY t.sample, t.bin, t.used, e.sacc, e.first) GROUP BY sample, bin, used),
  st AS (SELECT a.sample, a.bin, a.best, b.used, a.used[len(b.used) + 1:] AS own FROM step a JOIN step b ON a.sample = b.sample AND b.bin = a.bin - 1),
  lh AS (SELECT st.bin, st.best, own, hh.*, max(hi) OVER (PARTITION BY hh.sample, st.bin, hh.sacc ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
    FROM st JOIN hh ON hh.sample = st.sample AND NOT list_contains(st.used, hh.qacc)),
  lq AS (SELECT sample, bin, best, sacc, qacc, bool_or(list_contains(own, qacc)) AS mine, arg_min(qlen, ord) AS qlen, sum(score) AS s, count(*) AS n, min(first) AS first FROM lh GROUP BY ALL),
  lc AS (SELECT sample, bin, sacc, CAST({UNION} AS INTEGER) AS slen FROM lh GROUP BY ALL),
  m AS (SELECT sample, bin, best, sacc, sum(qlen) AS qlen, CAST(sum(n) AS INTEGER) AS n_hits, CAST(count(*) AS INTEGER) AS n_queries, count(*) FILTER (mine) AS shared, any_value(slen) AS slen, min(first) AS first,
    round(((sum(s) - 20 * (sum(n) - 1)) * -0.625 + ln(0.41) + ln(1004024614.0) + ln(CAST(sum(qlen) AS DOUBLE))) / ln(10.0), 2) AS ev FROM lq JOIN lc USING (sample, bin, sacc) GROUP BY ALL),
  members AS (SELECT a.sample, a.bin, CASE WHEN a.sacc = a.best THEN 0 ELSE CAST(row_number() OVER (PARTITION BY a.sample, a.bin, a.sacc = a.best ORDER BY a.ev, a.first) AS INTEGER) END AS position, a.sacc, a.sacc = a.best AS representative
    FROM m a JOIN m b ON a.sample = b.sample AND a.bin = b.bin AND b.sacc = b.best
    WHERE a.sacc = a.best OR (-a.ev > 0.9 * -b.ev AND a.ev < CAST(0.9 AS DOUBLE) * b.ev AND a.slen > 0.9 * b.slen AND a.qlen > 0.9 * b.qlen AND a.shared * 10 > b.n_queries))"""


@query(f"""WITH RECURSIVE {HITS_SQL}, hh AS (SELECT *, min(ord) OVER (PARTITION BY sample, sacc) AS first FROM h), {GREEDY_SQL}
  SELECT g.*, coalesce(n_hits, 0) AS n_hits, coalesce(n_queries, 0) AS n_queries, coalesce(slen, 0) AS slen, coalesce(ev, 0.0) AS log_evalue FROM members g LEFT JOIN m ON m.sample = g.sample AND m.sacc = g.sacc AND m.sacc = m.best""")
def greedy_bins(spark, sf):
    return chains.greedy_select(hits(spark, sf))


# ---- hit filters


@query(f"""WITH {HITS_SQL}, l AS (SELECT qacc, ord, sacc, CASE WHEN lag(sacc) OVER (PARTITION BY qacc ORDER BY ord) = sacc THEN 0 ELSE 1 END AS new FROM h)
  SELECT qacc, ord, sacc, CAST(sum(new) OVER (PARTITION BY qacc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l""")
def run_islands(spark, sf):
    return H.islands(hits(spark, sf), ["qacc"]).select("qacc", "ord", "sacc", "island")


@query(f"""WITH {HITS_SQL}, l AS (SELECT *, CASE WHEN lag(sacc) OVER (PARTITION BY qacc ORDER BY ord) = sacc THEN 0 ELSE 1 END AS new FROM h),
  i AS (SELECT *, sum(new) OVER (PARTITION BY qacc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM l),
  a AS (SELECT qacc, island, sum(score) AS s, avg(pident) AS p FROM i GROUP BY ALL), b AS (SELECT qacc, s AS s0, p AS p0 FROM a WHERE island = 1)
  SELECT i.qacc, i.ord FROM i JOIN a ON i.qacc = a.qacc AND i.island = a.island JOIN b ON i.qacc = b.qacc WHERE s > s0 * 0.9 AND p > 100 - (100 - p0) * 1.5 - 0.5""")
def relative_score_prefilter(spark, sf):
    return H.relative_score_prefilter(hits(spark, sf), keys=["qacc"]).select("qacc", "ord")


@query(f"""WITH {HITS_SQL}, t AS (SELECT *, bitscore > 0.9 * max(bitscore) OVER (PARTITION BY qacc) AS top FROM h),
  n AS (SELECT *, sum(CASE WHEN top AND keep THEN 1 ELSE 0 END) OVER (PARTITION BY qacc) AS k, sum(CASE WHEN top THEN 1 ELSE 0 END) OVER (PARTITION BY qacc) AS a FROM t)
  SELECT qacc, ord FROM n WHERE k * 2 >= a AND keep""")
def majority_prefilter(spark, sf):
    return H.majority_prefilter(hits(spark, sf), keys=["qacc"]).select("qacc", "ord")


_RULES = "CASE WHEN NOT coalesce(qlen >= 200, false) THEN 'min_bp' WHEN NOT coalesce(score >= 20, false) THEN 'min_score' WHEN NOT coalesce(pident >= 94, false) THEN 'min_pident' END"


@query(f"""WITH {HITS_SQL}, f AS (SELECT {_RULES} AS rule FROM h), n AS (SELECT * FROM (VALUES (0, 'min_bp'), (1, 'min_score'), (2, 'min_pident')) v(step, rule))
  SELECT n.step, n.rule, count(f.rule) AS removed FROM n LEFT JOIN f ON n.rule = f.rule GROUP BY ALL""")
def threshold_cascade(spark, sf):
    rules = [("min_bp", F.col("qlen") >= 200), ("min_score", F.col("score") >= 20), ("min_pident", F.col("pident") >= 94)]
    return report.threshold_cascade(hits(spark, sf), rules)[1]


@query(f"WITH {HITS_SQL} SELECT count(*) AS n, CAST(sum(ord) AS BIGINT) AS ords FROM h WHERE qacc IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def semi_reads(spark, sf):
    reads = hits(spark, sf).withColumnRenamed("qacc", "read_id")
    ids = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("read_id"))
    return commands.reads_in(reads, ids).agg(F.count("*").alias("n"), F.sum("ord").alias("ords"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def anti_blacklist(spark, sf):
    black = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return report.host_table(table(spark, sf, "customer"), black).select("c_custkey", "c_name")


# ---- taxonomy


@query(f"WITH {TREE_SQL} SELECT tax_id, lineage FROM paths")
def lineage_paths(spark, sf):
    lin = taxonomy.lineage(taxon_nodes(spark, sf))
    return lin.where("rank = 'species'").select("tax_id", F.array_join("names", "; ").alias("lineage"))


@query(f"WITH {TREE_SQL} SELECT tax_id, 3 AS depth, lineage FROM paths")
def lineage_recursive(spark, sf):
    return taxonomy.lineage_recursive(taxon_nodes(spark, sf)).where("depth = 3")


@query(f"WITH {TREE_SQL}, n AS (SELECT tax_id, parent_id FROM nodes) SELECT tax_id FROM n WHERE tax_id = 11 OR parent_id = 11 UNION SELECT c.tax_id FROM n c JOIN n p ON c.parent_id = p.tax_id WHERE p.parent_id = 11")
def subtree_filter(spark, sf):
    return taxonomy.subtree(taxonomy.lineage(taxon_nodes(spark, sf)), [11])


@query(f"WITH {TREE_SQL} SELECT tax_id, name FROM nodes WHERE rank = 'genus' AND parent_id = (SELECT parent_id FROM nodes WHERE tax_id = 105) AND tax_id <> 105")
def siblings(spark, sf):
    nodes = taxon_nodes(spark, sf)
    return taxonomy.siblings(nodes, nodes, 105).select("tax_id", "name")


@query("SELECT s_suppkey + 1000 AS tax_id, n_name AS genus, s_name AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def rank_lookup(spark, sf):
    lin = taxonomy.lineage(taxon_nodes(spark, sf)).where("rank = 'species'")
    return lin.select("tax_id", taxonomy.rank_name("genus").alias("genus"), taxonomy.rank_name("species").alias("species"))


@query(f"""WITH {HITS_SQL}, {TREE_SQL}, a AS (SELECT DISTINCT qacc, path FROM h JOIN paths ON h.taxid = paths.tax_id),
  r AS (SELECT h.qacc, h.bitscore AS w, generate_subscripts(p.path, 1) - 1 AS depth, unnest(p.path) AS node, h.ord FROM h JOIN paths p ON h.taxid = p.tax_id),
  n AS (SELECT qacc, depth, node, sum(w) AS w, min(ord) AS first FROM r GROUP BY ALL),
  d AS (SELECT qacc, depth, sum(w) AS tot, max(w) AS top FROM n GROUP BY ALL), t AS (SELECT qacc, max(tot) AS total FROM d GROUP BY ALL),
  g AS (SELECT d.* FROM d JOIN t USING (qacc) WHERE tot >= total * 0.9 - 1e-9 AND top >= tot * 0.6 - 1e-9),
  m AS (SELECT qacc, max(depth) AS depth FROM g GROUP BY ALL)
  SELECT n.qacc, arg_min(n.node, n.first) AS taxid, round(max(g.top / g.tot), 6) AS score FROM m JOIN g USING (qacc, depth) JOIN n USING (qacc, depth) WHERE n.w >= g.top - 1e-9 GROUP BY n.qacc""")
def quorum_lca(spark, sf):
    lin = taxonomy.lineage(taxon_nodes(spark, sf))
    out = taxonomy.quorum_lca(hits(spark, sf), lin, ["qacc"], "taxid", weight=F.col("bitscore"), order=F.col("ord"), majority=0.6)
    return out.select("qacc", "taxid", F.round("score", 6).alias("score"))


@query(f"""WITH {HITS_SQL}, {TREE_SQL}, k AS (SELECT tax_id, [CAST(1 AS BIGINT)] AS path FROM nodes WHERE tax_id = 1 UNION ALL SELECT tax_id, [1, tax_id] FROM nodes WHERE rank = 'phylum' UNION ALL SELECT tax_id, [1, parent_id, tax_id] FROM nodes WHERE rank = 'genus' UNION ALL SELECT tax_id, path FROM paths),
  r AS (SELECT h.qacc, h.bitscore AS w, generate_subscripts(k.path, 1) - 1 AS depth, unnest(k.path) AS node, h.ord FROM h JOIN k ON h.taxid = k.tax_id),
  n AS (SELECT qacc, depth, node, sum(w) AS w, min(ord) AS first FROM r GROUP BY ALL),
  d AS (SELECT qacc, depth, sum(w) AS tot, max(w) AS top FROM n GROUP BY ALL), t AS (SELECT qacc, max(tot) AS total FROM d GROUP BY ALL),
  g AS (SELECT d.* FROM d JOIN t USING (qacc) WHERE tot >= total * 0.9 - 1e-9 AND top >= tot * 0.9 - 1e-9), m AS (SELECT qacc, max(depth) AS depth FROM g GROUP BY ALL),
  a AS (SELECT n.qacc, arg_min(n.node, n.first) AS taxid, max(g.top / g.tot) AS score FROM m JOIN g USING (qacc, depth) JOIN n USING (qacc, depth) WHERE n.w >= g.top - 1e-9 GROUP BY n.qacc),
  names AS (SELECT k.tax_id, string_agg(o.name, '; ' ORDER BY i) AS lineage, string_agg(o.rank, '; ' ORDER BY i) AS ranks, max(CASE WHEN o.rank = 'genus' THEN o.name END) AS genus
    FROM (SELECT tax_id, generate_subscripts(path, 1) AS i, unnest(path) AS node FROM k) k JOIN nodes o ON k.node = o.tax_id WHERE k.node <> 1 GROUP BY k.tax_id)
  SELECT a.qacc, round(a.score, 3) AS score, x.name AS taxname, coalesce(names.genus, 'Unknown') AS genus, coalesce(names.lineage, '') AS lineage, coalesce(names.ranks, '') AS ranks FROM a JOIN nodes x ON a.taxid = x.tax_id LEFT JOIN names ON a.taxid = names.tax_id""")
def blast_classify(spark, sf):
    return commands.blast_classify(hits(spark, sf), taxonomy.lineage(taxon_nodes(spark, sf)))


@query(f"""WITH {TREE_SQL}, t AS (SELECT r_name || '; ' || n_name AS prefix, n_name AS host FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0),
  u AS (SELECT r_name AS prefix, r_name AS host FROM region), q AS (SELECT DISTINCT lineage FROM paths),
  x AS (SELECT q.lineage, t.host FROM q JOIN t ON starts_with(q.lineage, t.prefix || '; ')),
  y AS (SELECT q.lineage, a.host FROM q JOIN (SELECT prefix, host, split_part(prefix, '; ', 1) AS top FROM t UNION ALL SELECT prefix, host, prefix FROM u) a ON split_part(q.lineage, '; ', 1) = a.top WHERE q.lineage NOT IN (SELECT lineage FROM x))
  SELECT lineage, host FROM x UNION ALL SELECT lineage, host FROM y""")
def prefix_lookup(spark, sf):
    lin = taxonomy.lineage(taxon_nodes(spark, sf))
    q = lin.where("rank = 'species'").select(F.array_join("names", "; ").alias("lineage"))
    t = lin.where("rank = 'phylum' or (rank = 'genus' and tax_id % 2 = 0)").select(F.array_join("names", "; ").alias("known"), F.col("name").alias("host"))
    return taxonomy.longest_prefix(q, t, "lineage", "known").select("lineage", "host")


# ---- report


def _calls(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    return rows.select(
        F.concat(F.lit("s"), k % 40).alias("sample"), F.col("n_name").alias("species"), (k % 1000 + 1).alias("numreads"), F.concat_ws(" ", F.lit("Influenza"), "c_mktsegment").alias("taxname"),
        k.alias("sacc"), F.floor("o_totalprice").cast("long").alias("bp"), (k % 300 / 10.0 + 70).alias("pident"), (k % 900 + 100).alias("slen"), (k % 120 / 8.0).alias("pcthp"), (k % 17 / 16.0).alias("entropy"),
        (k % 101).alias("genome_coverage"), (k % 5 + 1).cast("int").alias("n_frag"), (-(k % 500) / 4.0).alias("log_evalue"), F.concat_ws(";", k % 7 + 8, k % 3 + 9).alias("staxids"), (F.col("o_custkey") % 11 + 5).alias("taxid"),
        F.concat_ws("; ", F.lit("Viruses"), "n_name").alias("lineage"),
    )


_CALLS = """c AS (SELECT 's' || (o_orderkey % 40) AS sample, n_name AS species, o_orderkey % 1000 + 1 AS numreads, 'Influenza ' || c_mktsegment AS taxname, o_orderkey AS sacc,
  CAST(floor(o_totalprice) AS BIGINT) AS bp, CAST(o_orderkey % 300 AS DOUBLE) / 10 + 70 AS pident, o_orderkey % 900 + 100 AS slen, CAST(o_orderkey % 120 AS DOUBLE) / 8 AS pcthp,
  CAST(o_orderkey % 17 AS DOUBLE) / 16 AS entropy, o_orderkey % 101 AS genome_coverage, CAST(o_orderkey % 5 + 1 AS INTEGER) AS n_frag, -CAST(o_orderkey % 500 AS DOUBLE) / 4 AS log_evalue,
  (o_orderkey % 7 + 8) || ';' || (o_orderkey % 3 + 9) AS staxids, o_custkey % 11 + 5 AS taxid, 'Viruses; ' || n_name AS lineage FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

#: By species: identity by subject length, homopolymer share and entropy by scaffold length, lists in the calls' order.
_MERGED = """m AS (SELECT sample, species, string_agg(DISTINCT taxname, ', ' ORDER BY taxname) AS taxnames, CAST(sum(numreads) AS BIGINT) AS numreads, max(bp) AS max_bp,
    round(sum(pident * slen) / sum(slen), 1) AS pident, round(sum(pcthp * bp) / sum(bp), 1) AS pcthp, round(sum(entropy * bp) / sum(bp), 4) AS entropy,
    string_agg(CAST(genome_coverage AS VARCHAR), ';' ORDER BY sacc) AS genome_coverages, string_agg(CAST(bp AS VARCHAR), ';' ORDER BY sacc) AS bps, string_agg(CAST(n_frag AS VARCHAR), ';' ORDER BY sacc) AS n_frags,
    min(log_evalue) AS min_log_evalue, string_agg(CAST(sacc AS VARCHAR), ';' ORDER BY sacc) AS saccs, array_to_string(list_sort(list_distinct(flatten(list(string_split(staxids, ';'))))), ', ') AS staxids,
    array_to_string(list_sort(list(DISTINCT taxid)), ', ') AS taxids, string_agg(DISTINCT lineage, ', ' ORDER BY lineage) AS lineages FROM c GROUP BY sample, species)"""


@query(f"WITH {_CALLS}, {_MERGED} SELECT * FROM m")
def merge_species(spark, sf):
    return report.merge_species(_calls(spark, sf))


def _joined(column: str, name: str, number: bool = False) -> str:
    text = f"regexp_replace(CAST({column} AS VARCHAR), '\\.0$', '')" if number else f"CAST({column} AS VARCHAR)"
    return f"string_agg({text}, ' | ' ORDER BY numreads DESC, species) AS {name}"


_LISTS = ", ".join(_joined(c, report.BY_SAMPLE[c], c in ("pident", "pcthp", "entropy", "min_log_evalue")) for c in report.BY_SAMPLE)


@query(f"WITH {_CALLS}, {_MERGED} SELECT sample, {_LISTS} FROM m GROUP BY sample")
def merge_samples(spark, sf):
    return report.merge_samples(report.merge_species(_calls(spark, sf)))


@query(f"WITH {_CALLS} SELECT sacc, taxname, regexp_matches(taxname, '(?i)(machinery|build)') AS respiratory FROM c")
def respiratory_flag(spark, sf):
    return report.flag_respiratory(_calls(spark, sf), ("Machinery", "BUILD")).select("sacc", "taxname", "respiratory")


@query(f"WITH {_CALLS} SELECT species, count(DISTINCT sample) AS n_samples, CAST(sum(numreads) AS BIGINT) AS numreads FROM c GROUP BY species")
def species_found(spark, sf):
    return report.species_found(_calls(spark, sf))


@query(f"""WITH {_CALLS}, w AS (SELECT *, CAST(sum(numreads) OVER (PARTITION BY species) AS BIGINT) AS species_reads FROM c)
  SELECT sample, species, sacc, numreads, species_reads FROM w ORDER BY species_reads DESC, numreads DESC, species, sample, sacc LIMIT 50""")
def top_calls(spark, sf):
    return report.top_calls(_calls(spark, sf), 50).select("sample", "species", "sacc", "numreads", "species_reads")


@query(f"""WITH {_CALLS}, l AS (SELECT sacc, numreads > 500 AS a, bp > 50000 AS b FROM c)
  SELECT * FROM (SELECT 0 AS step, 'all' AS description, count(*) AS count, 'A' AS tab FROM c UNION ALL SELECT 1, 'many reads', count(*) FILTER (WHERE a), 'B' FROM l UNION ALL SELECT 2, 'long', count(*) FILTER (WHERE a AND b), 'C' FROM l)""")
def summary_sheet(spark, sf):
    c = _calls(spark, sf)
    return report.summary([("all", c, "A"), ("many reads", c.where("numreads > 500"), "B"), ("long", c.where("numreads > 500 and bp > 50000"), "C")])


@query(f"WITH {HITS_SQL}, s AS (SELECT sample, sacc, sstart, send, avg(qlen - lo) AS b FROM h GROUP BY ALL) SELECT sample, sacc, round(sum(b), 3) AS bp FROM s GROUP BY ALL")
def segment_bp_dedup(spark, sf):
    s = hits(spark, sf).withColumn("bp", F.col("qlen") - F.least("sstart", "send"))
    return report.segment_bp(s).withColumn("bp", F.round("bp", 3))


@query(f"""WITH {HITS_SQL} SELECT sample, sacc, round(sum(pident / 100 * qend) / sum(qend) * 100, 1) AS pcthp, round(sum((score + bitscore) / 2 * qend) / sum(qend), 2) AS entropy FROM h GROUP BY ALL""")
def weighted_qc(spark, sf):
    q = hits(spark, sf).select("sample", "sacc", (F.col("pident") / 100).alias("frac_hp"), F.col("score").alias("entropy1"), F.col("bitscore").alias("entropy2"), F.col("qend").alias("len_used"))
    return report.weighted_qc(q)


@query("""WITH v AS (SELECT n_name AS species, r_name || '; ' || n_name AS lineage, CAST(n_nationkey AS BIGINT) AS taxid FROM nation JOIN region ON n_regionkey = r_regionkey),
  k AS (SELECT c_nationkey, c_mktsegment AS host FROM customer)
  SELECT v.species, string_agg(DISTINCT k.host, '; ' ORDER BY k.host) AS host FROM v LEFT JOIN k ON v.taxid = k.c_nationkey GROUP BY v.species""")
def hosts_by_taxid(spark, sf):
    n, r, c = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    calls = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("species"), F.concat_ws("; ", "r_name", "n_name").alias("lineage"), F.col("n_nationkey").cast("long").alias("taxid"))
    db = c.select(F.col("c_nationkey").cast("long").alias("virus_tax_id"), F.lit("none").alias("virus_lineage"), F.lit("none").alias("virus_name"), F.col("c_mktsegment").alias("host_name"), F.lit("a; b; c").alias("host_lineage"))
    return report.annotate_hosts(calls, db).select("species", "host")


@query(f"""WITH {HITS_SQL}, p AS (SELECT sacc AS contig, lo AS pos, count(*) AS plus FROM h WHERE send > sstart GROUP BY ALL), m AS (SELECT sacc AS contig, lo AS pos, count(*) AS minus FROM h WHERE send <= sstart GROUP BY ALL)
  SELECT coalesce(p.contig, m.contig) AS contig, coalesce(p.pos, m.pos) AS pos, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus FROM p FULL JOIN m ON p.contig = m.contig AND p.pos = m.pos""")
def plus_minus_full_join(spark, sf):
    d = hits(spark, sf).select(F.col("sacc").alias("contig"), F.least("sstart", "send").alias("pos"), S.is_forward(F.col("sstart"), F.col("send")).alias("fwd"))
    side = lambda f: d.where(F.col("fwd") == f).groupBy("contig", "pos").agg(F.count("*").alias("depth"))
    return report.stranded_depth(side(True), side(False))


@query(f"""WITH {HITS_SQL}, w AS (SELECT *, median(CASE WHEN sstart > send THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY sacc, qacc) > 0.5 AS flip FROM h)
  SELECT ord, flip, CASE WHEN flip THEN qlen - qend + 1 ELSE qstart END AS qstart, CASE WHEN flip THEN qlen - qstart + 1 ELSE qend END AS qend, CASE WHEN flip THEN send ELSE sstart END AS sstart, CASE WHEN flip THEN sstart ELSE send END AS send FROM w""")
def flip_median(spark, sf):
    return report.flip_contigs(hits(spark, sf)).select("ord", "flip", "qstart", "qend", "sstart", "send")


@query(f"""WITH {HITS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY sacc, qacc ORDER BY qstart, sstart) AS r FROM h)
  SELECT sacc, qacc, (sstart + send) / 2.0 - (qstart + qend) / 2.0 + 1 AS cstart FROM r WHERE r = 1""")
def contig_placement(spark, sf):
    return report.contig_placement(hits(spark, sf)).select("sacc", "qacc", "cstart")


@query(f"WITH {HITS_SQL} SELECT sample, round(avg(score), 4) AS mean, round(stddev_samp(score), 4) AS sd, max(score) AS max, round(least(max(score), avg(score) + 3 * stddev_samp(score)), 4) AS cap FROM h GROUP BY sample")
def depth_cap(spark, sf):
    d = report.depth_cap(hits(spark, sf), ["sample"], "score")
    return d.select("sample", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "max", F.round("cap", 4).alias("cap"))


# ---- sequences and texts


@query(f"WITH {SEQ_SQL} SELECT acc, length(seq) - length(translate(seq, 'ACGT', '')) AS bp FROM s")
def count_bp(spark, sf):
    return sequences(spark, sf).select("acc", S.count_bp(F.col("seq")).cast("long").alias("bp"))


@query(f"WITH {SEQ_SQL} SELECT acc, md5(reverse(translate(seq, 'ACGTn', 'TGCAn'))) AS rc FROM s")
def revcomp(spark, sf):
    return sequences(spark, sf).select("acc", F.md5(S.reverse_complement(F.col("seq"))).alias("rc"))


@query(f"WITH {SEQ_SQL} SELECT acc, md5(regexp_replace(upper(regexp_replace(seq, 'n+', '', 'g')), '[^AGCT]', 'n', 'g')) AS norm FROM s")
def normalize_seq(spark, sf):
    return sequences(spark, sf).select("acc", F.md5(S.normalize_sequence(F.col("seq"))).alias("norm"))


@query(f"WITH {SEQ_SQL} SELECT acc, round(1 - length(regexp_replace(seq, 'A{{4,}}|C{{4,}}|G{{4,}}|T{{4,}}', '', 'g')) / length(seq), 6) AS frac_hp FROM s WHERE length(seq) > 0")
def homopolymer(spark, sf):
    return sequences(spark, sf).where("length(seq) > 0").select("acc", F.round(S.homopolymer_ratio(F.col("seq"), 3), 6).alias("frac_hp"))


@query(f"""WITH {SEQ_SQL}, k AS (SELECT acc, substr(seq, CAST(i AS BIGINT), 3) AS kmer FROM (SELECT acc, seq, unnest(range(1, greatest(length(seq) - 1, 1))) AS i FROM s)), n AS (SELECT acc, kmer, count(*) AS n FROM k GROUP BY ALL),
  e AS (SELECT acc, (log2(sum(n)) - sum(n * log2(n)) / sum(n)) / 6 AS e FROM n GROUP BY acc) SELECT s.acc, round(coalesce(e.e, 0), 5) AS entropy3 FROM s LEFT JOIN e ON s.acc = e.acc""")
def kmer_entropy(spark, sf):
    return S.sequence_entropy(sequences(spark, sf), "acc", "seq", 3).withColumn("entropy3", F.round("entropy3", 5))


_KS = (1, 2, 3, 4, 6, 10)


def _entropy_sql(k: int) -> str:
    return f"""e{k} AS (SELECT acc, (log2(sum(n)) - sum(n * log2(n)) / sum(n)) / {2 * k} AS e FROM (SELECT acc, substr(used, CAST(i AS BIGINT), {k}) AS w, count(*) AS n FROM (SELECT acc, used, unnest(range(1, length(used) - {k} + 2)) AS i FROM u WHERE length(used) >= {k}) GROUP BY ALL) GROUP BY acc)"""


@query(f"""WITH {SEQ_SQL}, u AS (SELECT acc, seq, regexp_replace(upper(regexp_replace(seq, 'n+', '', 'g')), '[^AGCT]', 'n', 'g') AS used FROM s), {", ".join(_entropy_sql(k) for k in _KS)}
  SELECT u.acc, CAST(length(seq) AS INTEGER) AS len_all, CAST(length(used) AS INTEGER) AS len_used, {", ".join(f"round(coalesce(e{k}.e, 0), 4) AS entropy{k}" for k in _KS)},
    CASE WHEN length(used) > 0 THEN round(1 - length(regexp_replace(used, 'A{{6,}}|C{{6,}}|G{{6,}}|T{{6,}}', '', 'g')) / length(used), 4) END AS frac_hp FROM u {" ".join(f"LEFT JOIN e{k} ON u.acc = e{k}.acc" for k in _KS)}""")
def fasta_qc(spark, sf):
    return commands.fasta_qc(sequences(spark, sf), ks=_KS)


@query("""SELECT p_partkey, CAST(p_partkey % 40 + 1 + p_partkey % 7 + 4 AS INTEGER) AS query_length, CAST(p_partkey % 40 + 1 + p_partkey % 7 + 3 AS INTEGER) AS subject_length, 3 AS edits FROM part""")
def btop_parse(spark, sf):
    # runs of matches around an exchange, a base that the subject lacks, and another exchange
    b = F.concat((F.col("p_partkey") % 40 + 1).cast("string"), F.lit("CA"), F.lit("G-"), (F.col("p_partkey") % 7 + 1).cast("string"), F.lit("TG"))
    ops = S.btop_ops(b)
    q, s = S.btop_lengths(ops)
    return table(spark, sf, "part").select("p_partkey", q.alias("query_length"), s.alias("subject_length"), F.size(ops).alias("edits"))


@query("""WITH p AS (SELECT p_partkey, translate(rpad(regexp_replace(lower(p_name), '[^a-z]', '', 'g'), 40, 'acgt'), 'abcdefghijklmnopqrstuvwxyz', 'ACCGGTTACGTACGTACGTACGTACA') AS s FROM part)
  SELECT 'p' AS sample, p_partkey AS sacc, p_partkey || '_0+' || p_partkey || '_1+' || p_partkey || '_2' AS acc, substr(s, 1, 25) || 'nnnnn' || substr(s, 31, 10) AS seq FROM p""")
def scaffold_parts(spark, sf):
    # three contigs by part, cut from its own sequence: two that overlap, and one beyond a gap
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("sacc"), F.translate(F.rpad(F.regexp_replace(F.lower("p_name"), "[^a-z]", ""), 40, "acgt"), "abcdefghijklmnopqrstuvwxyz", "ACCGGTTACGTACGTACGTACGTACA").alias("full"))
    pieces = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, a, b in ((0, 1, 18), (1, 12, 25), (2, 31, 40))])
    rows = p.select("sacc", "full", F.explode(pieces).alias("x")).select("sacc", F.concat_ws("_", "sacc", "x.k").alias("qacc"), F.substring("full", F.col("x.a"), F.col("x.b") - F.col("x.a") + 1).alias("seq"), F.col("x.a").alias("sstart"), F.col("x.b").alias("send"), F.col("x.k").alias("ord"))
    rows = rows.withColumn("sample", F.lit("p")).withColumn("qstart", F.lit(1)).withColumn("qend", F.length("seq")).withColumn("btop", F.length("seq").cast("string"))
    return scaffold.scaffolds(rows.drop("seq"), rows.select("qacc", "seq"))[0]


@query("""WITH p AS (SELECT p_partkey AS k, CAST(p_partkey % 40 + 1 AS INTEGER) AS n, CAST(p_partkey % 7 + 1 AS INTEGER) AS m FROM part)
  SELECT k AS p_partkey, x.idx, x.kind, CASE x.idx WHEN 0 THEN n WHEN 3 THEN m ELSE 1 END AS n, x.a AS query_base, x.b AS subject_base, CASE x.idx WHEN 0 THEN 0 WHEN 1 THEN n WHEN 2 THEN n + 1 WHEN 3 THEN n + 2 WHEN 4 THEN n + 2 + m ELSE n + 3 + m END AS q,
    CASE x.idx WHEN 0 THEN 0 WHEN 1 THEN n WHEN 2 THEN n + 1 WHEN 3 THEN n + 1 WHEN 4 THEN n + 1 + m ELSE n + 2 + m END AS s
  FROM p, (VALUES (0, 'match', NULL, NULL), (1, 'exchange', 'C', 'A'), (2, 'insert', 'G', '-'), (3, 'match', NULL, NULL), (4, 'exchange', 'T', 'G'), (5, 'delete', '-', 'C')) x(idx, kind, a, b)""")
def btop_lateral(spark, sf):
    """Runs and edits of alignments as rows, by a lateral join."""
    b = F.concat((F.col("p_partkey") % 40 + 1).cast("string"), F.lit("CAG-"), (F.col("p_partkey") % 7 + 1).cast("string"), F.lit("TG-C"))
    return tables.with_btop_rows(table(spark, sf, "part").select("p_partkey", b.alias("btop"))).drop("btop")


#: 60 bases for each part, and where its first contig differs from them: for a third of the parts under the second contig, where it is outvoted.
_SUBJECT = """p AS (SELECT p_partkey AS k, upper(translate(rpad(regexp_replace(lower(p_name), '[^a-z]', '', 'g'), 60, 'acgttgca'), 'abcdefghijklmnopqrstuvwxyz', 'ACCGGTTACGTACGTACGTACGTACA')) AS s,
    CASE WHEN p_partkey % 3 = 0 THEN 17 ELSE 2 + p_partkey % 10 END AS m FROM part),
  c AS (SELECT *, k || '_0+' || k || '_1+' || k || '_2' AS acc, CASE WHEN m < 15 THEN substr(s, 1, m - 1) || translate(s[m], 'ACGT', 'CATG') || substr(s, m + 1, 14 - m) ELSE substr(s, 1, 14) END AS head FROM p)"""


@query(f"""WITH {_SUBJECT} SELECT acc, 'GG' || head || substr(s, 15, 16) || 'nnnnn' || substr(s, 36, 4) || 'G' || substr(s, 40, 6) || 'TTT' || substr(s, 51, 4) || substr(s, 56, 5) || 'CC' AS seq, x.a AS sstart, x.b AS send, k || x.q AS qacc, x.c AS qstart, x.d AS qend, x.n AS qlen, x.r AS reversed, x.bp, x.t AS scaffold
  FROM c, (VALUES (-1, 0, '_0', 1, 2, 22, false, 2, 'edge'), (1, 14, '_0', 3, 16, 22, false, 14, 'unique'), (15, 20, '_0', 17, 22, 22, false, 6, 'consensus'), (15, 20, '_1', 11, 16, 16, true, 6, 'consensus'), (21, 30, '_1', 1, 10, 16, true, 10, 'unique'),
    (36, 45, '_2', 1, 11, 25, false, 11, 'unique'), (46, 50, '_2', 12, 14, 25, false, 3, 'gap'), (51, 60, '_2', 15, 23, 25, false, 9, 'unique'), (61, 62, '_2', 24, 25, 25, false, 2, 'edge')) x(a, b, q, c, d, n, r, bp, t)""")
def scaffold_edits(spark, sf):
    """Scaffolds and their mapping rows: an exchange, a reverse contig over part of it, a gap, a contig with a base that the subject
    lacks and without one that it has, in two hits whose gap holds other bases, and ends that hang over."""
    full = F.translate(F.rpad(F.regexp_replace(F.lower("p_name"), "[^a-z]", ""), 60, "acgttgca"), "abcdefghijklmnopqrstuvwxyz", "ACCGGTTACGTACGTACGTACGTACA")
    m = F.when(F.col("p_partkey") % 3 == 0, 17).otherwise(2 + F.col("p_partkey") % 10).cast("int")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("sacc"), full.alias("s"), m.alias("m"))
    cut = lambda a, n: F.substring("s", a, n)
    at = F.substring(F.col("s"), F.col("m"), F.lit(1))
    other = F.translate(at, "ACGT", "CATG")
    first = F.concat(F.lit("GG"), F.substring(F.col("s"), F.lit(1), F.col("m") - 1), other, F.substring(F.col("s"), F.col("m") + 1, F.lit(20) - F.col("m")))
    third = F.concat(cut(36, 4), F.lit("G"), cut(40, 6), F.lit("TTT"), cut(51, 4), cut(56, 5), F.lit("CC"))
    name = lambda k: F.concat_ws("_", "sacc", F.lit(str(k)))
    contigs = p.select(F.explode(F.array(*[F.struct(name(k).alias("qacc"), x.alias("seq")) for k, x in enumerate((first, S.reverse_complement(cut(15, 16)), third))])).alias("c")).select("c.*")
    edit = F.concat((F.col("m") - 1).cast("string"), other, at, (20 - F.col("m")).cast("string"))
    rows = ((0, 3, 22, 1, 20, edit), (1, 1, 16, 30, 15, F.lit("16")), (2, 1, 11, 36, 45, F.lit("4G-6")), (2, 15, 23, 51, 60, F.concat(F.lit("4-"), cut(55, 1), F.lit("5"))))
    aligned = [F.struct(name(k).alias("qacc"), *[F.lit(v).alias(c) for v, c in zip(ends, ("qstart", "qend", "sstart", "send"))], btop.alias("btop"), F.lit(n).alias("ord")) for n, (k, *ends, btop) in enumerate(rows)]
    h = p.select(F.lit("p").alias("sample"), "sacc", F.explode(F.array(*aligned)).alias("h")).select("sample", "sacc", "h.*")
    seqs, mapping = scaffold.scaffolds(h, contigs)
    return mapping.join(seqs.select("sacc", "acc", "seq"), ["sacc", "acc"]).drop("sample", "sacc")


@query("""WITH t AS (SELECT p_partkey % 50 AS bin, -p_retailprice AS e, list_concat(['Type ' || p_partkey % 9, 'Type'], list_concat(string_split(p_name, ' '), string_split(p_type, ' '))) AS ws FROM part),
  w AS (SELECT bin, e, generate_subscripts(ws, 1) - 1 AS idx, unnest(ws) AS raw FROM t),
  u AS (SELECT bin, e, idx, CASE WHEN substr(raw, 2) = lower(substr(raw, 2)) AND substr(raw, 2) <> upper(substr(raw, 2)) THEN lower(raw) ELSE raw END AS word FROM w),
  s AS (SELECT bin, word, sum(e / pow(2, idx)) AS score FROM u GROUP BY ALL),
  p AS (SELECT bin, score, word, generate_subscripts(string_split(word, ' '), 1) AS k, unnest(string_split(word, ' ')) AS part FROM s),
  f AS (SELECT bin, part, row_number() OVER (PARTITION BY bin, part ORDER BY score, word, k) AS r, row_number() OVER (PARTITION BY bin ORDER BY score, word, k) AS met FROM p),
  o AS (SELECT bin, part, row_number() OVER (PARTITION BY bin ORDER BY met) AS place FROM f WHERE r = 1)
  SELECT bin, string_agg(part, ' ' ORDER BY place) AS words FROM o WHERE place <= 4 GROUP BY bin""")
def word_scores(spark, sf):
    # stop words of any case go, a single digit hangs on the word before it, punctuation is taken off
    title = F.concat(F.lit("Complete, (Type "), F.col("p_partkey") % 9, F.lit(") "), F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" genome; HUMAN"))
    rows = table(spark, sf, "part").select((F.col("p_partkey") % 50).alias("bin"), title.alias("stitle"), (-F.col("p_retailprice")).alias("log_evalue"))
    return commands.word_scores(rows, ["bin"])


@query("""SELECT p_partkey, trim(replace(translate(p_name || ' / ' || p_brand, ' /.', '___'), '__', '_'), '_') AS safe, split_part(p_name, ' ', 1) AS head, CAST(length(p_name) - length(split_part(p_name, ' ', 1)) AS INTEGER) AS rest FROM part""")
def names_and_parts(spark, sf):
    head, tail = C.head_tail(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", C.file_safe(F.concat_ws(" / ", "p_name", "p_brand")).alias("safe"), head.alias("head"), (F.length("p_name") - F.length(head)).alias("rest"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 THEN 0 ELSE 2 END AS n FROM part")
def tax_id_lists(spark, sf):
    text = F.when(F.col("p_size") % 3 == 0, "N/A").when(F.col("p_size") % 3 == 1, "1;x;3").otherwise(F.concat_ws(";", "p_size", "p_partkey"))
    return table(spark, sf, "part").select("p_partkey", F.size(C.tax_ids(text)).alias("n"))


# ---- reshape, windows, statistics


@query("SELECT o_orderkey, k, v FROM (SELECT o_orderkey, unnest(['price', 'cust']) AS k, unnest([o_totalprice, CAST(o_custkey AS DOUBLE)]) AS v FROM orders)")
def pivot_long(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("double").alias("cust"))
    return expression.to_long(o, ["o_orderkey"], "k", "v")


@query("SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS \"F\", CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS BIGINT) AS \"O\" FROM orders GROUP BY 1")
def pivot_wide(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").count()
    return expression.to_wide(n, ["o_orderpriority"], "o_orderstatus", "count", ["F", "O"])


@query("""SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) ELSE string_agg(o_orderstatus, ';' ORDER BY o_orderstatus) END AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def collapse_constant(spark, sf):
    return expression.collapse(table(spark, sf, "orders").select("o_custkey", "o_orderstatus"), ["o_custkey"])


@query("SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def feature_explode(spark, sf):
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select("event_id", F.explode(m).alias("key", "value"))


@query("""SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def forward_fill(spark, sf):
    e = table(spark, sf, "events").withColumn("filled", F.when(F.col("event_id") % 3 == 0, F.col("event_type")))
    return expression.fill_down(e, ["filled"], ["user_id"], ["event_id"]).select("event_id", "filled")


@query("WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, event_type, round(n / sum(n) OVER (PARTITION BY user_id), 6) AS share FROM n")
def share_of_total(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return expression.share_of_total(n, "n", ["user_id"]).select("user_id", "event_type", F.round("share", 6).alias("share"))


@query("SELECT o_orderkey, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_orderpriority, o_custkey) - 1) / 2.0 AS rank FROM orders")
def avg_rank(spark, sf):
    return expression.average_rank(table(spark, sf, "orders"), "o_custkey", ["o_orderpriority"]).select("o_orderkey", "rank")


_P = ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{int(round(p * 100)):02d}" for p in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99))


@query(f"SELECT l_returnflag, round(avg(l_extendedprice), 3) AS mean, min(l_extendedprice) AS min, max(l_extendedprice) AS max, {_P} FROM lineitem GROUP BY 1")
def percentile_stats(spark, sf):
    out = expression.percentile_stats(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", F.round("mean", 3).alias("mean"), "min", "max", *[F.round(c, 4).alias(c) for c in out.columns if c.startswith("p")])


@query("""WITH j AS (SELECT event_type AS stage, user_id, sum(value) AS s, sum(value) * 2 AS c FROM events GROUP BY ALL), t AS (SELECT *, CASE stage WHEN 'click' THEN 2 WHEN 'view' THEN 4 ELSE -1 END AS threads FROM j)
  SELECT stage, user_id, threads, round(s * threads / 3600 / 2, 6) AS core_hours FROM t""")
def core_hours(spark, sf):
    j = table(spark, sf, "events").select(F.col("event_type").alias("stage"), "user_id", F.col("value").alias("s"), (F.col("value") * 2).alias("cpu_time"))
    out = expression.core_hours(j, {"click": 2, "view": 4}, keys=("stage", "user_id"))
    return out.select("stage", "user_id", "threads", F.round("core_hours", 6).alias("core_hours"))


@query("SELECT o_orderpriority, round(corr(o_totalprice, o_custkey), 6) AS r, round(regr_slope(o_totalprice, o_custkey), 5) AS slope, count(*) AS n FROM orders GROUP BY 1")
def regression(spark, sf):
    out = expression.regression(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", "o_custkey")
    return out.select("o_orderpriority", F.round("r", 6).alias("r"), F.round("slope", 5).alias("slope"), "n")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n = 1""")
def unique_matches(spark, sf):
    return expression.unique_matches(table(spark, sf, "orders"), ["o_custkey"]).select("o_orderkey")


@query("""SELECT coalesce(a.k, b.k, c.k) AS k, a.k IS NOT NULL AS have_orders, b.k IS NOT NULL AS have_events, c.k IS NOT NULL AS have_customers FROM (SELECT DISTINCT o_custkey AS k FROM orders) a
  FULL JOIN (SELECT DISTINCT user_id AS k FROM events) b ON a.k = b.k FULL JOIN (SELECT DISTINCT c_custkey AS k FROM customer) c ON coalesce(a.k, b.k) = c.k""")
def presence(spark, sf):
    t = {"orders": table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), "events": table(spark, sf, "events").select(F.col("user_id").alias("k")), "customers": table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))}
    return expression.presence(t, ["k"])


@query("""WITH x AS (SELECT l_orderkey % 30 AS sample, l_partkey AS feature_id, sum(l_quantity) AS counts, CAST(1 AS DOUBLE) AS abundance, avg(l_extendedprice) AS length FROM lineitem GROUP BY ALL), f AS (SELECT feature_id, avg(length) AS length FROM x GROUP BY 1)
  SELECT feature_id, sample, counts, abundance, round(length, 4) AS length FROM x UNION ALL SELECT feature_id, CAST(s AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), round(length, 4) FROM f, (VALUES (101), (102)) v(s)""")
def zero_fill(spark, sf):
    x = table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 30).alias("sample"), F.col("l_partkey").alias("feature_id")).agg(F.sum("l_quantity").alias("counts"), F.lit(1.0).alias("abundance"), F.avg("l_extendedprice").alias("length"))
    return expression.zero_fill(x, spark.createDataFrame([(101,), (102,)], "sample long")).withColumn("length", F.round("length", 4))


@query("""WITH i AS (SELECT n_regionkey AS acc, n_nationkey AS ord, n_name AS seq FROM nation), r AS (SELECT *, row_number() OVER (PARTITION BY acc ORDER BY ord) - 1 AS k FROM i)
  SELECT CASE WHEN k > 0 THEN CAST(acc AS VARCHAR) || '_' || k ELSE CAST(acc AS VARCHAR) END AS acc, seq FROM r""")
def unique_ids(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_regionkey").cast("string").alias("acc"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("seq"))
    return writers.unique_ids(n).select("acc", "seq")


@query("""WITH s AS (SELECT CAST(l_suppkey AS BIGINT) AS taxid, CASE l_linenumber % 3 WHEN 0 THEN 'refseq' WHEN 1 THEN 'complete' ELSE 'any' END AS source, l_partkey AS size FROM lineitem),
  a AS (SELECT taxid, source, CAST(floor(avg(size)) AS DOUBLE) AS size FROM s WHERE size > 0 GROUP BY ALL),
  b AS (SELECT taxid, arg_min(struct_pack(source := source, size := size), CASE source WHEN 'refseq' THEN 1 WHEN 'complete' THEN 2 ELSE 3 END) AS b FROM a GROUP BY ALL)
  SELECT s_suppkey AS taxid, coalesce(b.b.source, 'failed') AS genome_size_source, coalesce(b.b.size, 0) AS genome_size FROM supplier LEFT JOIN b ON s_suppkey = b.taxid""")
def genome_size_ladder(spark, sf):
    kind = F.when(F.col("l_linenumber") % 3 == 0, "refseq").when(F.col("l_linenumber") % 3 == 1, "complete").otherwise("any")
    s = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("taxid"), kind.alias("source"), F.col("l_partkey").alias("size"))
    return readers.genome_sizes(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("taxid")), s)


#: The command step by step: reads and homopolymer filters, class of each query, majority and relative score filters, greedy
#: selection, measures of the selected hits by segments, quorum LCA and words of the groups, filter of the calls.
_BLASTBIN = f"""WITH RECURSIVE {HITS_SQL}, {TREE_SQL},
  below AS (SELECT tax_id, unnest(path) AS up FROM paths UNION ALL SELECT n.tax_id, p.tax_id FROM nodes n JOIN nodes p ON p.tax_id IN (n.tax_id, n.parent_id) WHERE n.rank <> 'species'),
  named AS (SELECT b.tax_id, n.name AS up FROM below b JOIN nodes n ON b.up = n.tax_id),
  qc AS (SELECT o_orderkey AS acc, o_orderkey % 40 / 200.0::DOUBLE AS frac_hp, o_orderkey % 17 / 16.0::DOUBLE AS entropy2 FROM orders),
  reads AS (SELECT o_orderkey % 50 AS sample, o_orderkey AS qacc, CAST(o_orderkey % 23 + o_orderkey % 5 AS BIGINT) AS numreads FROM orders),
  h1 AS (SELECT h.*, numreads, frac_hp, entropy2 FROM h JOIN reads r ON h.sample = r.sample AND h.qacc = r.qacc JOIN qc ON h.qacc = acc WHERE numreads >= 5 AND frac_hp * 100 <= 15),
  cx AS (SELECT sample, qacc, taxid, bitscore AS w, min(ord) AS ord FROM h1 GROUP BY ALL), cr AS (SELECT sample, qacc, w, generate_subscripts(path, 1) - 1 AS depth, unnest(path) AS node, ord FROM cx JOIN paths ON taxid = tax_id),
  cn AS (SELECT sample, qacc, depth, node, sum(w) AS w, min(ord) AS first FROM cr GROUP BY ALL), cd AS (SELECT sample, qacc, depth, sum(w) AS tot, arg_min(struct_pack(node, w), struct_pack(neg := -w, first)) AS b FROM cn GROUP BY ALL),
  cg AS (SELECT *, max(tot) OVER (PARTITION BY sample, qacc) AS total FROM cd), class AS (SELECT sample, qacc, arg_max(b.node, depth) AS taxid FROM cg WHERE tot >= total * 0.9 - 1e-9 AND b.w >= tot * 0.9 - 1e-9 GROUP BY ALL),
  h2 AS (SELECT * FROM h1 WHERE (sample, qacc) NOT IN (SELECT (sample, qacc) FROM class JOIN named ON taxid = tax_id WHERE up = 'AMERICA')),
  h3 AS (SELECT * EXCLUDE keep, taxid NOT IN (SELECT tax_id FROM named WHERE up IN ('NATION_3', 'Supplier#000000003')) AS ok, bitscore > 0.9 * max(bitscore) OVER (PARTITION BY sample, qacc) AS top FROM h2),
  h4 AS (SELECT * FROM (SELECT *, sum(CASE WHEN top AND ok THEN 1 ELSE 0 END) OVER q AS k, sum(CASE WHEN top THEN 1 ELSE 0 END) OVER q AS a FROM h3 WINDOW q AS (PARTITION BY sample, qacc)) WHERE k * 2 >= a AND ok),
  h5 AS (SELECT *, CASE WHEN lag(sacc) OVER (PARTITION BY sample, qacc ORDER BY ord) = sacc THEN 0 ELSE 1 END AS new FROM h4), h6 AS (SELECT *, sum(new) OVER (PARTITION BY sample, qacc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM h5),
  ha AS (SELECT sample, qacc, island, sum(score) AS s, avg(pident) AS p FROM h6 GROUP BY ALL), hb AS (SELECT sample, qacc, s AS s0, p AS p0 FROM ha WHERE island = 1),
  hh AS (SELECT h6.*, min(ord) OVER (PARTITION BY h6.sample, sacc) AS first FROM h6 JOIN ha USING (sample, qacc, island) JOIN hb USING (sample, qacc) WHERE s > s0 * 0.9 AND p > 100 - (100 - p0) * 1.5 - 0.5),
  {GREEDY_SQL},
  sel AS (SELECT hh.* FROM hh JOIN st ON hh.sample = st.sample AND hh.sacc = st.best AND list_contains(own, hh.qacc)),
  sq AS (SELECT *, max(qend) OVER (PARTITION BY sample, sacc, qacc ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM sel),
  cov AS (SELECT sample, sacc, sum(greatest(0, qend - greatest(qstart, coalesce(r + 1, qstart)) + 1)) AS c FROM sq GROUP BY ALL),
  once AS (SELECT DISTINCT sample, sacc, qacc, numreads FROM sel), nr AS (SELECT sample, sacc, CAST(sum(numreads) AS BIGINT) AS numreads FROM once GROUP BY ALL), firsts AS (SELECT sample, sacc, arg_min(taxid, ord) AS taxid FROM sel GROUP BY ALL),
  sp AS (SELECT DISTINCT sample, sacc, unnest([lo, hi + 1]) AS s FROM sel), sg AS (SELECT sample, sacc, s AS b, lead(s) OVER (PARTITION BY sample, sacc ORDER BY s) - 1 AS e FROM sp),
  sv AS (SELECT sg.sample, sg.sacc, b, e, max(pident) AS p, avg(frac_hp) AS f, avg(entropy2) AS n FROM sg JOIN sel ON sg.sample = sel.sample AND sg.sacc = sel.sacc AND lo <= b AND hi >= e GROUP BY ALL),
  wt AS (SELECT sample, sacc, round(sum((e - b + 1) * p) / sum(e - b + 1), 1) AS pident, round(sum((e - b + 1) * f) / sum(e - b + 1) * 100, 2) AS pcthp, round(sum((e - b + 1) * n) / sum(e - b + 1), 2) AS entropy2 FROM sv GROUP BY ALL),
  mem AS (SELECT g.sample, g.bin, g.position, g.sacc, m.ev, firsts.taxid FROM members g JOIN m ON m.sample = g.sample AND m.sacc = g.sacc AND m.sacc = m.best JOIN firsts ON firsts.sample = g.sample AND firsts.sacc = g.sacc),
  lr AS (SELECT sample, bin, position, generate_subscripts(path, 1) - 1 AS depth, unnest(path) AS node FROM mem JOIN paths ON taxid = tax_id), ln AS (SELECT sample, bin, depth, node, count(*) AS w, min(position) AS first FROM lr GROUP BY ALL),
  ld AS (SELECT sample, bin, depth, sum(w) AS tot, arg_min(struct_pack(node, w), struct_pack(neg := -w, first)) AS b FROM ln GROUP BY ALL), lg AS (SELECT *, max(tot) OVER (PARTITION BY sample, bin) AS total FROM ld),
  lca AS (SELECT sample, bin, arg_max(b.node, depth) AS taxid FROM lg WHERE tot >= total * 0.9 - 1e-9 AND b.w >= tot * 0.9 - 1e-9 GROUP BY ALL),
  wa AS (SELECT sample, bin, position * 2 AS met, 'isolate ' || sacc AS w, ev FROM mem UNION ALL SELECT sample, bin, position * 2 + 1, 'region', ev / 2 FROM mem), ws AS (SELECT sample, bin, w, sum(ev) AS s, min(met) AS met FROM wa GROUP BY ALL),
  wu AS (SELECT sample, bin, s, met, generate_subscripts(string_split(w, ' '), 1) AS i, unnest(string_split(w, ' ')) AS word FROM ws), wf AS (SELECT sample, bin, word, min(struct_pack(s, met, i)) AS o FROM wu GROUP BY ALL),
  words AS (SELECT sample, bin, array_to_string(list(word ORDER BY o)[1:4], ' ') AS words FROM wf GROUP BY ALL)
  SELECT g.sample, g.sacc, g.bin, m.ev AS log_evalue, CAST(m.slen AS BIGINT) AS slen, m.n_hits AS n_frag, round(cov.c * 100 / m.qlen, 1) AS contig_coverage, pident, numreads, pcthp, entropy2, words.words, lca.taxid, t.name AS taxname,
    CASE WHEN t.rank = 'species' THEN t.name ELSE 'Unknown' END AS species, coalesce(paths.lineage, (SELECT string_agg(n.name, '; ' ORDER BY n.tax_id) FROM below b JOIN nodes n ON b.up = n.tax_id WHERE b.tax_id = lca.taxid AND n.tax_id <> 1), '') AS lineage
  FROM members g JOIN m ON m.sample = g.sample AND m.bin = g.bin AND m.sacc = g.sacc JOIN cov ON cov.sample = g.sample AND cov.sacc = g.sacc JOIN wt ON wt.sample = g.sample AND wt.sacc = g.sacc JOIN nr ON nr.sample = g.sample AND nr.sacc = g.sacc
  JOIN lca ON lca.sample = g.sample AND lca.bin = g.bin JOIN words ON words.sample = g.sample AND words.bin = g.bin JOIN nodes t ON t.tax_id = lca.taxid LEFT JOIN paths ON paths.tax_id = lca.taxid
  WHERE g.representative AND lca.taxid NOT IN (SELECT tax_id FROM named WHERE up = 'NATION_7')"""


@query(_BLASTBIN)
def blastbin(spark, sf):
    h = hits(spark, sf).withColumn("stitle", F.concat_ws(" ", F.lit("Isolate"), F.col("sacc").cast("string"), F.lit("region, complete")))
    lin = taxonomy.lineage(taxon_nodes(spark, sf))
    o = table(spark, sf, "orders")
    qc = o.select(F.col("o_orderkey").alias("acc"), (F.col("o_orderkey") % 40 / F.lit(200.0)).alias("frac_hp"), (F.col("o_orderkey") % 17 / F.lit(16.0)).alias("entropy2"))
    units = [o.select((F.col("o_orderkey") % 50).alias("sample"), F.col("o_orderkey").alias("qacc"), (F.col("o_orderkey") % n).alias("numreads")) for n in (23, 5)]  # two coverage files
    # names of the driver tables' tree in the places of those that the command leaves out by default
    out = commands.blastbin(h, lin, coverage=units[0].unionByName(units[1]), qc=qc, min_reads=5, max_pcthp=15, hit_excludes=("NATION_3", "Supplier#000000003"), class_excludes=("AMERICA",), bin_excludes=("NATION_7",))["calls"]
    return out.select("sample", "sacc", "bin", "log_evalue", "slen", "n_frag", "contig_coverage", "pident", "numreads", "pcthp", "entropy2", "words", "taxid", "taxname", "species", "lineage")


from . import io_queries, operator_queries, plan_queries  # noqa: E402  (readers and sinks, over files written from the driver tables; single operators; whole commands)

for more in (io_queries, operator_queries, plan_queries):
    QUERIES |= more.QUERIES
    ORACLE |= more.ORACLE
