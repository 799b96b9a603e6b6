"""Domain-shaped views over general tables: hits from order lines, a tree from regions, nations and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.ordering import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of orders (queries) on supplier groups (subjects), in file order by (order, line)."""
    li = dealt(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "qacc"), ["qacc"])  # named first, so that what is grouped by qacc isn't shuffled again
    order = Window.partitionBy("qacc").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax")
    li = li.withColumn("_line", F.row_number().over(order))  # first, so that it is order lines that are shuffled, not what is made of them
    lo = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 101) % 5000 + 1
    n = F.floor("l_quantity").cast("long") * 4
    rev = F.col("l_returnflag") == "R"
    qlo = F.col("l_linenumber") * 150 % 4000 + 1
    return li.select(
        (F.col("qacc") % 50).alias("sample"), "qacc", (F.col("l_suppkey") % 7).alias("sacc"),
        (F.col("qacc") * 1000 + F.col("_line")).alias("ord"), F.lit(5000).cast("long").alias("qlen"), qlo.cast("long").alias("qstart"), (qlo + n - 1).cast("long").alias("qend"),
        F.when(rev, lo + n - 1).otherwise(lo).alias("sstart"), F.when(rev, lo).otherwise(lo + n - 1).alias("send"), (F.col("l_quantity") * 2).alias("score"),
        (F.col("l_quantity") * 2 + F.col("l_linenumber")).alias("bitscore"), F.round(100 - F.col("l_discount") * 100, 1).alias("pident"), (F.col("l_suppkey") + 1000).alias("taxid"),
        F.array((F.col("l_suppkey") + 1000)).alias("staxids"), ((F.col("l_partkey") + F.col("l_linenumber")) % 5 != 0).alias("keep"),
    )


#: The same in SQL; `h` in oracle queries.
HITS_SQL = """
h AS (
  SELECT l_orderkey % 50 AS sample, l_orderkey AS qacc, l_suppkey % 7 AS sacc,
    l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax) AS ord,
    CAST(5000 AS BIGINT) AS qlen, CAST(l_linenumber * 150 % 4000 + 1 AS BIGINT) AS qstart, CAST(l_linenumber * 150 % 4000 + CAST(floor(l_quantity) AS BIGINT) * 4 AS BIGINT) AS qend,
    (l_partkey * 37 + l_linenumber * 101) % 5000 + 1 AS lo, (l_partkey * 37 + l_linenumber * 101) % 5000 + CAST(floor(l_quantity) AS BIGINT) * 4 AS hi,
    CASE WHEN l_returnflag = 'R' THEN (l_partkey * 37 + l_linenumber * 101) % 5000 + CAST(floor(l_quantity) AS BIGINT) * 4 ELSE (l_partkey * 37 + l_linenumber * 101) % 5000 + 1 END AS sstart,
    CASE WHEN l_returnflag = 'R' THEN (l_partkey * 37 + l_linenumber * 101) % 5000 + 1 ELSE (l_partkey * 37 + l_linenumber * 101) % 5000 + CAST(floor(l_quantity) AS BIGINT) * 4 END AS send,
    l_quantity * 2 AS score, l_quantity * 2 + l_linenumber AS bitscore, round(100 - l_discount * 100, 1) AS pident, l_suppkey + 1000 AS taxid,
    (l_partkey + l_linenumber) % 5 <> 0 AS keep
  FROM lineitem)"""


def taxon_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """root 1, regions 10 + key, nations 100 + key, suppliers 1000 + key."""
    root = spark.createDataFrame([(1, 1, "root", "no rank")], "tax_id long, parent_id long, name string, rank string")
    r = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 10).cast("long").alias("tax_id"), F.lit(1).cast("long").alias("parent_id"), F.col("r_name").alias("name"), F.lit("phylum").alias("rank"))
    n = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("tax_id"), (F.col("n_regionkey") + 10).cast("long").alias("parent_id"), F.col("n_name").alias("name"), F.lit("genus").alias("rank"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000).cast("long").alias("tax_id"), (F.col("s_nationkey") + 100).cast("long").alias("parent_id"), F.col("s_name").alias("name"), F.lit("species").alias("rank"))
    return root.unionByName(r).unionByName(n).unionByName(s)


TREE_SQL = """
nodes AS (
  SELECT CAST(1 AS BIGINT) AS tax_id, CAST(1 AS BIGINT) AS parent_id, 'root' AS name, 'no rank' AS rank
  UNION ALL SELECT r_regionkey + 10, 1, r_name, 'phylum' FROM region
  UNION ALL SELECT n_nationkey + 100, n_regionkey + 10, n_name, 'genus' FROM nation
  UNION ALL SELECT s_suppkey + 1000, s_nationkey + 100, s_name, 'species' FROM supplier),
paths AS (
  SELECT s_suppkey + 1000 AS tax_id, [CAST(1 AS BIGINT), n_regionkey + 10, n_nationkey + 100, s_suppkey + 1000] AS path, r_name || '; ' || n_name || '; ' || s_name AS lineage
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nucleotide-like sequences out of document texts: letters mapped to ACGT, a few to n."""
    text = F.lower(F.col("text"))
    seq = F.translate(F.regexp_replace(text, "[^a-z]", ""), "abcdefghijklmnopqrstuvwxyz", "AACCGGTTACGTACGTACGTACGTAn")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("acc"), seq.alias("seq"))


SEQ_SQL = "s AS (SELECT doc_id AS acc, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'AACCGGTTACGTACGTACGTACGTAn') AS seq FROM documents)"
