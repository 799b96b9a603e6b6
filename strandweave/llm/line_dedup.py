"""Line dedup as an exact set-similarity join, with DataFrame functions only.

A line goes if an earlier line of the corpus, by (doc_id, line number), has Jaccard similarity `threshold` or more on
distinct lower-cased words. Lines without a word stay, and so do those under `min_chars` characters (default: none).

1. Rarity: words are counted over all documents in 2^16 hash buckets; a word's order is (class of its bucket among 128 by rank, hash).
   Any total order is right, a rarer first word only makes buckets smaller, so the table has a fixed size.
2. Equal lines are one class: grouped by hash, the first stays.
3. Each line emits its prefix, the n - ceil(t n) + 1 rarest words, with n, the position and a parity bitmap of its
   words (64 bits, 128 for long lines). A semi-join on the word keeps rows with a partner that passes the length filter (min >= t max), the
   positional filter (1 + min(words left) >= t / (1 + t) (n + m)) and the bitmap bound (the bits that differ are at most
   the words that differ). It stops at the first partner, so a hot word's rows are not paired with each other.
4. What is left are lines with a likely partner. Each is verified, on words, against the first line of its buckets;
   those that don't match are verified against every earlier partner. So near copies of one line, however many, cost a
   pair each.

The most frequent repeated lines, up to a bound on their number, are broadcast, so that their copies never reach the
prefix index; copies of other lines do, and find their first line there or by step 2.

Edge cases: null text has no lines; blank lines stay; ties can't arise, as (doc_id, line number) is total, but for rows
that repeat an id, which count as one document whose equal line numbers keep each other; null ids come first and are
such a document too. Empty tables: no rows. Very long lines: all words count. Extra columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, materialize, unused

BUCKETS, CLASSES = 1 << 16, 128


#: One white space character. A split at single ones is much cheaper than at runs; empty words are taken out after it.
BLANK = r"[ \t\n\u000b\u000c\r]"


def _words(norm: Column) -> Column:
    return F.array_remove(F.split(norm, BLANK), "")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """`doc_id, line_no, norm` of lines that count: lower-cased, without blanks at the ends, not only of white space."""
    exploded = docs.select(F.col("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # the explode of a one-element array keeps the optimizer from normalising once for the filter and again for each use
    lines = exploded.select("doc_id", "line_no", F.explode(F.array(F.trim(F.lower("line")))).alias("norm"))
    has_word = (F.ascii("norm") > 32) | (F.btrim("norm", F.lit(" \t\u000b\u000c\r")) != "")
    return lines.where((F.length("norm") >= min_chars) & has_word)


def rarity_classes(docs: DataFrame) -> Column:
    """An array literal with the class, 0 the rarest, of each of the 2^16 buckets by its number of words.

    A literal, as a column of the table would be copied into every row; bytes, as these are shared when boxed.
    """
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split(F.lower("text"), "\n")).alias("line"))
    # split at blanks only, which needs no regex: a word that touches a tab is counted with it, which costs no exactness
    words = lines.select(F.explode(F.split("line", " ")).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(BUCKETS - 1).alias("b")).agg(F.count("*").alias("c"))
    counts = spark.range(BUCKETS).withColumnRenamed("id", "b").join(counts, "b", "left").fillna(0, ["c"])
    ranked = counts.select("b", F.floor((F.row_number().over(Window.orderBy("c", "b")) - 1) * CLASSES / BUCKETS).alias("r"))
    text = ranked.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "r"))), lambda x: x["r"].cast("string")), ",")).first()[0]
    return F.split(F.lit(text), ",").cast("array<tinyint>")


#: Lines of more words than this have a bitmap of 128 bits, of which m1 is one half and m the two halves folded; others one of 64 (m; m1 is 0).
LONG = 64


def _toggled(keys: Column) -> Column:
    bits = F.aggregate(keys, F.expr("0L"), lambda acc, x: acc.bitwiseXOR(F.call_function("shiftleft", F.expr("1L"), x.bitwiseAND(63).cast("int"))))
    return F.coalesce(bits, F.expr("0L"))  # never null, so no filter on it is inferred that would compute it twice


def _near(a: str, b: str, t: float) -> Column:
    """Bitmap, length and positional filters between the rows called a and b, the strongest first."""
    n, m, i, j = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.i", f"{b}.i"))
    far, shared = (n + m) * ((1 - t) / (1 + t)) + 1e-9, (n + m) * (t / (1 + t)) - 1e-9
    low, high = (F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")) for c in ("m", "m1"))
    long = (n <= LONG) | (m <= LONG) | (F.bit_count(low.bitwiseXOR(high)) + F.bit_count(high) <= far)
    return (F.bit_count(low) <= far) & (F.least(n, m) >= F.greatest(n, m) * t - 1e-9) & (F.least(n - i, m - j) >= shared) & long


def repeated_lines(docs: DataFrame, *, threshold: float = 0.8, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, line_no, like_doc_id, like_line_no` for every line that goes, with an earlier line that it is like."""
    t = threshold
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = materialize(_lines(docs, min_chars).select("doc_id", "line_no", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(7), "norm").alias("h2")))
    classes = materialize(lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("at"), F.count("*").alias("c")))
    several = classes.where("c > 1")
    copies = lines.join(several.select("h1", "h2", "at"), ["h1", "h2"]).where(F.struct("doc_id", "line_no") != F.col("at")).select("doc_id", "line_no", "at")

    # the most frequent of them, as many as may be broadcast: copies of these don't reach the index
    held, least = 0, 1 << 62
    for r in several.groupBy(F.least("c", F.lit(1 << 20)).alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c")).toLocalIterator():
        held += r["n"]
        if held > BROADCAST_IDS:
            break
        least = r["c"]
    hot = several.where(F.col("c") >= least).select(F.col("h1"), F.col("at.doc_id").alias("hot_doc"), F.col("at.line_no").alias("hot_line"))
    classes_of = rarity_classes(docs)
    parts = _lines(docs, min_chars).select("doc_id", "line_no", "norm", F.xxhash64("norm").alias("h1"))
    parts = parts.join(F.broadcast(hot), "h1", "left").where("hot_line is null or (hot_doc <=> doc_id and hot_line = line_no)")
    # key: 7 bits of class, 56 of hash; equal keys within two lines are equal words but for a chance of 1e-14
    parts = parts.select("h1", F.transform(_words(F.col("norm")), lambda w: F.xxhash64(w)).alias("hashes"))
    rarity = lambda h: F.coalesce(F.get(classes_of, h.bitwiseAND(BUCKETS - 1).cast("int")).cast("long"), F.lit(0).cast("long"))
    parts = parts.select("h1", F.sort_array(F.transform(F.array_distinct("hashes"), lambda h: F.shiftleft(rarity(h), 56).bitwiseOR(F.shiftrightunsigned(h, 8)))).alias("keys"))
    n = F.size("keys")
    upper = F.when(n > LONG, _toggled(F.filter("keys", lambda x: x.bitwiseAND(64) == 64))).otherwise(F.expr("0L"))
    parts = parts.select("h1", n.alias("n"), F.slice("keys", 1, (n - F.ceil(n * t - 1e-9) + 1).cast("int")).alias("prefix"), _toggled(F.col("keys")).alias("m"), upper.alias("m1"))
    index = parts.select("h1", "n", "m", "m1", F.posexplode_outer("prefix").alias("i", "key"))  # outer, as no filter is inferred then that would compute prefixes twice

    a, b = index.alias("a"), index.alias("b")
    likely = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.h1") != F.col("b.h1")) & _near("a", "b", t), "left_semi").distinct()
    likely = materialize(likely.join(classes.select("h1", "at"), "h1"))

    # the words of likely lines, each class once
    wanted = materialize(likely.select("h1", "at").distinct())
    at = wanted.select("h1", F.col("at.doc_id").alias("d"), F.col("at.line_no").alias("l"))
    raw = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    own = raw.join(F.broadcast(at) if wanted.count() <= BROADCAST_IDS else at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")))
    own = own.select("h1", F.explode(F.array(F.trim(F.lower("line")))).alias("norm")).where(F.xxhash64("norm") == F.col("h1"))
    words = materialize(own.select("h1", F.array_distinct(_words(F.col("norm"))).alias("words")))

    def alike(pairs: DataFrame) -> DataFrame:
        both = pairs.join(words.select(F.col("h1").alias("x"), F.col("words").alias("wx")), "x").join(words.select(F.col("h1").alias("y"), F.col("words").alias("wy")), "y")
        shared = F.size(F.array_intersect("wx", "wy"))
        return both.where(shared >= (F.size("wx") + F.size("wy") - shared) * t - 1e-9).select("x", "x_at", "y_at")

    def pairs_of(left: DataFrame, right: DataFrame) -> DataFrame:
        on = (F.col("a.key") == F.col("b.key")) & (F.col("b.at") < F.col("a.at")) & _near("a", "b", t)
        return left.alias("a").join(right.alias("b"), on).select(F.col("a.h1").alias("x"), F.col("a.at").alias("x_at"), F.col("b.h1").alias("y"), F.col("b.at").alias("y_at")).distinct()

    heads = likely.groupBy("key").agg(F.min(F.struct("at", "h1", "n", "i", "m", "m1")).alias("s")).select("key", "s.*")
    tried = materialize(pairs_of(likely, heads))
    found = materialize(alike(tried))
    rest = likely.join(found.select(F.col("x").alias("h1")).distinct(), "h1", "left_anti")
    more = pairs_of(rest, likely).join(tried.select("x", "y"), ["x", "y"], "left_anti")
    found = found.unionByName(alike(more)).groupBy("x", "x_at").agg(F.min("y_at").alias("at"))
    near = found.select(F.col("x_at.doc_id").alias("doc_id"), F.col("x_at.line_no").alias("line_no"), "at")
    return copies.unionByName(near).select("doc_id", "line_no", F.col("at.doc_id").alias("like_doc_id"), F.col("at.line_no").alias("like_line_no"))


def removed_by_doc(docs: DataFrame, *, id_col: str = "doc_id", **params) -> DataFrame:
    """`id, gone`: the sorted distinct line numbers that go."""
    lines = repeated_lines(docs, id_col=id_col, **params)
    return lines.groupBy(F.col("doc_id").alias("id")).agg(F.array_sort(F.collect_set("line_no")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs without the lines that go; a document that loses all its words this way goes too."""
    key, gone, left = (unused(name, docs) for name in ("removed_id", "removed_lines", "left_text"))
    removed = materialize(removed_by_doc(docs, id_col=id_col, text_col=text_col, **params).toDF(key, gone))
    small = removed.agg(F.coalesce(F.sum(F.size(gone) + 4), F.lit(0))).first()[0] <= 2 * BROADCAST_IDS
    out = docs.join(F.broadcast(removed) if small else removed, docs[id_col].eqNullSafe(removed[key]), "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
    out = out.withColumn(left, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept))
    out = out.where(F.col(gone).isNull() | (F.length(F.btrim(left, F.lit(" \t\u000b\u000c\r\n"))) > 0)).withColumn(text_col, F.col(left))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


# ---------------------------------------------------------------- query


def op10_line_set_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    removed = removed_by_doc(docs)
    counted = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    out = counted.join(removed, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed"))


def line_dedup_stage(spark, docs, sf_dir):
    return drop_repeated_lines(docs)


QUERIES = {"op10_line_set_join": op10_line_set_join}

#: Brute force: shared words of all pairs of distinct lines, by a join on words.
ORACLE = {
    "op10_line_set_join": r"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM docs),
norm AS (SELECT doc_id, line_no, trim(lower(line), ' ') AS line FROM raw),
kept AS (SELECT * FROM norm WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
classes AS (
  SELECT line, min(struct_pack(d := doc_id, l := line_no)) AS pos, row_number() OVER (ORDER BY line) AS id FROM kept GROUP BY line),
sets AS (SELECT id, pos, list_distinct(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS ws FROM classes),
words AS (SELECT id, pos, len(ws) AS n, unnest(ws) AS w FROM sets),
pairs AS (
  SELECT b.id, any_value(b.pos) AS pos, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared
  FROM words a JOIN words b ON a.w = b.w AND a.pos < b.pos AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)
  GROUP BY a.id, b.id),
gone AS (
  SELECT k.doc_id, k.line_no FROM kept k JOIN classes c ON k.line = c.line WHERE k.doc_id <> c.pos.d OR k.line_no <> c.pos.l
  UNION
  SELECT pos.d, pos.l FROM pairs WHERE shared >= 0.8 * (n + m - shared) - 1e-9),
per AS (SELECT doc_id, count(*) AS c, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS r FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.ls), 0) AS n_lines, coalesce(per.c, 0) AS n_removed, coalesce(per.r, '') AS removed
FROM docs d LEFT JOIN per ON d.doc_id = per.doc_id
"""
}
