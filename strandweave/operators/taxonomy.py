"""Taxonomy trees as tables: `tax_id, parent_id, name, rank`, root 1, plus `old_id, new_id` of merged ids.

`lineage` materialises every node's path once; it is what other operators join.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written
from .ordering import HOT, before

ROOT = 1


def lineage(nodes: DataFrame) -> DataFrame:
    """`tax_id, name, rank, path, names, ranks`: ids, names and ranks from below the root to the node (TAX-03).

    Paths double in each round: what a node's path hangs on is replaced by that node's own path, so a tree of depth d
    takes log2 d joins. The root has empty lists; nodes that no path leads to are left out; a cycle is an error.
    """
    one = lambda c, kind: F.array(F.col(c).cast(kind))
    child = nodes.where((F.col("tax_id") != ROOT) & (F.col("parent_id") != F.col("tax_id")))
    state = child.select("tax_id", "name", "rank", F.col("parent_id").alias("up"), one("tax_id", "bigint").alias("path"), one("name", "string").alias("names"), one("rank", "string").alias("ranks"))
    left = None
    while True:
        state = written(state)
        open_ = state.where(F.col("up") != ROOT).count()
        if not open_:
            break
        if left is not None and open_ >= left:
            raise ValueError(f"{open_} nodes of the tree lie on a cycle")
        above = state.select(F.col("tax_id").alias("up"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in ("path", "names", "ranks")])
        hung = state.where(F.col("up") != ROOT).join(above, "up")  # nodes that hang on nothing fall out here
        hung = hung.select("tax_id", "name", "rank", F.col("_up").alias("up"), *[F.concat(f"_{c}", c).alias(c) for c in ("path", "names", "ranks")])
        state, left = state.where(F.col("up") == ROOT).unionByName(hung), open_
    empty = F.array()
    top = nodes.where(F.col("tax_id") == ROOT).select("tax_id", "name", "rank", empty.cast("array<bigint>").alias("path"), empty.cast("array<string>").alias("names"), empty.cast("array<string>").alias("ranks"))
    return top.unionByName(state.drop("up"))


def lineage_recursive(nodes: DataFrame) -> DataFrame:
    """`tax_id, depth, lineage` by a recursive query, for use where one plan is wanted."""
    nodes.createOrReplaceTempView("_taxon_nodes")
    return nodes.sparkSession.sql(
        f"""WITH RECURSIVE l(tax_id, depth, lineage) MAX RECURSION LEVEL 100 AS (
              SELECT tax_id, 0, CAST('' AS STRING) FROM _taxon_nodes WHERE tax_id = {ROOT}
              UNION ALL
              SELECT n.tax_id, l.depth + 1, CASE WHEN l.lineage = '' THEN n.name ELSE concat(l.lineage, '; ', n.name) END
              FROM _taxon_nodes n JOIN l ON n.parent_id = l.tax_id WHERE n.tax_id <> {ROOT})
            SELECT * FROM l"""
    )


def resolve(ids: DataFrame, lin: DataFrame, merged: DataFrame | None = None, col: str = "tax_id") -> DataFrame:
    """ids with the id that is valid now: itself where the tree knows it, else the one it was merged into; ids that neither leads to
    the tree become null (TAX-02)."""
    valid = lin.select(F.col("tax_id").alias("_known")).distinct()
    ids = ids.join(valid, ids[col] == valid["_known"], "left")
    if merged is None:
        return ids.withColumn(col, F.col("_known")).drop("_known")
    m = merged.join(valid.withColumnRenamed("_known", "_valid"), F.col("new_id") == F.col("_valid"), "left_semi").select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new"))
    return ids.join(m, ids[col] == m["_old"], "left").withColumn(col, F.coalesce("_known", "_new")).drop("_known", "_old", "_new")


def rank_name(rank: str, names: str = "names", ranks: str = "ranks", default: str = "Unknown") -> Column:
    """The deepest name of a rank on a lineage (TAX-04)."""
    hits = F.filter(F.arrays_zip(names, ranks), lambda x: x[ranks] == rank)
    return F.coalesce(F.get(hits, F.size(hits) - 1)[names], F.lit(default))


def annotate(df: DataFrame, lin: DataFrame, col: str = "taxid", sep: str = "; ") -> DataFrame:
    """df with taxname, species, lineage and lineage_ranks of an id; Unknown where there is none (TAX-12)."""
    dim = lin.select(
        F.col("tax_id").alias(col), F.col("name").alias("taxname"), rank_name("species").alias("species"), F.array_join("names", sep).alias("lineage"), F.array_join("ranks", sep).alias("lineage_ranks")
    )
    out = df.join(dim, col, "left")
    return out.fillna({"taxname": "Unknown", "species": "Unknown", "lineage": "Unknown", "lineage_ranks": "no rank"})


def ids_by_name(lin: DataFrame, names: Sequence[str]) -> DataFrame:
    """`name, tax_id` of names that exactly one node has; others are left out with a warning (TAX-08, Q21)."""
    found = lin.where(F.col("name").isin(list(names))).groupBy("name").agg(F.min("tax_id").alias("tax_id"), F.count("*").alias("n"))
    rows = found.collect()  # at most one row for each name asked for
    missing = set(names) - {r["name"] for r in rows if r["n"] == 1}
    if missing:
        warnings.warn(f"unknown or ambiguous taxon names: {', '.join(sorted(missing))}", stacklevel=2)
    return found.where("n = 1").select("name", "tax_id")


def subtree(lin: DataFrame, roots: DataFrame | Sequence[int]) -> DataFrame:
    """`tax_id` of the roots and all below them (TAX-05)."""
    if not isinstance(roots, DataFrame):
        roots = lin.sparkSession.createDataFrame([(int(r),) for r in roots], "root long")
    ids = lin.select("tax_id", F.explode(F.concat(F.array(F.lit(ROOT).cast("long")), "path")).alias("_on"))
    r = roots.toDF("_on").distinct()
    return ids.join(r, "_on", "left_semi").select("tax_id").distinct()


def siblings(nodes: DataFrame, lin: DataFrame, tax_id: int) -> DataFrame:
    """Nodes of the same rank below the same parent, without the node itself (TAX-07)."""
    me = nodes.where(F.col("tax_id") == tax_id).select(F.col("parent_id").alias("_p"), F.col("rank").alias("_r"))
    return nodes.join(me, (F.col("parent_id") == F.col("_p")) & (F.col("rank") == F.col("_r")), "left_semi").where(F.col("tax_id") != tax_id)


def allowed_ids(lin: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Ids that pass a filter by names: below an included name (all, if none is given) and below no excluded one (FLT-03)."""
    keep = subtree(lin, ids_by_name(lin, include).select("tax_id")) if include else lin.select("tax_id")
    return keep.join(subtree(lin, ids_by_name(lin, exclude).select("tax_id")), "tax_id", "left_anti") if exclude else keep


#: Most nodes of a tree whose paths may be broadcast.
BROADCAST_NODES = 100_000


def quorum_lca(
    df: DataFrame, lin: DataFrame, keys: Sequence[str], tax_id: str, *, weight: Column | None = None, order: Column | None = None, quorum: float = 0.9, majority: float = 0.9
) -> DataFrame:
    """`keys, taxid, score`: the deepest node that a quorum's majority lies below (TAX-06).

    Each row adds its weight at every depth of its path, the root being depth 0. At a depth, `tot` is the weight that
    reaches it and `top` that of its heaviest node. The deepest depth with tot >= quorum * total and top >= majority *
    tot decides; (1, 0) if there is none. Ties go to the node met first. Ids that the tree lacks don't count.

    Rows of one id are added up before they get their path, so a key has as many rows as ids at most. Paths of up to
    BROADCAST_NODES nodes are broadcast; then rows that are dealt by key already aren't shuffled again. Beyond that rows are shuffled by id, and by
    key with their paths before these are unfolded.
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    o = F.col(tax_id) if order is None else order
    path = lin.select(F.col("tax_id").alias("_id"), F.concat(F.array(F.lit(ROOT).cast("long")), "path").alias("_path"))
    rows = df.select(*keys, F.col(tax_id).cast("long").alias("_id"), w.alias("_w"), o.alias("_o"))
    rows = rows.groupBy(*keys, "_id").agg(F.sum("_w").alias("_w"), F.min("_o").alias("_o"))
    if path.count() <= BROADCAST_NODES:
        at = rows.join(F.broadcast(path), "_id", "left")
    else:
        at = rows.join(path, "_id", "left").repartition(*keys)
    at = at.select(*keys, "_w", "_o", F.posexplode_outer("_path").alias("depth", "node"))
    nodes = at.groupBy(*keys, "depth", "node").agg(F.sum("_w").alias("w"), F.min("_o").alias("first"))
    depths = nodes.groupBy(*keys, "depth").agg(F.sum("w").alias("tot"), F.min(F.struct((-F.col("w")).alias("neg"), "first", "node")).alias("best"))
    total = F.max(F.when(F.col("depth").isNotNull(), F.col("tot"))).over(Window.partitionBy(*keys))  # everything reaches the root
    eps = 1e-9
    good = F.col("depth").isNotNull() & (F.col("tot") >= F.col("total") * quorum - eps) & (-F.col("best.neg") >= F.col("tot") * majority - eps) & (F.col("tot") > 0)
    found = F.struct(F.col("best.node").alias("taxid"), (-F.col("best.neg") / F.col("tot")).alias("score"))
    deepest = depths.withColumn("total", total).groupBy(*keys).agg(F.max_by(found, F.when(good, F.col("depth"))).alias("s"))
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])  # rows without a key have no class of their own
    return deepest.select(*keys, F.coalesce(F.when(named, F.col("s.taxid")), F.lit(ROOT)).alias("taxid"), F.coalesce(F.when(named, F.col("s.score")), F.lit(0.0)).alias("score"))


def classify_contigs(hits: DataFrame, lin: DataFrame, *, keys=("sample", "qacc"), quorum: float = 0.9, majority: float = 0.9) -> DataFrame:
    """Bitscore-weighted LCA of each query over its distinct (taxid, bitscore) pairs (TAX-11, SET-03)."""
    pairs = hits.select(*keys, F.explode("staxids").alias("tax_id"), "bitscore", "ord").groupBy(*keys, "tax_id", "bitscore").agg(F.min("ord").alias("ord"))
    return quorum_lca(pairs, lin, keys, "tax_id", weight=F.col("bitscore"), order=F.col("ord"), quorum=quorum, majority=majority)


def blast_classify(hits: DataFrame, lin: DataFrame, *, quorum: float = 0.9, majority: float = 0.9) -> DataFrame:
    """`qacc, score, taxname, genus, lineage, ranks`, weighted by bitscore over all hits' first taxids (TAX-10)."""
    first = hits.where(F.size("staxids") > 0).select("qacc", F.get("staxids", 0).alias("tax_id"), "bitscore", "ord")
    out = quorum_lca(first, lin, ["qacc"], "tax_id", weight=F.col("bitscore"), order=F.col("ord"), quorum=quorum, majority=majority)
    dim = lin.select(F.col("tax_id").alias("taxid"), F.col("name").alias("taxname"), rank_name("genus").alias("genus"), F.array_join("names", "; ").alias("lineage"), F.array_join("ranks", "; ").alias("ranks"))
    return out.join(dim, "taxid", "left").select("qacc", F.round("score", 3).alias("score"), "taxname", "genus", "lineage", "ranks")


# ---- lineage strings


def prefixes(text: Column, sep: str = "; ") -> Column:
    """All prefixes of a lineage, longest first."""
    parts = F.split(text, sep)
    return F.transform(F.reverse(F.sequence(F.lit(1), F.size(parts))), lambda n: F.array_join(F.slice(parts, 1, n), sep))


#: After all strings that begin with what it follows.
_LAST = "\U0010ffff"


def _below_each(prefixes: DataFrame, rows: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(`prefix, lo, hi` of the prefixes that rows begin with, rows with their place `_at` in the order of text).

    Prefixes and rows are put in one range-partitioned order. Rows that begin with a prefix stand together in it, from the
    place where the prefix would stand to that of the last string it begins, so the number of rows before
    these two marks is all that is needed.
    """
    row = F.struct(*[F.col(c) for c in rows.columns])
    marks = prefixes.select("prefix").distinct()
    none = F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType)
    both = (
        rows.where(F.col(text).isNotNull()).select(F.col(text).alias("_s"), F.lit(1).alias("_kind"), F.lit(1).alias("_one"), F.lit(None).cast("string").alias("prefix"), row.alias("_row"))
        .unionByName(marks.select(F.col("prefix").alias("_s"), F.lit(0).alias("_kind"), F.lit(0).alias("_one"), "prefix", none.alias("_row")))
        .unionByName(marks.select(F.concat("prefix", F.lit(_LAST)).alias("_s"), F.lit(2).alias("_kind"), F.lit(0).alias("_one"), "prefix", none.alias("_row")))
    )
    placed = written(before(both, [], ["_s", "_kind"], sums={"_at": "_one"}))
    ends = placed.where("_kind <> 1").groupBy("prefix").agg(F.min("_at").alias("lo"), F.max("_at").alias("hi")).where("lo < hi")
    return ends, placed.where("_kind = 1").select("_row.*", "_at")


def in_ranges(points: DataFrame, ranges: DataFrame, at: str, lo: str, hi: str) -> DataFrame:
    """Pairs of a point and a range with lo <= at < hi, places being whole and not negative.

    A range is cut into at most two dyadic blocks of each size (at the sizes 1, 2, 4, ...), a point looks up the block
    of each size that occurs, so there are as many rows as pairs and as points times sizes. Blocks of over 1 / HOT of all
    places are few and joined by broadcast if they are, so a range over most points isn't one task.
    """
    a = lambda k: F.shiftrightunsigned(F.col(lo) + F.expr(f"shiftleft(1L, {k})") - 1, k)
    cut = []
    for k in range(48):
        left, right = a(k), F.shiftrightunsigned(F.col(hi), k)
        cut.append(F.when((left < right) & (left % 2 == 1), F.struct(F.lit(k).alias("k"), left.alias("block"))))
        cut.append(F.when((left < right) & (right % 2 == 1), F.struct(F.lit(k).alias("k"), (right - 1).alias("block"))))
    blocks = written(ranges.withColumn("_b", F.explode(F.filter(F.array(*cut), lambda x: x.isNotNull()))).withColumn("_k", F.col("_b.k")).withColumn("_block", F.col("_b.block")).drop("_b"))
    sizes = sorted(r["_k"] for r in blocks.select("_k").distinct().collect())  # 48 at most
    most = points.agg(F.coalesce(F.max(at), F.lit(0)) + 1).first()[0]
    names = [c for c in ranges.columns]
    out = None
    for big in (True, False):
        some = [k for k in sizes if (((1 << k) * HOT > most) == big)]
        if not some:
            continue
        own = blocks.where(F.col("_k").isin(some))
        own = F.broadcast(own) if big and own.count() <= BROADCAST_BLOCKS else own
        looked = points.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in some]))).withColumn("_block", F.expr(f"shiftrightunsigned({at}, _k)"))
        pairs = looked.join(own, ["_k", "_block"]).select(*points.columns, *names)
        out = pairs if out is None else out.unionByName(pairs)
    return out if out is not None else points.join(ranges, F.lit(False))


#: Most blocks that may be broadcast (a row is a prefix and four numbers).
BROADCAST_BLOCKS = 100_000


def prefix_rows(queries: DataFrame, table: DataFrame, query_col: str, table_col: str, sep: str = "; ", *, levels: int = 25, mode: str = "element") -> tuple[DataFrame, DataFrame]:
    """(`query_col, prefix`: the longest prefix of each distinct query lineage that any table row is below;
    table rows with each such `prefix` they are below) (TAX-14, JOI-08).

    A prefix is a lineage without its last elements. mode `element`: a row is below it if it has the same first elements,
    an equi-join of exploded prefixes. mode `string`: if its text begins with the prefix, which may end inside an element of
    the row: rows below a prefix are an interval of the sorted rows.
    """
    q = queries.select(F.col(query_col).alias("_q")).where("_q is not null").distinct()
    ups = written(q.select("_q", F.posexplode(F.slice(prefixes(F.col("_q"), sep), 1, levels)).alias("up", "prefix")))
    if mode == "string":
        ends, rows = _below_each(ups, table, table_col)
        known = ends = written(ends)
    else:
        own = table.withColumn("prefix", F.explode(prefixes(F.col(table_col), sep)))
        known = own.select("prefix").distinct()
    first = ups.join(known.select("prefix"), "prefix", "left_semi").groupBy("_q").agg(F.min_by("prefix", "up").alias("prefix"))
    chosen = written(first.select(F.col("_q").alias(query_col), "prefix"))
    used = chosen.select("prefix").distinct()
    if mode == "string":
        below = in_ranges(rows, ends.join(used, "prefix", "left_semi"), "_at", "lo", "hi").select(*table.columns, "prefix")
    else:
        below = own.join(used, "prefix", "left_semi").select(*table.columns, "prefix")
    return chosen, below


def longest_prefix(queries: DataFrame, table: DataFrame, query_col: str, table_col: str, sep: str = "; ", *, levels: int = 25, mode: str = "element") -> DataFrame:
    """For each distinct query lineage, all table rows below its longest prefix that has any; see prefix_rows."""
    chosen, below = prefix_rows(queries, table, query_col, table_col, sep, levels=levels, mode=mode)
    return chosen.join(below, "prefix")
