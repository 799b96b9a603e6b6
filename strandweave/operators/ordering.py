"""Numbers of rows in a global order without gathering them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def numbered(df: DataFrame, order: Sequence[str], name: str = "_number") -> DataFrame:
    """df with each row's place, from 0, in the order: range partitions are numbered inside and offset by the sizes of those before."""
    dealt = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.join(F.broadcast(sizes.select("_part", before.alias("_base"))), "_part").withColumn(name, F.col("_base") + inside).drop("_part", "_base")


#: Rows that a task of `dealt` gets on average, at most.
TASK_ROWS = 250_000


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df as it is, or, where shuffles into the session's number of tasks would give one over TASK_ROWS rows, dealt by keys to as
    many tasks as that takes. So a task's memory doesn't grow with the table; what is grouped by these keys next needs no shuffle."""
    tasks = -(-df.count() // TASK_ROWS)
    return df if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(tasks, *keys)


#: Groups joined by broadcast are those with over 1 / HOT of all rows: there can't be more than HOT of them.
HOT = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], n: str, how: str = "inner") -> DataFrame:
    """rows with the other columns of their group; groups has one row for each combination of keys, null being a value, and
    how many rows share it (n).

    Groups with over 1 / HOT of all rows are joined by broadcast, so that no task gets all rows of one; the rest by shuffle.
    """
    if not keys:
        return rows.join(F.broadcast(groups))  # one group
    more = [c for c in groups.columns if c not in keys]
    named = groups.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *more)
    on = lambda a: [a[k].eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    total, count = named.agg(F.coalesce(F.sum(n), F.lit(0)), F.count("*")).first()
    if count <= HOT:
        return rows.join(F.broadcast(named), on(rows), how).select(*rows.columns, *more)
    hot, rest = named.where(F.col(n) * HOT > total), named.where(F.col(n) * HOT <= total)
    often = rows.join(F.broadcast(hot), on(rows)).select(*rows.columns, *more)
    others = rows.join(F.broadcast(hot), on(rows), "left_anti")
    return often.unionByName(others.join(rest, on(others), how).select(*rows.columns, *more))


def before(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, sums: dict[str, str] | None = None, highs: dict[str, str] | None = None, lasts: dict[str, str] | None = None) -> DataFrame:
    """df with, over the rows of the same keys that come before in the order: sums (0 if none), maxima and last values
    that aren't null (null if none) of columns, given as {new name: column}.

    What a window by key gives, without a key's rows in one task: rows are range-partitioned by keys and order and
    written; windows run inside partitions; a key that begins in an earlier partition, one in each partition at most,
    gets what these hold by a broadcast row. Rows that are equal in keys and order come in any order.
    """
    sums, highs, lasts = sums or {}, highs or {}, lasts or {}
    dealt = written(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    found = {
        **{k: (F.sum(c), F.sum, F.sum(c)) for k, c in sums.items()},
        **{k: (F.max(c), F.max, F.max(c)) for k, c in highs.items()},
        **{k: (F.last(c, ignorenulls=True), lambda x: F.last(x, ignorenulls=True), F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v"))))["_v"]) for k, c in lasts.items()},
    }
    whole = dealt.groupBy("_part", *keys).agg(*[last.alias(k) for k, (_, _, last) in found.items()])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition that a key is in
    carried = whole.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("_part")))
    carried = carried.select("_part", *keys, "_place", *[again(k).over(earlier).alias(f"_c_{k}") for k, (_, again, _) in found.items()]).where("_place > 1").drop("_place")
    carried = carried.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[f"_c_{k}" for k in found])
    on = [dealt["_part"] == F.col("_p"), *[dealt[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]]
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(carried), on, "left")
    own = {k: now.over(inside) for k, (now, _, _) in found.items()}
    put = {k: F.coalesce(own[k], F.lit(0)) + F.coalesce(f"_c_{k}", F.lit(0)) for k in sums} | {k: F.greatest(own[k], f"_c_{k}") for k in highs} | {k: F.coalesce(own[k], f"_c_{k}") for k in lasts}
    return out.select(*df.columns, *[c.alias(k) for k, c in put.items()])
