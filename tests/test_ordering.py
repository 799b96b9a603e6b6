import random

import pytest
from pyspark.sql import functions as F

from strandweave.operators import expression, ordering, taxonomy
from strandweave.operators.ordering import before, join_groups
from strandweave.operators.taxonomy import in_ranges


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small partitions stay apart, so that keys span them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows_of(n=600, seed=3):
    """One key holds most rows, so that it spans partitions; null keys and null values too."""
    rng = random.Random(seed)
    return [(None if k % 17 == 0 else "hot" if k % 5 else f"k{k % 4}", rng.randrange(10**6), k, None if rng.random() < 0.8 else rng.randrange(90)) for k in range(n)]


def test_what_came_before_in_a_key(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, "key string, at int, id int, v int").repartition(4)
    out = before(df, ["key"], ["at", "id"], sums={"total": "v"}, highs={"top": "v"}, lasts={"last": "v"}).collect()
    state, want = {}, {}
    for key, at, id_, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        total, top, last = state.get(key, (0, None, None))
        want[id_] = (total, top, last)
        if v is not None:
            state[key] = (total + v, v if top is None else max(top, v), v)
    assert {r["id"]: (r["total"], r["top"], r["last"]) for r in out} == want


def test_a_hot_key_is_in_many_partitions(spark, monkeypatch):
    seen = []
    real = ordering.written
    monkeypatch.setattr(ordering, "written", lambda df: seen.append(real(df)) or seen[-1])
    df = spark.createDataFrame(rows_of(4000), "key string, at int, id int, v int").repartition(8)
    expression.percentiles(df, "at", ["key"]).collect()
    parts = seen[0].where("key = 'hot'").groupBy("_part").count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 2000


@pytest.mark.parametrize("hot", [2, 10_000])
def test_groups_joined(spark, monkeypatch, hot):
    monkeypatch.setattr(ordering, "HOT", hot)
    df = spark.createDataFrame(rows_of(200), "key string, at int, id int, v int")
    groups = df.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for how in ("inner", "left"):
        out = join_groups(df, groups, ["key"], "n", how).collect()
        top = {k: max(r[2] for r in rows_of(200) if r[0] == k) for k in {r[0] for r in rows_of(200)}}
        assert len(out) == 200 and all(r["top"] == top[r["key"]] for r in out)


def test_percentiles_and_ranks(spark):
    import numpy as np

    rows = [(k, float(v % 37)) for k in ("a", "b", None) for v in range({"a": 400, "b": 1, None: 6}[k])] + [("c", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r["k"]: r for r in expression.percentile_stats(df, "v", ["k"]).collect()}
    for k in ("a", "b", None):
        own = [v for key, v in rows if key == k and v is not None]
        assert [got[k][f"p{p:02d}"] for p in (1, 5, 25, 50, 75, 95, 99)] == pytest.approx(list(np.percentile(own, [1, 5, 25, 50, 75, 95, 99])))
        assert (got[k]["min"], got[k]["max"]) == (min(own), max(own))
    assert got["c"]["p50"] is None and len(got) == 4
    assert expression.percentile_stats(df, "v").first()["p50"] == np.median([v for _, v in rows if v is not None])
    ranks = {(r["k"], r["v"]): r["rank"] for r in expression.average_rank(df, "v", ["k"]).collect()}
    own = sorted(v for key, v in rows if key == "a" and v is not None)
    assert all(ranks["a", v] == own.index(v) + (own.count(v) + 1) / 2 for v in set(own)) and ranks["c", None] is None


def test_points_in_ranges(spark):
    rng = random.Random(8)
    ranges = [(k, lo, lo + rng.choice([0, 1, 2, 7, 60, 300])) for k in range(60) for lo in [rng.randrange(300)]]
    points = spark.range(300).select(F.col("id").alias("at"))
    got = sorted((r["at"], r["name"]) for r in in_ranges(points, spark.createDataFrame(ranges, "name int, lo long, hi long"), "at", "lo", "hi").collect())
    assert got == sorted((p, k) for k, lo, hi in ranges for p in range(300) if lo <= p < hi)


def test_string_prefixes_equal_comparing_all(spark):
    rng = random.Random(4)
    names = ["A", "Ab", "A+", "B", "B1", "B10", "Ü", "ÜZ", "[x]"]
    lineage = lambda: "; ".join(rng.choice(names) for _ in range(rng.randint(1, 4)))
    table, queries = [(lineage(), k) for k in range(80)] + [(None, 99)], sorted({lineage() for _ in range(60)} | {"C; d"})
    want = set()
    for q in queries:
        parts = q.split("; ")
        for n in range(len(parts), 0, -1):
            hit = {(q, h) for t, h in table if t is not None and t.startswith("; ".join(parts[:n]))}
            if hit:
                want |= hit
                break
    out = taxonomy.longest_prefix(spark.createDataFrame([(q,) for q in queries], "lineage string"), spark.createDataFrame(table, "known string, host int"), "lineage", "known", mode="string")
    got = [(r["lineage"], r["host"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
