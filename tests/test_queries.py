import random

import pytest
from pyspark.sql import functions as F

from strandweave import queries


def order_lines(seed=11):
    """Lines of 60 orders, so that all 50 samples have hits, on few parts, so that hits overlap."""
    rng = random.Random(seed)
    return [(o, line, rng.randint(1, 12), rng.randint(1, 14), float(rng.randint(1, 50)), 1.0, "2020-01-01", 0.05, 0.0, rng.choice("RAN")) for o in range(1, 61) for line in range(1, rng.randint(3, 7))]


@pytest.fixture(scope="module")
def lines_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("lines"))
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate string, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame(order_lines(), schema).write.parquet(f"{at}/lineitem.parquet")
    parts = spark.range(1, 61).select(F.col("id").alias("p_partkey"), (F.col("id") * 7 % 50 + 1).cast("int").alias("p_size"))
    parts.write.parquet(f"{at}/part.parquet")
    return at


def plain_hits():
    """(sample, sacc, ord, qacc, lo, hi) of every line."""
    out = []
    for o, line, part, supp, n, *_ in order_lines():
        lo = (part * 37 + line * 101) % 5000 + 1
        out.append((o % 50, supp % 7, o * 1000 + line, o, lo, lo + int(n) * 4 - 1))
    return out


def test_region_segments_of_all_samples(spark, lines_dir):
    by = {}
    for sample, sacc, ord_, qacc, lo, hi in plain_hits():
        by.setdefault((sample, sacc), []).append((ord_, qacc, lo, hi))
    want = set()
    for key, own in by.items():
        cuts = sorted({p for _, _, lo, hi in own for p in (lo, hi + 1)})
        for a, b in zip(cuts, cuts[1:]):
            over = [str(q) for _, q, lo, hi in sorted(own) if lo <= a and hi >= b - 1]
            want.add((*key, a, b - 1, len(over), ",".join(over)))
    got = [tuple(r) for r in queries.region_segments(spark, lines_dir).collect()]
    assert len(got) == len(want) and set(got) == want and {r[0] for r in got} == set(range(50))


def test_overlaps_of_all_samples(spark, lines_dir):
    features = [(p % 7, p, p * 13 % 4800 + 1, p * 13 % 4800 + (p * 7 % 50 + 1) * 3) for p in range(1, 61)]
    want = {(sacc, ord_, f, max(lo, fs), min(hi, fe)) for _, sacc, ord_, _, lo, hi in plain_hits() for key, f, fs, fe in features if key == sacc and lo <= fe and fs <= hi}
    got = [tuple(r) for r in queries.interval_overlap_join(spark, lines_dir).collect()]
    assert len(got) == len(want) and set(got) == want and {r[1] // 1000 % 50 for r in got} - {0, 1, 2}
