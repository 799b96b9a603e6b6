import random

import pytest
from test_components import plain_selection

from strandweave.operators import chains, hits as H


def test_majority_prefilter(spark):
    rows = [("s", "q", 1, 100.0, False), ("s", "q", 2, 99.0, True), ("s", "q", 3, 95.0, False), ("s", "q", 4, 50.0, True), ("s", "r", 5, 80.0, True), ("s", "r", 6, 79.0, False)]
    df = spark.createDataFrame(rows, "sample string, qacc string, ord int, bitscore double, keep boolean")
    assert [r["ord"] for r in H.majority_prefilter(df).collect()] == [5]


def test_relative_score(spark):
    rows = [("s", "q", 1, "A", 100.0, 90.0), ("s", "q", 2, "B", 95.0, 90.0), ("s", "q", 3, "A", 80.0, 90.0)]
    df = spark.createDataFrame(rows, "sample string, qacc string, ord int, sacc string, score double, pident double")
    assert sorted(r["ord"] for r in H.relative_score_prefilter(df).collect()) == [1, 2]


def test_reads_homopolymers_and_classes(spark):
    h = spark.createDataFrame([("s", "q1"), ("s", "q2"), ("s", "q3")], "sample string, qacc string")
    cov = spark.createDataFrame([("s", "q1", 2), ("s", "q1", 1), ("s", "q2", 2)], "sample string, qacc string, numreads int")
    assert [r["qacc"] for r in H.min_reads(h, cov, 3).collect()] == ["q1"]
    qc = spark.createDataFrame([("q1", 0.15), ("q2", 0.151)], "acc string, frac_hp double")
    assert [r["qacc"] for r in H.max_homopolymer(h, qc, 15).collect()] == ["q1"]
    cls = spark.createDataFrame([("s", "q1", 5), ("s", "q2", 6)], "sample string, qacc string, taxid int")
    bad = spark.createDataFrame([(5,)], "tax_id int")
    assert sorted(r["qacc"] for r in H.class_prefilter(h, cls, bad).collect()) == ["q2", "q3"]


def test_keep_flag_needs_all_ids(spark):
    h = spark.createDataFrame([("s", "q", 1, [1, 2]), ("s", "q", 2, [1]), ("s", "q", 3, [])], "sample string, qacc string, ord int, staxids array<int>")
    ok = spark.createDataFrame([(1,)], "tax_id int")
    assert {r["ord"]: r["keep"] for r in H.keep_flag(h, ok).collect()} == {1: False, 2: True, 3: True}


def test_chain_metrics(spark):
    rows = [("s", "x", "q", 1, 30, 1, 10, 1, 10, 50.0, 80.0, "t", [3]), ("s", "x", "q", 2, 30, 11, 20, 6, 15, 60.0, 90.0, "t", [3])]
    df = spark.createDataFrame(rows, "sample string, sacc string, qacc string, ord int, qlen int, qstart int, qend int, sstart int, send int, score double, pident double, stitle string, staxids array<int>")
    m = chains.chain_metrics(df).first()
    assert (m["slen"], m["pident"], m["raw_score"], m["qlen"], m["contig_coverage"], m["n_frag"]) == (15, 86.7, 90.0, 30, 66.7, 2)
    reads = spark.createDataFrame([("s", "q", 4), ("s", "q", 3)], "sample string, qacc string, numreads int")
    qc = spark.createDataFrame([("q", 0.1, 0.5)], "acc string, frac_hp double, entropy2 double")
    m = chains.chain_metrics(df, reads=reads, qc=qc).first()
    assert (m["numreads"], m["pcthp"], m["entropy2"]) == (7, 10.0, 0.5)


@pytest.mark.parametrize("seed", range(3))
def test_selected_groups(spark, seed):
    rng = random.Random(seed)
    rows, ord_ = [], 0
    for s in range(18):
        for _ in range(rng.randint(1, 5)):
            ord_ += 1
            lo = rng.randint(1, 400)
            rows.append(("s", f"q{rng.randint(0, 24)}", f"x{s:02d}", ord_, 100, lo, lo + rng.randint(20, 90), float(rng.randint(30, 200))))
    df = spark.createDataFrame(rows, "sample string, qacc string, sacc string, ord int, qlen int, sstart int, send int, score double")
    want = {(b, p, s) for b, p, s, *_ in plain_selection([dict(zip(df.columns, r)) for r in rows])}
    assert {(r["bin"], r["position"], r["sacc"]) for r in chains.greedy_select(df).collect()} == want


def test_greedy_prunes_used_queries(spark):
    rows = [("s", "q1", "X", 1, 100, 1, 90, 200.0), ("s", "q2", "X", 2, 100, 101, 190, 200.0), ("s", "q2", "Y", 3, 100, 1, 90, 200.0), ("s", "q3", "Y", 4, 100, 95, 120, 50.0)]
    df = spark.createDataFrame(rows, "sample string, qacc string, sacc string, ord int, qlen int, sstart int, send int, score double")
    out = chains.greedy_select(df).orderBy("bin").collect()
    assert [(r["sacc"], r["n_queries"]) for r in out] == [("X", 2), ("Y", 1)]


def test_best_chain_and_alignment_filter(spark):
    rows = [("q", "A", 1, 100, 1, 50, 60.0), ("q", "B", 2, 100, 1, 80, 60.0), ("r", "A", 3, 100, 1, 10, 5.0)]
    df = spark.createDataFrame(rows, "qacc string, sacc string, ord int, qlen int, sstart int, send int, score double")
    best = chains.best_chain_per_query(df)
    assert {(r["qacc"], r["sacc"], r["slen"]) for r in best.collect()} == {("q", "A", 50), ("r", "A", 10)}
    assert [r["qacc"] for r in chains.alignment_filter(best, min_unaligned=60, max_aligned=1000).collect()] == ["r"]


def test_query_removal_and_builder(spark):
    h = spark.createDataFrame([("s", "q1", "A", 1, 1, 10), ("s", "q2", "A", 2, 8, 20), ("s", "q3", "A", 3, 25, 30)], "sample string, qacc string, sacc string, ord int, sstart int, send int")
    assert chains.without_queries(h, h.where("qacc = 'q1'")).count() == 2
    assert [r["chain"] for r in chains.build_chains(h).orderBy("ord").collect()] == [1, 2, 2]
