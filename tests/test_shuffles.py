"""What is shuffled, held by a task, or done again, and that the other ways to the same rows agree."""

import random

from pyspark.sql import functions as F

from strandweave.operators import chains, intervals as I, ordering, taxonomy as T
from strandweave.plans import commands


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


def rows(df):
    return sorted(df.collect(), key=str)


def test_stream_state_is_held_by_buckets(spark, tmp_path):
    from strandweave.streaming import stateful

    big = (1 << 60) + 1
    data = [(k if k % 7 else None, v, big + o) for k in range(200) for o, v in enumerate((big, big, None, None, big))]
    schema = "qacc long, sacc long, ord long"
    for n, at in enumerate((data[:500], data[500:])):
        spark.createDataFrame(at, schema).write.parquet(str(tmp_path / f"in/batch={n}"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in/batch=*"))
    q = stateful.islands(stream, ["qacc"], buckets=4).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).format("parquet").start(str(tmp_path / "out"))
    q.awaitTermination()
    assert max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) <= 4
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.where("qacc is not null").select("qacc", "sacc", "ord", "island").collect(), key=str) == sorted(((k, v, big + o, i) for k in range(200) if k % 7 for o, (v, i) in enumerate(((big, 1), (big, 1), (None, 2), (None, 3), (big, 4)))), key=str)


def test_rows_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    df = spark.range(1000).withColumn("k", F.col("id") % 300)
    assert ordering.dealt(df, ["k"]) is df
    monkeypatch.setattr(ordering, "TASK_ROWS", 100)
    dealt = ordering.dealt(df, ["k"])
    assert dealt.rdd.getNumPartitions() == 10
    assert shuffles(dealt.groupBy("k").count()) == 1


def test_axis_is_made_behind_one_shuffle_and_both_ways_to_it_agree(spark, monkeypatch):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), s, s + rng.randrange(30)) for s in (rng.randrange(2000) for _ in range(80))]
    axis = I.compressed_axis(spark.createDataFrame(data, "k string, start long, end long"), ["k"], 20)
    assert shuffles(axis) == 1
    points = spark.createDataFrame([(rng.choice(["a", "b", "c", None]), n, rng.choice([None, rng.randrange(-50, 2500)])) for n in range(300)], "k string, n long, pos long")
    one = [rows(I.to_axis(points, axis, ["k"], "pos", back)) for back in (False, True)]
    monkeypatch.setattr(I, "KEY_ROWS", 150)
    assert [rows(I.to_axis(points, axis, ["k"], "pos", back)) for back in (False, True)] == one
    monkeypatch.setattr(I, "KEY_ROWS", 0)
    assert [rows(I.to_axis(points, axis, ["k"], "pos", back)) for back in (False, True)] == one


def test_lca_of_rows_dealt_by_key_shuffles_nothing_more(spark, monkeypatch):
    nodes = spark.createDataFrame([(1, 1, "root", "no rank")] + [(k, max(1, k // 3), f"n{k}", "r") for k in range(2, 60)], "tax_id long, parent_id long, name string, rank string")
    lin = T.lineage(nodes)
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.randrange(40), rng.randrange(1, 70), float(rng.randrange(1, 9)), n) for n in range(400)], "k long, t long, w double, o long").repartition("k")
    lca = lambda: T.quorum_lca(df, lin, ["k"], "t", weight=F.col("w"), order=F.col("o"), majority=0.5)
    assert shuffles(lca()) == 1  # the one that dealt them
    small = rows(lca())
    assert len(small) == df.select("k").distinct().count()
    monkeypatch.setattr(T, "BROADCAST_NODES", 0)
    assert rows(lca()) == small


def _hits(spark):
    rng = random.Random(5)
    data = [(rng.randrange(3), rng.randrange(40), rng.randrange(7), n, 500, 1 + s, s + 40, 1 + s, s + 40, float(rng.randrange(1, 60)), 99.0) for n, s in enumerate(rng.randrange(300) for _ in range(500))]
    return spark.createDataFrame(data, "sample long, qacc long, sacc long, ord long, qlen long, qstart long, qend long, sstart long, send long, score double, pident double")


def test_best_chain_takes_one_shuffle(spark):
    hits = _hits(spark)
    assert shuffles(chains.best_chain_per_query(hits.repartition("qacc"))) == 1
    assert shuffles(commands.filter_blast(hits.repartition("qacc"), spark.range(50).toDF("acc"))) <= 3
    best = {r["qacc"]: r["slen"] for r in chains.best_chain_per_query(hits).collect()}
    want = {(r["qacc"], r["sacc"]): r["slen"] for r in I.union_length(hits, ["qacc", "sacc"], "sstart", "send", "slen").collect()}
    assert all(want[r["qacc"], r["sacc"]] == best[r["qacc"]] for r in chains.best_chain_per_query(hits).collect())


def test_greedy_rounds_do_not_shuffle_by_chain(spark, monkeypatch):
    hits = _hits(spark)
    assert "SortMergeJoin" not in plan(chains.query_scores(hits))
    found = rows(chains.greedy_select(hits))
    monkeypatch.setattr(chains, "HOT", -1)
    assert rows(chains.greedy_select(hits)) == found


def test_sheets_begin_with_calls_that_are_joined_once(spark):
    calls = spark.createDataFrame([("s", "a", "Sp", 1, "Influenza", "Viruses; F; Sp", 99.0, 90.0, 1000, 900, 5)], "sample string, sacc string, species string, taxid long, taxname string, lineage string, contig_coverage double, pident double, genome_size long, slen long, numreads long")
    part = lambda c: spark.createDataFrame([("s", "a", 500.0)], f"sample string, sacc string, {c} double")
    vhdb = spark.createDataFrame([(1, "Viruses; F", "Sp", "host", "E; host")], "virus_tax_id long, virus_lineage string, virus_name string, host_name string, host_lineage string")
    sheets = commands.full_report(calls, part("numreads"), part("bp"), spark.createDataFrame([("s", "a", 1.0)], "sample string, sacc string, pcthp double"), vhdb)
    assert "Join" not in plan(sheets["Calls"])
    assert {r["description"]: r["count"] for r in sheets["Summary"].collect()}["Calls"] == 1


def test_overlap_join_broadcasts_a_counted_side_and_deals_large_keys_over_slices(spark, monkeypatch):
    rng = random.Random(8)
    make = lambda n, width: [(rng.choice("aab"), n, s, s + rng.randrange(width)) for n, s in enumerate(rng.randrange(300) for _ in range(n))]
    left, right = make(300, 40), make(80, 60)
    a, b = (spark.createDataFrame(x, "key string, id long, start long, end long") for x in (left, right))
    want = sorted((k, i, j, max(s, t), min(e, f)) for k, i, s, e in left for q, j, t, f in right if k == q and s <= f and t <= e)
    for bin_width, held in ((None, 80), (50, 1000), (None, 79), (50, 79)):
        monkeypatch.setattr(I, "HELD_ROWS", held, raising=False)
        out = I.overlap_join(a, b, ["key"], bin_width=bin_width).select("key", "a_id", "b_id", "start", "end")
        assert sorted(map(tuple, out.collect())) == want
        assert ("BroadcastHashJoin" in plan(out)) == (held >= 80), plan(out)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    one_key = I.overlap_join(a.where("key = 'a'"), b.where("key = 'a'"), ["key"])
    pieces = one_key.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset(coalesce)
    assert len(pieces) > 1 and sum(r["count"] for r in pieces) == sum(w[0] == "a" for w in want)


def _taxa(spark):
    nodes = [(1, 1, "root", "no rank"), (2, 1, "A", "phylum"), (3, 1, "B", "phylum")] + [(k, 2 + k % 2, f"n{k}", "species") for k in range(4, 30)]
    return T.lineage(spark.createDataFrame(nodes, "tax_id long, parent_id long, name string, rank string"))


def _named_hits(spark):
    """Hits of queries that bear one name in several samples, some without a sample, taxa or a known taxon."""
    rng = random.Random(6)
    data = []
    for n in range(400):
        taxa = rng.choice([None, [], [None], *[[rng.randrange(4, 33) for _ in range(rng.randrange(1, 4))] for _ in range(9)]])
        data.append((rng.choice([0, 1, 2, None]), rng.randrange(30), rng.randrange(5), n, float(rng.randrange(1, 60)), float(rng.randrange(1, 60)), float(rng.randrange(80, 100)), taxa))
    return spark.createDataFrame(data, "sample long, qacc long, sacc long, ord long, score double, bitscore double, pident double, staxids array<bigint>")


def test_reads_and_homopolymers_are_filtered_at_once(spark):
    from strandweave.operators import hits as H

    hits, rng = _named_hits(spark), random.Random(7)
    coverage = spark.createDataFrame([(rng.choice([0, 1, 2, None]), rng.randrange(35), rng.choice([None, *range(6)])) for _ in range(200)], "sample long, qacc long, numreads long")
    qc = spark.createDataFrame([(q, rng.choice([None, 0.1, 0.15, 0.3])) for q in range(40) if q % 9], "acc long, frac_hp double")
    want = H.max_homopolymer(H.min_reads(hits, coverage, 5), qc, 15).select(hits.columns)
    got = H.read_and_simple(hits.repartition("qacc"), coverage, 5, qc, 15)
    assert rows(got) == rows(want) and 0 < want.count() < hits.count() and got.columns == hits.columns
    assert "hashpartitioning(sample" not in plan(got)


def test_flags_of_taxa_agree_both_ways(spark, monkeypatch):
    from strandweave.operators import hits as H

    hits, lin = _named_hits(spark), _taxa(spark)
    allowed = T.allowed_ids(lin, (), ("A",))
    found = rows(H.keep_flag(hits, allowed).select("ord", "keep"))
    monkeypatch.setattr(H, "BROADCAST_NODES", -1, raising=False)
    assert rows(H.keep_flag(hits, allowed).select("ord", "keep")) == found and {r["keep"] for r in found} == {True, False} and len(found) == 400


def test_prefilters_do_not_shuffle_hits_that_are_dealt_by_query(spark):
    hits, lin = _named_hits(spark), _taxa(spark)
    dealt = commands.prefilter(hits.repartition("qacc"), lin, hit_excludes=("n5",), class_excludes=("A",))
    assert "hashpartitioning(sample" not in plan(dealt)
    from strandweave.operators import hits as H

    classes, excluded = T.classify_contigs(hits, lin), T.subtree(lin, T.ids_by_name(lin, ("A",)).select("tax_id"))
    bad = {(r["sample"], r["qacc"]) for r in classes.join(excluded.withColumnRenamed("tax_id", "taxid"), "taxid", "left_semi").collect()}
    left = H.class_prefilter(hits, classes, excluded).collect()
    assert sorted(r["ord"] for r in left) == sorted(r["ord"] for r in hits.collect() if r["sample"] is None or (r["sample"], r["qacc"]) not in bad) and 0 < len(left) < 400


def test_means_over_segments_of_several_columns(spark):
    rng = random.Random(9)
    data = [(rng.choice("ab"), s, s + rng.randrange(30), float(rng.randrange(60, 99)), rng.choice([None, rng.random()])) for s in (rng.randrange(400) for _ in range(150))]
    df = spark.createDataFrame([*data, ("c", 1, 9, 70.0, None)], "k string, s long, e long, p double, f double")
    got = {r["k"]: (r["p"], r["f"]) for r in I.weighted_over_segments_of(df, ["k"], "s", "e", {"p": "max", "f": "avg"}, {"p": 1, "f": 9}).collect()}
    one = lambda c, how, digits: {r["k"]: r["value"] for r in I.weighted_over_segments(df.where(F.col(c).isNotNull()), ["k"], "s", "e", c, how=how, digits=digits).collect()}
    p, f = one("p", "max", 1), one("f", "avg", 9)
    assert got == {k: (p[k], f.get(k)) for k in "abc"} and got["c"] == (70.0, None)
