import gzip

import pytest
from pyspark.sql import functions as F

from strandweave.operators import expression as E
from strandweave.operators import report as R
from strandweave.plans import commands
from strandweave.sources import readers, writers
from strandweave.streaming import stateless


def test_cascade_counts_each_rule(spark):
    ok = dict(bp=500, contig_coverage=90.0, numreads=5, pident=90.0, pcthp=1.0)
    bad = [{"bp": 100}, {"contig_coverage": 1.0}, {"numreads": None}, {"pident": 60.0}, {"pcthp": 13.0}, {}]
    rows = spark.createDataFrame([{**ok, **b} for b in bad], "bp int, contig_coverage double, numreads int, pident double, pcthp double")
    kept, removed = R.threshold_cascade(rows, R.default_rules())
    assert kept.count() == 1 and [r["removed"] for r in removed.orderBy("step").collect()] == [1] * 5


def test_scaffold_ids_and_segments(spark):
    df = spark.createDataFrame([("s1.NC_1_2_pilon",), ("s1.NC_001802_3_pilon",), ("s1.ACC.more",)], "a string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for c, n in zip(R.parse_scaffold_id(F.col("a")), "abc")]).collect()]
    assert got[1] == ("s1", "NC_001802", "3") and got[2] == ("s1", "ACC", None)
    seg = spark.createDataFrame([("s", "a", 1, 9, 10), ("s", "a", 1, 9, 10), ("s", "a", 10, 19, 5)], "sample string, sacc string, sstart int, send int, bp int")
    assert R.segment_bp(seg).first()["bp"] == 15


def test_hosts(spark):
    db = spark.createDataFrame([(1, "V; A", "x", "man", "E; M; P"), (1, "V; A", "x", "ape", "E; M; P"), (2, "V; A", "y", "bat", "E; M; C"), (3, "V; B", "z", None, None)], "virus_tax_id long, virus_lineage string, virus_name string, host_name string, host_lineage string")
    calls = spark.createDataFrame([(1, "V; A; x"), (9, "V; A; y; deep"), (8, "Q")], "taxid long, lineage string")
    got = {r["taxid"]: r["host"] for r in R.annotate_hosts(calls, db).collect()}
    assert got == {1: "ape; man", 9: "bat", 8: None}


def test_merges(spark):
    c = spark.createDataFrame([("s1", "v", "b", 5, "x"), ("s1", "v", "a", 7, "y"), ("s2", "v", "a", 20, "z")], "sample string, species string, taxname string, numreads long, sacc string")
    m = R.merge_species(c)
    assert {(r["sample"], r["taxnames"], r["numreads"], r["saccs"]) for r in m.collect()} == {("s1", "a, b", 12, "x;y"), ("s2", "a", 20, "z")}
    # identity by subject length, homopolymer share and entropy by scaffold length, the largest scaffold; lists as met
    full = spark.createDataFrame(
        [("s", "v", 1, 100, 80.0, 10, 2.0, 0.5, 50.0, 1, -3.0, "b", "2;10", 10), ("s", "v", 2, 300, 90.0, 30, 4.0, 1.0, None, 2, -9.5, "a", "9", 9), ("s", "w", 9, 5, 70.0, 1, 0.0, 0.0, 1.5, 1, -1.0, "c", "1", 1)],
        "sample string, species string, numreads long, bp long, pident double, slen long, pcthp double, entropy double, genome_coverage double, n_frag int, log_evalue double, sacc string, staxids string, taxid long",
    )
    v = R.merge_species(full, order=("numreads",)).where("species = 'v'").first()
    assert (v["max_bp"], v["pident"], v["pcthp"], v["entropy"], v["min_log_evalue"]) == (300, 87.5, 3.5, 0.875, -9.5)
    assert (v["genome_coverages"], v["bps"], v["n_frags"], v["saccs"], v["staxids"], v["taxids"]) == ("50;NA", "100;300", "1;2", "b;a", "10, 2, 9", "9, 10")
    one = R.merge_samples(R.merge_species(full, order=("numreads",))).first()
    assert (one["sample"], one["numreadss"], one["saccs"], one["max_bps"], one["pidents"]) == ("s", "9 | 3", "c | b;a", "5 | 300", "70 | 87.5")
    flagged = R.flag_respiratory(spark.createDataFrame([("human RHINOvirus", 1), ("other", 2)], "taxname string, n int"))
    assert flagged.columns == ["taxname", "respiratory", "n"] and [r["respiratory"] for r in flagged.orderBy("n").collect()] == [True, False]
    assert R.drop_redundant_unit(c.withColumn("unit", F.col("sample"))).columns == c.columns
    assert [r["count"] for r in R.summary([("all", c, "t"), ("few", c.where("numreads < 6"), "t")]).orderBy("step").collect()] == [3, 1]
    assert R.whitelisted(c.withColumn("species", F.lit("Human Rhino")), ["rhino$"]).count() == 3
    assert R.properties(spark, {"a": [1, 2], "b": "x"}).count() == 2 and "Read Count" in R.displayed(c).columns


def test_expression(spark):
    x = spark.createDataFrame([("f1", "s1", 4.0, 1.0, 10.0), ("f2", "s1", 0.0, 0.0, 20.0), ("f1", "s2", 8.0, 3.0, 30.0), ("f2", "s2", 2.0, 1.0, 40.0)], "feature_id string, sample string, counts double, abundance double, length double")
    z = E.zero_fill(x, spark.createDataFrame([("s3",)], "sample string"))
    assert z.count() == 6 and z.where("sample = 's3' and feature_id = 'f1'").first()["length"] == 20.0
    assert E.size_factors(x).count() == 2 and E.log_pca(x, 1).count() == 2
    g = E.gene_summary(x, spark.createDataFrame([("f1", "g"), ("f2", "g")], "feature_id string, gene_id string")).where("sample = 's2'").first()
    assert (g["counts"], g["length"]) == (10.0, 32.5)
    w = E.to_wide(x, ["feature_id"], "sample", "counts")
    assert E.to_long(w, ["feature_id"], "sample", "counts").count() == 4
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "k string, c string, v int")
    assert E.collapse(df, ["k"]).first()["v"] == "1;2" and E.split_constant(df)[0] == {"k": "a", "c": "x"}
    with pytest.raises(ValueError):
        E.assert_constant(df, ["v"])
    assert E.id_columns(df, spark.createDataFrame([("1",), ("2",)], "id string")) == ["v"]
    assert E.drop_empty_columns(df.withColumn("n", F.lit(None).cast("int"))).columns == ["k", "c", "v"]
    q = E.sample_qc(x.withColumnRenamed("feature_id", "gene_id"), spark.createDataFrame([("f1", "MT-1", "protein_coding"), ("f2", "g", "lncRNA")], "gene_id string, gene_name string, biotype string")).where("sample = 's2'").first()
    assert (q["pct_mito"], q["n_expressed"]) == (80.0, 2)
    jobs = E.job_table(spark.createDataFrame([("x/benchmarks/st/proj.a.b/s1.p.txt", 1.0)], "path string, s double")).first()
    assert (jobs["stage"], jobs["project"], jobs["stack"], jobs["sample"], jobs["part"]) == ("st", "proj", "a.b", "s1", "p")


def test_readers(spark, tmp_path):
    text = "# BLASTN 2\n# Query: q\n# Database: d\n# Fields: query acc., subject acc., q. start, subject tax ids, odd one\n# 2 hits found\nq\ts\t5\t1;2\tz\nq\tt\t6\tN/A\ty\n"
    with gzip.open(tmp_path / "S.1.blast7.gz", "wt") as f:
        f.write(text)
    rows = readers.blast7(spark, str(tmp_path / "*.gz")).orderBy("ord").collect()
    assert [(r["sample"], r["qacc"], r["sacc"], r["qstart"], r["staxids"], r["odd one"]) for r in rows] == [("S.1", "q", "s", 5, [1, 2], "z"), ("S.1", "q", "t", 6, [], "y")]
    assert readers.is_blast7(spark, str(tmp_path / "S.1.blast7.gz"))
    (tmp_path / "empty.blast7").write_text("")
    assert readers.blast7(spark, str(tmp_path / "empty.blast7")).count() == 0
    (tmp_path / "a.fa").write_text(">x one two\nACG\nTT\n>y\nGG\n>x again\nA\n")
    fa = {r["acc"]: (r["comment"], r["seq"]) for r in readers.fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert fa == {"x": ("again", "A"), "y": ("", "GG")}
    for name, body in (("names", "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tAlpha\t|\t\t|\tscientific name\t|\n2\t|\tal\t|\t\t|\tsynonym\t|\n"), ("nodes", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tgenus\t|\n"), ("merged", "9\t|\t2\t|\n")):
        (tmp_path / f"{name}.dmp").write_text(body)
    nodes, merged = readers.taxonomy(spark, f"{tmp_path}/")
    assert sorted(tuple(r) for r in nodes.collect()) == [(1, 1, "root", "no rank"), (2, 1, "Alpha", "genus")] and merged.first()["new_id"] == 2
    (tmp_path / "g.gtf").write_text('c\tx\texon\t1\t9\t.\t+\t.\tgene_id "g1"; tag "a"; tag "b";\n')
    assert readers.gtf(spark, str(tmp_path / "g.gtf")).first()["attributes"]["gene_id"] == "g1"
    (tmp_path / "sheet.csv").write_text("unit,sample,fq1\nA1,A,x\nA2,A\n")
    assert [r["fq1"] for r in readers.sample_sheet(spark, str(tmp_path / "sheet.csv")).orderBy("unit").collect()] == ["x", None]


def test_features(spark):
    lines = [">Feature ref|AB1.2|", "<1\t500\tgene", "\t\t\tgene\tpol", "10\t20\tCDS", "30\t>40", "\t\t\tproduct\tP", "\t\t\tpseudo", "800\t700\tmisc", ">Feature XY2", "5\t9\tgene"]
    df = spark.createDataFrame([("f", k, v) for k, v in enumerate(lines)], "file string, pos long, value string")
    got = {tuple(r) for r in readers.parse_features(df).collect()}
    assert got == {
        ("AB1", 1, 500, "gene", "gene", "pol"), ("AB1", 10, 20, "CDS", "product", "P"), ("AB1", 10, 20, "CDS", "pseudo", ""), ("AB1", 30, 40, "CDS", "product", "P"), ("AB1", 30, 40, "CDS", "pseudo", ""),
        ("AB1", 700, 800, "misc", None, None), ("AB1", 700, 800, "misc", "_reversed", ""), ("XY2", 5, 9, "gene", None, None),
    }
    assert readers.select_features(readers.parse_features(df), ["CDS/product", "gene/*"]).where("key is not null").count() == 3


def test_writers_round_trip(spark, tmp_path):
    rec = spark.createDataFrame([("a", "c1", "ACGT", 1), ("a", "", "GG", 2), ("b", "x", "T", 3)], "acc string, comment string, seq string, ord int")
    writers.fasta(rec, str(tmp_path / "out"))
    back = {r["acc"]: r["seq"] for r in readers.fasta(spark, str(tmp_path / "out")).collect()}
    assert back == {"a": "ACGT", "a_1": "GG", "b": "T"}
    kept, n = writers.filter_records(rec, spark.createDataFrame([("a",)], "acc string"), keep=False)
    assert [r["acc"] for r in kept.collect()] == ["b"] and tuple(n.first()) == (3, 1)
    assert writers.sheets({"By Sample Name": rec}, str(tmp_path))[0].endswith("result_by_sample name.csv")


def test_commands(spark):
    contigs = spark.createDataFrame([("q1", "ACGTACGTAC"), ("q2", "AAAAAAAAAA")], "acc string, seq string")
    qc = {r["acc"]: r for r in commands.fasta_qc(contigs, ks=(1, 2)).collect()}
    assert qc["q1"]["entropy1"] > 0.9 and qc["q2"]["frac_hp"] == 1.0
    calls = spark.createDataFrame([("s", "A", "Virus x", "Viruses; A")], "sample string, sacc string, species string, lineage string")
    hits = spark.createDataFrame([("s", "A", "q1", 1, 10, 1, 10, "10", 1)], "sample string, sacc string, qacc string, qstart int, qend int, sstart int, send int, btop string, ord int")
    out = commands.export_fasta(calls, hits, contigs, lineage="Vir", bin_by="species")
    assert out["sequences"].first()["seq"] == "ACGTACGTAC" and out["mapping"].first()["bin"] == "Virus_x"
    records = spark.createDataFrame([("s.A_pilon", "ACGT")], "acc string, seq string")
    assert commands.find_bins(calls, records)[1].first()["bin"] == "Virus_x"
    taken, missing = commands.prepare_phylo(records.withColumn("acc", F.lit("AB1.1")), spark.createDataFrame([("AB1.2", "A"), ("CD.1", "C")], "acc string, seq string"), min_bp=10, include_short=True)
    assert sorted(r["acc"] for r in taken.collect()) == ["AB1.1_partial", "CD.1"] and [r["acc"] for r in missing.collect()] == ["AB1.2"]
    reads = spark.createDataFrame([("r_AAC", "c", 1, "+", 4), ("r_AAC", "c", 1, "+", 0), ("r_GGG", "c", 1, "+", 4)], "read_id string, chrom string, pos int, strand string, flag int")
    assert commands.umi_dedup(reads, "_([ACGT]+)$").count() == 2 and commands.flagged(reads, 4).count() == 2


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", "ACGTAAAAAA")], "acc string, seq string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("acc string, seq string").parquet(str(tmp_path / "in"))
    q = stateless.contig_qc(stream).writeStream.format("memory").queryName("qc").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.sql("select * from qc").first()["frac_hp"] == 0.6


def test_fasta_slices_read_ranges(spark, tmp_path):
    import random

    from strandweave.sources import readers

    rng = random.Random(2)
    seqs = {f"r{k}": "".join(rng.choice("ACGTn") for _ in range(rng.choice([0, 1, 59, 60, 61, 500]))) for k in range(12)}
    wrap = lambda s, n: "\n".join(s[i : i + n] for i in range(0, len(s), n))
    text = "".join(f">{a} some words é\n{wrap(s, 60)}\n" for a, s in seqs.items())
    text = ">r3 replaced below\nAAAA\n" + text + ">odd\nACGT\nAC\nACGTACGT\n>last one\nACGTAC\nGT"
    seqs |= {"odd": "ACGTACACGTACGT", "last": "ACGTACGT"}
    (tmp_path / "a.fasta").write_text(text)
    index = readers.fasta_index(spark, str(tmp_path / "a.fasta"))
    assert {r["acc"]: r["length"] for r in index.collect()} == {a: len(s) for a, s in seqs.items()}
    assert {r["acc"] for r in index.where("line_bases is null").collect()} == {"odd"} | {a for a, s in seqs.items() if not s}
    asked = [(a, start, stop) for a in seqs for start, stop in ((1, None), (1, 1), (60, 61), (3, 130), (61, 60), (600, 700), (0, 5))] + [("unknown", 1, 2)]
    got = {(r["acc"], r["start"], r["stop"]): r["slice"] for r in readers.fasta_slices(spark.createDataFrame(asked, "acc string, start long, stop long"), index).collect()}
    assert got == {(a, b, e): seqs[a][max(b, 1) - 1 : e] for a, b, e in asked if a in seqs}


def test_components_equal_a_dense_decomposition(spark, monkeypatch):
    import numpy as np

    from strandweave.operators import expression

    rng = np.random.default_rng(6)
    counts = rng.integers(0, 50, size=(150, 7)) * (rng.random((150, 7)) < 0.7)
    rows = [(f"s{j}", f"f{i:03d}", float(counts[i, j])) for i in range(150) for j in range(7) if counts[i, j] or rng.random() < 0.5]  # some zeros are left out
    x = spark.createDataFrame(rows, "sample string, feature_id string, counts double").repartition(5)
    sf = {r["sample"]: r["sf"] for r in expression.size_factors(x).collect()}
    v = np.log2(counts / np.array([sf[f"s{j}"] for j in range(7)]) + 1).T
    seen = {f for _, f, _ in rows}
    v = v[:, [i for i in range(150) if f"f{i:03d}" in seen]]
    u, s, _ = np.linalg.svd(v - v.mean(axis=0), full_matrices=False)
    for block in (4, 512):
        monkeypatch.setattr(expression, "FEATURES", block)
        samples, at, variances = expression.log_components(x)
        assert samples == [f"s{j}" for j in range(7)] and np.allclose(variances[:6], (s**2 / 6)[:6])
        assert np.allclose(np.abs(at[:, :3]), np.abs(u * s)[:, :3])
    assert {r["sample"]: len(r["pca"]) for r in expression.log_pca(x, 2).collect()} == dict.fromkeys(samples, 2)


def test_stream_state_equals_batch(spark, tmp_path):
    import random

    from strandweave.operators import hits as H
    from strandweave.streaming import stateful

    rng = random.Random(1)
    rows = [(f"q{k % 5}", rng.choice("ab"), k) for k in range(90)]
    schema = "qacc string, sacc string, ord int"
    for n, part in enumerate((rows[:20], rows[20:21], rows[21:70], rows[70:])):
        rng.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/batch={n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/batch=*"))
    q = stateful.islands(stream, ["qacc"]).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).format("parquet").start(str(tmp_path / "out"))
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 4
    got = sorted((r["ord"], r["island"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r["ord"], r["island"]) for r in H.islands(spark.createDataFrame(rows, schema), ["qacc"]).collect())
    assert got == want


def test_combined_stream_drops_repeats(spark, tmp_path):
    from strandweave.streaming import stateful

    batches = [[(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:01:00")], [(2, "2024-01-01 00:05:00"), (3, "2024-01-01 00:06:00"), (3, "2024-01-01 00:06:30")], [(1, "2024-01-01 00:20:00"), (4, "2024-01-01 00:21:00")]]
    for n, part in enumerate(batches):
        df = spark.createDataFrame(part, "id int, t string").selectExpr("id", "cast(t as timestamp) as t")
        df.coalesce(1).write.parquet(str(tmp_path / f"in/batch={n}"))
    stream = spark.readStream.schema("id int, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/batch=*"))
    q = stateful.combined(stream, ["id"], "t").writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).format("parquet").start(str(tmp_path / "out"))
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4]


def test_feature_tables_by_record_equal_those_by_line(spark, tmp_path):
    from strandweave.functions import tables
    from strandweave.sources import readers

    text = ">Feature gb|A1.2|\n<1\t>90\tgene\n\t\t\tgene\tx\n200\t100\tCDS\n300\t400\n\t\t\tproduct\tp > q\n\t\t\tnote\t\n5\t6\tmisc\n>Feature B.1\n7\t8\tgene\n9^\t10\trepeat\n\t\t\tk\tv\n"
    (tmp_path / "a.tbl").write_text(text)
    lines = spark.createDataFrame([("f", k, x) for k, x in enumerate(text.split("\n"))], "file string, pos int, value string")
    got = sorted(map(tuple, readers.feature_tables(spark, str(tmp_path / "a.tbl")).collect()), key=str)
    assert got == sorted(map(tuple, readers.parse_features(lines).collect()), key=str) and ("A1", 100, 200, "CDS", "_reversed", "") in got
    tables.register(spark)
    spark.createDataFrame([(1, "3AC-G2"), (2, None), (3, "")], "id int, btop string").createOrReplaceTempView("aligned")
    rows = spark.sql("SELECT id, kind, n, q, s FROM aligned, LATERAL btop_rows(btop)").collect()
    assert sorted(map(tuple, rows)) == [(1, "delete", 1, 4, 4), (1, "exchange", 1, 3, 3), (1, "match", 2, 4, 5), (1, "match", 3, 0, 0)]
