import pytest
from pyspark.sql import functions as F

from strandweave.functions import scalars as C
from strandweave.functions import sequence as S
from strandweave.operators import taxonomy as T


@pytest.fixture(scope="module")
def tree(spark):
    rows = [(1, 1, "root", "no rank"), (2, 1, "Viruses", "domain"), (3, 2, "A", "genus"), (4, 2, "B", "genus"), (5, 3, "A one", "species"), (6, 3, "A two", "species"), (7, 1, "B", "genus")]
    return spark.createDataFrame(rows, "tax_id long, parent_id long, name string, rank string")


@pytest.fixture(scope="module")
def lin(tree):
    return T.lineage(tree).cache()


def lca(spark, lin, rows, **kw):
    df = spark.createDataFrame([("k", t, float(w), n) for n, (t, w) in enumerate(rows)], "k string, tax_id long, w double, o int")
    r = T.quorum_lca(df, lin, ["k"], "tax_id", weight=F.col("w"), order=F.col("o"), **kw).first()
    return r["taxid"], round(r["score"], 3)


def test_lineage(tree, lin):
    rows = {r["tax_id"]: r for r in lin.collect()}
    assert rows[1]["path"] == [] and rows[5]["names"] == ["Viruses", "A", "A one"] and rows[5]["ranks"] == ["domain", "genus", "species"]
    flat = {r["tax_id"]: r["lineage"] for r in T.lineage_recursive(tree).collect()}
    assert flat[6] == "Viruses; A; A two" and flat[1] == ""


def test_names_subtrees_siblings(spark, tree, lin):
    with pytest.warns(UserWarning):
        assert [r["tax_id"] for r in T.ids_by_name(lin, ["A", "B"]).collect()] == [3]
    assert sorted(r[0] for r in T.subtree(lin, [3]).collect()) == [3, 5, 6]
    assert [r["tax_id"] for r in T.siblings(tree, lin, 3).collect()] == [4]
    assert sorted(r[0] for r in T.allowed_ids(lin, exclude=["A"]).collect()) == [1, 2, 4, 7]
    assert sorted(r[0] for r in T.allowed_ids(lin, include=["Viruses"], exclude=["A"]).collect()) == [2, 4]
    merged = spark.createDataFrame([(50, 5)], "old_id long, new_id long")
    ids = spark.createDataFrame([(50,), (4,), (99,)], "tax_id long")
    assert sorted(str(r[0]) for r in T.resolve(ids, lin, merged).collect()) == ["4", "5", "None"]


def test_quorum_lca(spark, lin):
    assert lca(spark, lin, [(5, 9), (6, 1)]) == (5, 0.9)
    assert lca(spark, lin, [(5, 8), (6, 2)]) == (3, 1.0)
    assert lca(spark, lin, [(5, 1), (3, 1)]) == (3, 1.0)
    assert lca(spark, lin, [(99, 1)]) == (1, 0.0)
    assert lca(spark, lin, [(5, 1), (6, 1)], majority=0.5) == (5, 0.5)  # a tie goes to the first met


def test_classify(spark, lin):
    h = spark.createDataFrame([("s", "q", 1, 50.0, [5]), ("s", "q", 2, 50.0, [5]), ("s", "q", 3, 40.0, [6]), ("s", "r", 4, 10.0, [])], "sample string, qacc string, ord int, bitscore double, staxids array<int>")
    out = {r["qacc"]: r["taxid"] for r in T.classify_contigs(h, lin).collect()}
    assert out == {"q": 3}
    row = T.blast_classify(h, lin).first()
    assert (row["qacc"], row["taxname"], row["genus"], row["lineage"]) == ("q", "A", "A", "Viruses; A")
    calls = spark.createDataFrame([(6,), (99,)], "taxid long")
    rows = {r["taxid"]: r for r in T.annotate(calls, lin).collect()}
    assert rows[6]["species"] == "A two" and rows[99]["lineage"] == "Unknown" and rows[99]["lineage_ranks"] == "no rank"


@pytest.mark.parametrize("mode", ["element", "string"])
def test_longest_prefix(spark, mode):
    q = spark.createDataFrame([("V; A; x; y",), ("V; B",), ("Z",)], "lineage string")
    t = spark.createDataFrame([("V; A; z", "h1"), ("V; A; x", "h2"), ("V; Bc", "h3"), ("V", "h0")], "known string, host string")
    got = sorted((r["lineage"], r["host"]) for r in T.longest_prefix(q, t, "lineage", "known", mode=mode).collect())
    rest = [("V; B", h) for h in ("h0", "h1", "h2", "h3")] if mode == "element" else [("V; B", "h3")]
    assert got == [("V; A; x; y", "h2"), *rest]


def value(spark, col, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(col).first()[0]


def test_sequences(spark):
    v = lambda c, s: value(spark, c, s=s)
    s = F.col("s")
    assert v(S.normalize_sequence(s), "ACnnNRt") == "ACnnT"
    assert v(S.reverse_complement(s), "AACGn") == "nCGTT"
    assert v(S.homopolymer_ratio(s), "AAAAA") == 0.0 and v(S.homopolymer_ratio(s), "AAAAAA") == 1.0 and v(S.homopolymer_ratio(s), "") is None
    assert v(S.count_bp(s), "ACGTnN-a") == 4
    assert v(S.sub_sequence(s, F.lit(2), F.lit(4)), "ACGTA") == "CGT"
    df = spark.createDataFrame([("a", "ACGT"), ("b", "AAAA"), ("c", "")], "acc string, seq string")
    e = {r["acc"]: r["entropy1"] for r in S.sequence_entropy(df, "acc", "seq", 1).collect()}
    assert e == {"a": 1.0, "b": 0.0, "c": 0.0}
    assert {r["entropy5"] for r in S.sequence_entropy(df, "acc", "seq", 5).collect()} == {0.0}
    ops = [tuple(x) for x in v(S.btop_ops(s), "5G-3AC")]
    assert ops == [(5, "G", "-"), (3, "A", "C")]


def test_scalars(spark):
    v = lambda c, s: value(spark, c, s=s)
    s = F.col("s")
    assert v(C.tax_ids(s), "1;2") == [1, 2] and v(C.tax_ids(s), "N/A") == [] and v(C.tax_ids(s), "1;x") == []
    assert v(C.file_safe(s), "a b/c.d  e.") == "a_b_c_d_e"
    assert v(C.before_last(s), "x.y.csv") == "x.y" and v(C.before_last(s), "x") == "x"
    assert v(C.sample_name(s, "blast7"), "A.b.blast7.gz") == "A.b"
    assert v(C.round_half_even(s, 1), 0.25) == 0.2
    assert v(C.drop_last(s), "a;b;c") == "a;b"
    assert v(C.last_match(s, [("a", "1"), ("b", "2")], "0"), "ab") == "2"
    assert v(C.recode(s, [("a", "b"), ("b", "c")]), "ab") == "cb"  # the first match of each step only
    virus, strain = C.virus_and_strain(s)
    assert (v(virus, "Human rhinovirus A12"), v(strain, "Human rhinovirus A12")) == ("HRV", "A") and v(strain, "Human coronavirus") is None
    assert v(C.merge_lists(F.array(s, F.lit("b;a")), ";"), "c;a") == "a;b;c"
    assert v(C.log_evalue(s, F.lit(100)), 50.0) == round((-0.625 * 50 + -0.8916 + 20.7273 + 4.60517) / 2.302585, 2)
    assert v(C.genome_coverage(F.lit(50), s), 0) is None and v(C.genome_coverage(F.lit(50), s), 200) == 25


def test_title_words(spark):
    s = F.col("s")
    v = lambda t, **kw: value(spark, C.title_words(s, **kw), s=t)
    assert v("alpha b c delta") == ["alpha b c", "alpha b", "alpha", "delta"]
    assert v("Human rhinovirus A, complete genome") == ["rhinovirus A", "rhinovirus"]
    assert v("HUMAN Virus is iPSC - x") == ["virus is", "iPSC  x", "iPSC ", "iPSC"]  # stop words go after short ones were joined; punctuation alone is a short word
    assert v("") == []
    assert value(spark, C.best_words(F.split(s, ","), 3), s="b a,b,c,d") == ["b", "a", "c"]


def test_ids_that_are_valid_stay_for_all_that_was_merged(spark):
    lin = T.lineage(spark.createDataFrame([(1, 1, "root", "no rank"), (4, 1, "a", "species"), (5, 1, "b", "species")], "tax_id long, parent_id long, name string, rank string"))
    merged = spark.createDataFrame([(4, 5), (9, 5), (8, 77)], "old_id long, new_id long")
    ids = spark.createDataFrame([(k,) for k in (4, 5, 9, 8, 7, None)], "tax_id long").withColumn("was", F.col("tax_id"))
    got = {r["was"]: r["tax_id"] for r in T.resolve(ids, lin, merged).collect()}
    assert got == {4: 4, 5: 5, 9: 5, 8: None, 7: None, None: None}
