from itertools import product

import pytest

from strandweave.operators.scaffold import Alignment, consensus, flip, reconcile, scaffold_contigs

SUBJECT = "AGAAATGTTTCACCCGAGGG"


def hit(qacc, query, sstart, send, qstart=1, qend=None, btop=None):
    n = abs(send - sstart) + 1
    return Alignment(qacc, query, qstart, qend or qstart + n - 1, sstart, send, btop or str(n))


def one(alignments, **kw):
    seqs, rows = scaffold_contigs(alignments, **kw)
    assert len(seqs) == 1
    return next(iter(seqs.values())), rows


def test_identity_and_mutation():
    s = hit("a", SUBJECT, 1, 20).aligned(10, 15)
    assert (s.text, s.inserts, s.qstart, s.qend) == (SUBJECT[9:15], (), 10, 15)
    query = "AGACCTGTTTCACCCGAGGG"
    a = hit("a", query, 1, 20, btop="3CACA15")
    assert a.aligned(1, 20).text == query and a.aligned(1, 20, 1).text == SUBJECT


def test_all_sub_ranges():
    query = SUBJECT[:15] + "G" + SUBJECT[16:]
    a = hit("a", query, 1, 20, btop="15GA4")
    for lo, hi in product(range(1, 21), repeat=2):
        if lo <= hi:
            assert a.aligned(lo, hi).text == query[lo - 1 : hi]


def test_insertion_belongs_to_the_base_after_it():
    a = hit("a", "AGAAAGTGTTTCACCCGAGGG", 1, 20, qend=21, btop="5G-15")
    assert a.aligned(1, 20).inserts == (5,)
    s = a.aligned(6, 6)
    assert (len(s.text), s.inserts, s.qstart, s.qend) == (2, (0,), 6, 7)


def test_deletion():
    a = hit("a", "AGAATGTTTCACCCGAGGG", 1, 20, qend=19, btop="4-A15")
    assert a.aligned(5, 5).text == "-"


def test_bad_ranges():
    a = hit("a", SUBJECT, 1, 20)
    for lo, hi in ((0, 3), (1, 21), (5, 4)):
        with pytest.raises(IndexError):
            a.aligned(lo, hi)


def test_simple_and_reversed():
    assert one([hit("a", SUBJECT[:10], 1, 10)])[0] == SUBJECT[:10]
    assert one([hit("a", flip(SUBJECT[:10]), 10, 1)])[0] == SUBJECT[:10]


def test_split_and_overlap():
    assert one([hit("a", SUBJECT[:10], 1, 10), hit("b", SUBJECT[10:], 11, 20)])[0] == SUBJECT
    assert one([hit("a", SUBJECT[:10], 1, 10), hit("b", SUBJECT[10:], 11, 20), hit("c", SUBJECT[5:15], 6, 15)])[0] == SUBJECT


def test_gap_and_fill_limit():
    parts = [hit("a", SUBJECT[:10], 1, 10), hit("b", SUBJECT[15:], 16, 20)]
    assert one(parts, max_fill=5)[0] == SUBJECT[:10] + "nnnnn" + SUBJECT[15:]
    seqs, _ = scaffold_contigs(parts, max_fill=4)
    assert seqs == {"a+b": SUBJECT[:10], "a+b.2": SUBJECT[15:]}


@pytest.mark.parametrize("middle", ["", "ACGTAC", SUBJECT[10:15]])
@pytest.mark.parametrize("reverse", [False, True])
def test_contig_stays_whole_over_a_gap(middle, reverse):
    contig = SUBJECT[:10] + middle + SUBJECT[15:]
    n = len(contig)
    if reverse:
        q = flip(contig)
        parts = [hit("a", q, 10, 1, n - 9, n), hit("a", q, 20, 16, 1, 5)]
    else:
        parts = [hit("a", contig, 1, 10, 1, 10), hit("a", contig, 16, 20, n - 4, n)]
    assert one(parts)[0] == contig


def test_other_contig_in_the_gap():
    contig = SUBJECT[:10] + SUBJECT[15:]
    parts = [hit("a", contig, 1, 10), hit("a", contig, 16, 20, 11, 15), hit("b", SUBJECT[11:14], 12, 14)]
    assert one(parts)[0] == SUBJECT[:10] + "n" + SUBJECT[11:14] + "n" + SUBJECT[15:]


def test_mixed_strands_keep_the_gap():
    q = flip(SUBJECT[:5]) + SUBJECT[10:]
    assert one([hit("a", q, 5, 1, 1, 5), hit("a", q, 11, 20, 6, 15)])[0] == SUBJECT[:5] + "nnnnn" + SUBJECT[10:]


@pytest.mark.parametrize("reverse", [False, True])
def test_overhang(reverse):
    for left in (True, False):
        contig = "CGCA" + SUBJECT if left else SUBJECT + "CGCA"
        if reverse:
            q = flip(contig)
            a = hit("a", q, 20, 1, 1 if left else 5, 20 if left else 24)
        else:
            a = hit("a", contig, 1, 20, 5 if left else 1, 24 if left else 20)
        text, rows = one([a])
        assert text == contig and "edge" in {r["scaffold"] for r in rows}


def test_reconcile_and_consensus():
    a = hit("a", "AGGAAATGTTTCACC", 1, 14, qend=15, btop="1G-13").aligned(1, 14)
    b = hit("b", SUBJECT[:14], 1, 14).aligned(1, 14)
    assert len({len(t) for t in reconcile([a, b])}) == 1
    assert consensus(["ACG", "ACT"]) == "ACn"
    assert consensus(["A-G", "A-G", "ATG"]) == "AG"
    with pytest.raises(ValueError):
        consensus(["A", "AC"])


def plain(k, a, b):
    """A contig of SUBJECT[a - 1 : b] with its hit."""
    return hit(k, SUBJECT[a - 1 : b], a, b)


def test_ids_are_sorted_and_rows_have_lengths():
    seqs, rows = scaffold_contigs([plain("zeta", 1, 8), plain("alpha", 12, 20)])
    assert list(seqs) == ["alpha+zeta"] and {(r["qacc"], r["qlen"]) for r in rows} == {("zeta", 8), ("alpha", 9)}
    assert all(r["qacc"] for r in rows)  # gaps have no rows


def test_edges_lie_outside_the_hit():
    q = "TTTT" + SUBJECT[9:15] + "GGG"
    _, rows = scaffold_contigs([hit("a", q, 10, 15, 5, 10)])
    at = {(r["sstart"], r["send"], r["qstart"], r["qend"], r["scaffold"]) for r in rows}
    assert at == {(6, 9, 1, 4, "edge"), (10, 15, 5, 10, "unique"), (16, 18, 11, 13, "edge")}


def test_gap_of_a_contig_whose_parts_overlap_is_emptied():
    q = SUBJECT[:5] + SUBJECT[9:15]
    seqs, rows = scaffold_contigs([hit("a", q, 1, 5, 1, 5), hit("a", q, 10, 15, 6, 11)])
    assert seqs["a"] == q and {r["scaffold"] for r in rows} == {"unique"}
    long = SUBJECT[:5] + "AAA" + SUBJECT[9:15]
    seqs, rows = scaffold_contigs([hit("a", long, 1, 5, 1, 5), hit("a", long, 10, 15, 9, 14)])
    assert seqs["a"] == long and {(r["sstart"], r["send"], r["qstart"], r["qend"]) for r in rows if r["scaffold"] == "gap"} == {(6, 9, 6, 8)}


def test_subjects_over_several_batches(spark, capsys):
    from strandweave.operators.scaffold import scaffold_table

    bases = {k: "ACGGTTACGATCCATG"[k % 3 :] for k in range(12)}
    rows = [("p", k, f"{k}_{j}", 1, b - a + 1, a, b, str(b - a + 1), j, bases[k][a - 1 : b]) for k in bases for j, (a, b) in enumerate(((1, 8), (5, 10), (12, 13)))]
    df = spark.createDataFrame(rows, "sample string, sacc long, qacc string, qstart int, qend int, sstart int, send int, btop string, ord int, seq string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = scaffold_table(df.drop("seq"), df.select("qacc", "seq"))
        got = {r["sacc"]: (r["acc"], r["seq"], len(r["parts"])) for r in out.collect()}
        assert scaffold_table(df.drop("seq").limit(0), df.select("qacc", "seq")).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: (f"{k}_0+{k}_1+{k}_2", f"{s[:10]}n{s[11:13]}", 5) for k, s in bases.items()}
    capsys.readouterr()
    out.explain()
    assert "FlatMapGroups" not in capsys.readouterr().out  # a call for each subject
