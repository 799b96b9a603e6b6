import random

import pytest
from pyspark.sql import functions as F

from strandweave.operators import intervals as I

CASES = {
    "disjoint": ([(10, 20, "a"), (30, 40, "b")], [(10, 20, "a"), (21, 29, ""), (30, 40, "b")]),
    "adjacent": ([(11, 20, "a"), (21, 30, "b")], [(11, 20, "a"), (21, 30, "b")]),
    "bridge": ([(10, 20, "a"), (30, 40, "b"), (15, 35, "c")], [(10, 14, "a"), (15, 20, "ac"), (21, 29, "c"), (30, 35, "bc"), (36, 40, "b")]),
    "nested": ([(20, 30, "b"), (10, 40, "a")], [(10, 19, "a"), (20, 30, "ba"), (31, 40, "a")]),
    "shared edge": ([(10, 40, "a"), (20, 40, "b")], [(10, 19, "a"), (20, 40, "ab")]),
    "reversed": ([(20, 10, "a")], [(10, 20, "a")]),
    "span": ([(10, 20, "a"), (30, 40, "b"), (0, 50, "c")], [(0, 9, "c"), (10, 20, "ac"), (21, 29, "c"), (30, 40, "bc"), (41, 50, "c")]),
}


def frame(spark, rows):
    return spark.createDataFrame([("k", s, e, p, n) for n, (s, e, p) in enumerate(rows)], "key string, s int, e int, p string, ord int")


@pytest.mark.parametrize("name", CASES)
def test_segments(spark, name):
    rows, want = CASES[name]
    got = I.segments(frame(spark, rows), ["key"], "s", "e", "p", "ord").orderBy("start").collect()
    assert [(r["start"], r["end"], "".join(r["payload"])) for r in got] == want


def held(rows, positions):
    return {p: [d for s, e, d in rows if min(s, e) <= p <= max(s, e)] for p in positions}


def test_segments_over_points(spark):
    rows = CASES["bridge"][0]
    segs = I.segments(frame(spark, rows), ["key"], "s", "e", "p", "ord")
    points = spark.createDataFrame([("k", p) for p in [*range(0, 50), None]] + [("other", 15)], "key string, pos int")
    got = I.at_points(points, segs, ["key"], "pos").collect()
    assert {r["pos"]: r["payload"] or [] for r in got if r["key"] == "k" and r["pos"] is not None} == held(rows, range(50))
    assert len(got) == 52 and next(r for r in got if r["key"] == "other")["payload"] is None
    assert I.at_point(segs, 18).first()["payload"] == ["a", "c"] and I.at_point(segs, 99).count() == 0


#: Rows, what is removed, what is left: neighbours that become equal are one, nothing empty at the ends.
REMOVALS = {
    "one of two": ([(10, 20, "a"), (30, 40, "b")], [(30, 40, "b")], [(10, 20, "a")]),
    "the first": ([(10, 20, "a"), (30, 40, "b")], [(10, 20, "a")], [(30, 40, "b")]),
    "the bridge": ([(10, 20, "a"), (30, 40, "b"), (15, 35, "c")], [(15, 35, "c")], [(10, 20, "a"), (21, 29, ""), (30, 40, "b")]),
    "inside": ([(10, 40, "a"), (20, 30, "b")], [(20, 30, "b")], [(10, 40, "a")]),
    "outside": ([(10, 40, "a"), (20, 30, "b")], [(40, 10, "a")], [(20, 30, "b")]),
    "one of two equal": ([(10, 40, "a"), (10, 40, "a")], [(10, 40, "a")], [(10, 40, "a")]),
    "equal neighbours": ([(10, 19, "a"), (20, 30, "a"), (40, 50, "c")], [(40, 50, "c")], [(10, 30, "a")]),
    "all": ([(10, 40, "a"), (20, 30, "b")], [(10, 40, "a"), (20, 30, "b")], []),
}


@pytest.mark.parametrize("name", REMOVALS)
def test_removed_payloads(spark, name):
    rows, gone, want = REMOVALS[name]
    segs = I.segments(frame(spark, rows), ["key"], "s", "e", "p", "ord")
    left = I.without_payloads(segs, frame(spark, gone), ["key"], "s", "e", "p").orderBy("start").collect()
    assert [(r["start"], r["end"], "".join(r["payload"])) for r in left] == want


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(k, *((a, b) if rng.random() < 0.5 else (b, a)), rng.randint(60, 99)) for k in range(6) for _ in range(14) for a in [rng.randint(1, 80)] for b in [a + rng.randint(0, 25)]]
    df = spark.createDataFrame(rows, "key int, s int, e int, v int")
    cover = {}
    for k, s, e, v in rows:
        for p in range(min(s, e), max(s, e) + 1):
            cover[k, p] = max(cover.get((k, p), 0), v)
    length = {r["key"]: r["length"] for r in I.union_length(df, ["key"], "s", "e").collect()}
    assert length == {k: sum(1 for q in cover if q[0] == k) for k in range(6)}
    ident = {r["key"]: r["value"] for r in I.weighted_over_segments(df, ["key"], "s", "e", "v", digits=3).collect()}
    for k in range(6):
        own = [v for (q, _), v in cover.items() if q == k]
        assert ident[k] == pytest.approx(sum(own) / len(own), abs=6e-4)
    islands = I.merged(df, ["key"], "s", "e").collect()
    assert sum(r["end"] - r["start"] + 1 for r in islands) == len(cover)
    other = df.select("key", F.least("s", "e").alias("start"), F.greatest("s", "e").alias("end"), F.monotonically_increasing_id().alias("id"))
    plain = I.overlap_join(other, other, ["key"]).count()
    assert plain == I.overlap_join(other, other, ["key"], bin_width=7).count()
    assert plain == sum(max(min(a[1:3]), min(b[1:3])) <= min(max(a[1:3]), max(b[1:3])) for a in rows for b in rows if a[0] == b[0])


def test_lanes(spark):
    rng = random.Random(1)
    rows = [(k, s, s + rng.randint(0, 30), n) for n, (k, s) in enumerate((rng.choice("aab"), rng.randint(1, 400)) for _ in range(150))]
    got = {r["n"]: r["lane"] for r in I.pack_lanes(spark.createDataFrame(rows, "key string, start int, end int, n int"), ["key"], ["start", "end", "n"]).collect()}
    want = {}
    for key in "ab":
        ends = []
        for k, s, e, n in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            lane = next((i for i, x in enumerate(ends) if x < s), len(ends))
            ends[lane : lane + 1] = [e]
            want[n] = lane + 1
    assert got == want and max(got.values()) > 3


def test_spread(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", 5, 12), ("k", 11, 20), ("k", 30, 35), ("one", 3, 9)], "key string, start int, end int")
    moved = sorted((r["key"], r["start"], r["end"]) for r in I.spread(df, ["key"]).collect())
    # 28 bases in 20: shifts of -4.5, 1.5 and 3.5 are cut to whole ones, so -3, 6 and 14 still meet; then 28 in 27: shifts of -1, 0 and 0
    assert moved == [("k", -4, 5), ("k", 6, 13), ("k", 14, 23), ("k", 30, 35), ("one", 3, 9)]
    apart = sorted((r["start"], r["end"]) for r in I.spread(df.where("key = 'k'"), ["key"], spacing=4).collect())
    assert all(b[0] - a[1] > 4 for a, b in zip(apart, apart[1:])) and [e - s for s, e in apart] == [9, 7, 9, 5]


def test_axis(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", 5, 12), ("k", 11, 20), ("k", 30, 35), ("z", 5, 5)], "key string, start int, end int")
    axis = I.compressed_axis(df, ["key"], gap=2)
    points = spark.createDataFrame([("k", p) for p in (-3, 1, 20, 25, 30, 35, 40, None)] + [("z", 4), ("z", 5), ("z", 9), ("no", 1)], "key string, pos int")
    there = {(r["key"], r["pos"]): r["mapped"] for r in I.to_axis(points, axis, ["key"], "pos").collect()}
    # blocks 1-20 and 23-28: the gap of ten steps is drawn in three
    assert there == {("k", -3): -3, ("k", 1): 1, ("k", 20): 20, ("k", 25): 21.5, ("k", 30): 23, ("k", 35): 28, ("k", 40): 33, ("k", None): None, ("z", 4): 0, ("z", 5): 1, ("z", 9): 5, ("no", 1): None}
    mapped = spark.createDataFrame([(k, p, m) for (k, p), m in there.items()], "key string, was int, pos double")
    assert all(r["mapped"] == r["was"] or r["was"] is None or r["key"] == "no" for r in I.to_axis(mapped, axis, ["key"], "pos", back=True).collect())
    assert I.compressed_axis(df, ["key"], gap=2, merge_gap=10).where("key = 'k'").count() == 1


def test_exonic_parts(spark):
    ex = spark.createDataFrame([("c", "+", 1, 10, "g1"), ("c", "+", 8, 20, "g2"), ("c", "+", 5, 9, "g1")], "chrom string, strand string, start int, end int, gene string")
    parts = sorted((r["start"], r["end"], r["gene"]) for r in I.disjoint_parts(ex, ["chrom", "strand"], "gene").collect())
    assert parts == [(1, 4, "g1"), (5, 7, "g1"), (11, 20, "g2")]
    reads = spark.createDataFrame([("c", "-", 1, 6, "f1"), ("c", "-", 2, 3, "f1"), ("c", "+", 1, 9, "f2")], "chrom string, strand string, start int, end int, fragment string")
    n = {(r["start"], r["n"]) for r in I.count_fragments(reads, I.disjoint_parts(ex, ["chrom", "strand"], "gene"), ["chrom", "strand"], ["start", "end", "gene"]).collect()}
    assert n == {(1, 1), (5, 1)}


def test_segments_without_pairs(spark, capsys):
    n = 60  # nested, with a null key
    df = spark.createDataFrame([(key, k, 2 * n - k + 1, k) for key in ("k", None) for k in range(1, n + 1)], "key string, s int, e int, p int")
    segs = I.segments(df, ["key"], "s", "e", "p", "p")
    got = segs.collect()
    assert len(got) == 2 * (2 * n - 1) and all(r["payload"] == list(range(1, min(r["start"], 2 * n - r["start"] + 1) + 1)) for r in got)
    capsys.readouterr()
    segs.explain()
    plan = capsys.readouterr().out
    assert "_near" in plan and "_level" not in plan  # arrays by bin, no row for each interval over a segment


def test_fragments_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    reads = [(c, f"f{rng.randrange(40)}" if rng.random() > 0.05 else None, a, a + rng.randint(0, 9)) for c in ("x", "y", None) for a in (rng.randint(1, 150) for _ in range(90))]
    parts = [(c, g, a, a + rng.choice((0, 3, 20, 80))) for c in ("x", "y", "z", None) for g in range(25) for a in [rng.randint(1, 150) for _ in range(1 if g % 5 else 3)]]
    want = {}
    for c, g, a, b in parts:
        found = {f for d, f, s, e in reads if c is not None and c == d and f is not None and s <= b and a <= e}
        want.setdefault((c, g), set()).update(found)
    r, p = spark.createDataFrame(reads, "chrom string, fragment string, start int, end int"), spark.createDataFrame(parts, "chrom string, part int, start int, end int")
    got = {(x["chrom"], x["part"]): x["n"] for x in I.count_fragments(r, p, ["chrom"], ["part"]).collect()}
    assert got == {k: len(v) for k, v in want.items() if v}


def test_fragments_without_pairs_of_reads_and_parts(spark, capsys):
    n = 300  # all reads are over all parts
    reads = spark.range(n).selectExpr("'c' AS chrom", "id AS fragment", "id % 7 + 1 AS start", "id % 7 + 500 AS end")
    parts = spark.range(n).selectExpr("'c' AS chrom", "id AS part", "100 + id % 9 AS start", "200 + id % 9 AS end")
    out = I.count_fragments(reads, parts, ["chrom"], ["part"])
    got = out.collect()
    assert len(got) == n and {r["n"] for r in got} == {n}
    capsys.readouterr()
    out.explain()
    assert "a_fragment" not in capsys.readouterr().out  # positions are counted; no row for each fragment over a part


@pytest.mark.parametrize("name", REMOVALS)
def test_segments_without(spark, name):
    rows, gone, want = REMOVALS[name]
    left = I.segments_without(frame(spark, rows), frame(spark, gone), ["key"], "s", "e", "p", "ord").orderBy("start").collect()
    assert [(r["start"], r["end"], "".join(r["payload"])) for r in left] == want


def swept(rows, gone):
    """(segments, what is left of them) of (key, s, e, payload, ord), one entry after the other."""
    segs, left = set(), set()
    for key in {r[0] for r in rows}:
        own = sorted(((o is None, o, min(a, b), max(a, b), p) for k, a, b, p, o in rows if k == key), key=str)
        cuts, runs = sorted({x for _, _, a, b, _ in own for x in (a, b + 1)}), []
        for a, b in zip(cuts, cuts[1:]):
            held = [p for _, o, lo, hi, p in sorted((r for r in own if not r[0]), key=lambda r: r[1]) if lo <= a and hi >= b - 1]
            segs.add((key, a, b - 1, tuple(held)))
            for k, lo, hi, p in gone:
                if k == key and min(lo, hi) <= a and max(lo, hi) >= b - 1 and p is not None and p in held:
                    held.remove(p)
            if runs and runs[-1][2] == held:
                runs[-1][1] = b - 1
            else:
                runs.append([a, b - 1, held])
        while runs and not runs[0][2]:
            runs.pop(0)
        while runs and not runs[-1][2]:
            runs.pop()
        left |= {(key, a, b, tuple(held)) for a, b, held in runs}
    return segs, left


@pytest.mark.parametrize("means, listed, ends", [(8, 2_000_000, 100_000), (0.3, 20, 100_000), (1, 1, 0)])
def test_sweeps_by_bins_equal_brute_force(spark, monkeypatch, means, listed, ends):
    for name, value in (("BIN_MEANS", means), ("LISTED", listed), ("END_ROWS", ends)):
        monkeypatch.setattr(I, name, value)
    rng = random.Random(listed)
    rows = [(rng.choice(["a", "b", None]), a, a + rng.randrange(-30, 30), rng.choice(["x", "y", "z", None]) if rng.random() < 0.6 else f"u{i}", i if rng.random() < 0.95 else None) for i in range(120) for a in [rng.randrange(-200, 300)]]
    gone = [r[:4] for r in rows if rng.random() < 0.5] + [(rng.choice("abc"), a, a + rng.randrange(60), rng.choice("xyz")) for _ in range(30) for a in [rng.randrange(-200, 300)]]
    df, removed = spark.createDataFrame(rows, "key string, s long, e long, p string, ord long"), spark.createDataFrame(gone, "key string, s long, e long, p string")
    args = ["key"], "s", "e", "p"
    found = I.segments(df, *args, "ord"), I.segments_without(df, removed, *args, "ord"), I.without_payloads(I.segments(df, *args, "ord"), removed, *args)
    segs, left = swept(rows, gone)
    for got, want in zip(found, (segs, left, left)):
        got = [(r["key"], r["start"], r["end"], tuple(r["payload"])) for r in got.collect()]
        assert len(got) == len(want) and set(got) == want


def test_payloads_are_not_shuffled(spark):
    df = spark.createDataFrame([("k", n, n + 40, n, n) for n in range(60)], "key string, s int, e int, p int, ord int")
    removed = df.where("p % 2 = 0")
    for out, rows in ((I.segments(df, ["key"], "s", "e", "p", "ord"), 100), (I.segments_without(df, removed, ["key"], "s", "e", "p", "ord"), 59)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # each sweep is behind the one shuffle of the intervals, and no payloads are gathered before it
        assert plan.count("RepartitionByExpression") == plan.count("MapInArrow") > 0 and "collect_list" not in plan
        assert plan.index("MapInArrow") < plan.index("RepartitionByExpression")
        assert out.count() == rows
