import random
from math import log

import pytest

from strandweave.operators import chains

HITS = "sample string, qacc string, sacc string, ord int, qlen int, sstart int, send int, score double"


def chain_rows():
    """A chain of 80 subjects, each sharing a query with the next; in sample t its names are shuffled."""
    rows = []
    for sample in "st":
        names = [f"x{k:02d}" for k in range(80)]
        if sample == "t":
            random.Random(5).shuffle(names)
        for k, name in enumerate(names):
            for q in (k, k + 1):
                rows.append((sample, f"q{q:02d}", name, len(rows), 100, 1 + q % 7, 60 + q % 11, 60.0 + q * 37 % 90))
    return [*rows, ("s", "alone", "y", len(rows), 100, 1, 50, 80.0)]


def test_long_chains_are_one_component(spark):
    rows = chain_rows()
    df = spark.createDataFrame(rows, HITS)
    got = {(r["sample"], r["sacc"]): r["component"] for r in chains.query_components(df).collect()}
    assert got == {(r[0], r[2]): "y" if r[2] == "y" else "x00" for r in rows}
    with pytest.raises(RuntimeError):
        chains.query_components(df, rounds=2)


def measures(own, penalty=20.0):
    """Queries, query length, log e-value and covered subject bases of hits, by sets of positions."""
    queries = {h["qacc"] for h in own}
    qlen = sum(next(h["qlen"] for h in own if h["qacc"] == q) for q in queries)
    raw = sum(h["score"] for h in own) - penalty * (len(own) - 1)
    e = round((-0.625 * raw + log(0.41) + log(1_004_024_614) + log(qlen)) / log(10), 2)
    return queries, qlen, e, len({p for h in own for p in range(min(h["sstart"], h["send"]), max(h["sstart"], h["send"]) + 1)})


def plain_selection(hits, alternatives="post_prune", alt=0.9):
    """Greedy selection of one sample by its definition, one chain after the other: (bin, position, sacc, n_hits, n_queries, slen, log_evalue)."""
    chains, groups, final = {}, [], {}
    for h in sorted(hits, key=lambda h: h["ord"]):
        chains.setdefault(h["sacc"], []).append(h)
    while chains:
        m = {s: measures(own) for s, own in chains.items()}
        best = max(chains, key=lambda s: -m[s][2])
        queries, qlen, e, slen = m[best]
        alts = [s for s in chains if s != best and -m[s][2] > alt * -e and m[s][2] < alt * e and m[s][3] > alt * slen and m[s][1] > alt * qlen and len(m[s][0] & queries) > len(queries) / 10]
        final[best] = chains[best]
        groups.append([(s, chains[s]) for s in [best, *sorted(alts, key=lambda s: m[s][2])]])
        chains = {s: [h for h in own if h["qacc"] not in queries] for s, own in chains.items() if s != best}
        chains = {s: own for s, own in chains.items() if own}
    out = []
    for b, group in enumerate(groups):
        for p, (s, own) in enumerate(group):
            own = final.get(s, []) if alternatives == "post_prune" else own
            queries, _, e, slen = measures(own) if own else (set(), 0, 0.0, 0)
            out.append((b, p, s, len(own), len(queries), slen, e))
    return out


def check_selection(spark, rows):
    names = [c.split(" ")[0] for c in HITS.split(", ")]
    for mode in ("post_prune", "snapshot"):
        got = {}
        for r in chains.greedy_select(spark.createDataFrame(rows, HITS), alternatives=mode).collect():
            assert r["representative"] == (r["position"] == 0)
            got.setdefault(r["sample"], []).append(tuple(r[c] for c in ("bin", "position", "sacc", "n_hits", "n_queries", "slen", "log_evalue")))
        for sample in {r[0] for r in rows}:
            assert sorted(got[sample]) == plain_selection([dict(zip(names, r)) for r in rows if r[0] == sample], mode)


@pytest.mark.parametrize("seed", range(4))
def test_greedy_selection_equals_its_definition(spark, seed):
    """Scores around the penalty, so that removals raise scores too; equal scores; few queries, so that chains overlap a lot."""
    rng = random.Random(seed)
    rows = []
    for sample in "abcdef":
        low = sample in "def"
        for k in range(60):
            start, n = rng.randrange(1, 600), rng.randint(50, 300)
            ends = (start, start + n) if rng.random() < 0.5 else (start + n, start)
            q = rng.randrange(12)
            score = float(rng.randint(5, 60)) if low else float(rng.randint(60, 400))
            rows.append((sample, f"q{q}", f"s{rng.randrange(9)}" if low else f"s{(q // 3) * 2 + rng.randrange(2)}", len(rows), rng.choice([30, 300 + q, 5000]) if low else 300 + q, *ends, score))
    check_selection(spark, rows)


def test_selections_of_one_component_in_few_rounds(spark, monkeypatch):
    rows = chain_rows()
    rounds = []
    one = chains._round
    monkeypatch.setattr(chains, "_round", lambda *a: rounds.append(1) or one(*a))
    check_selection(spark, rows)
    assert len(rounds) <= 2 * 14  # of 81 chains, twice


def test_no_hits(spark):
    assert chains.greedy_select(spark.createDataFrame([], HITS)).count() == 0
