import random

import numpy as np
import pytest

from strandweave.llm.components import connected_components
from strandweave.llm import near_dedup
from strandweave.llm.near_dedup import REGISTERS, _columns, _joined, _suspects, _suspicious, bands_for, drop_near_duplicates, near_duplicates, super_minhash


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, pct):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= pct * len(x | y):
                p, q = root(a), root(b)
                comp[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_groups_equal_brute_force(spark):
    rng = random.Random(4)
    rows, i = [], 0
    for _ in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(4, 160))]
        for _ in range(rng.randint(1, 9)):
            rows.append((i, " ".join(edited(rng, base, rng.randint(0, 3)))))
            i += 1
    # a chain whose ends are unlike, and a group below the threshold
    words = [f"c{k}" for k in range(200)]
    for k in range(10):
        rows.append((i, " ".join(words[4 * k : 4 * k + 150])))
        i += 1
    base = [f"g{k}" for k in range(150)]
    for _ in range(40):
        rows.append((i, " ".join(edited(rng, base, 4))))
        i += 1
    rng.shuffle(rows)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows, 85)
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["n_shingles"] == len(shingles(dict(rows)[r["doc_id"]])) and r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in out)


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(2)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (700, 150, 150))
    el, own = np.concatenate([both, a, both, b]), np.repeat([0, 1], [850, 850])
    s = super_minhash(el, own, 2, 256)
    assert abs((s[0] == s[1]).mean() - 0.7) < 0.1
    alone = np.concatenate([super_minhash(el[own == k], np.zeros(850, int), 1, 256) for k in (0, 1)])
    assert (alone == s).all()  # walks don't depend on the batch
    tiny = super_minhash(np.array([5], np.uint64), np.zeros(1, int), 1, 256)
    assert len(set((tiny[0] >> np.uint64(32)).tolist())) == 256  # a single element visits every register once


def test_blocks_compare_every_pair():
    import pyarrow as pa

    n = 90
    same = np.zeros((n, REGISTERS), np.uint8).tobytes()
    base = {"rep": list(range(n)), "n": [10] * n, "component": list(range(n)), "block": [k % 3 for k in range(n)], "bands": [[1] * 20] * n, "sketch": [same[:REGISTERS]] * n}
    found = set()
    for i in range(3):
        for j in range(i, 3):
            rows = [k for k in range(n) if base["block"][k] in (i, j)]
            t = pa.table({**{c: [v[k] for k in rows] for c, v in base.items()}, "key": [1] * len(rows), "i": [i] * len(rows), "j": [j] * len(rows)})
            for u, v in _suspicious(_columns(t), 85):
                found |= {(min(rows[a], rows[b]), max(rows[a], rows[b])) for a, b in zip(u.tolist(), v.tolist())}
    assert len(found) == n * (n - 1) // 2


def test_suspicious_rows_are_joined_in_their_task():
    import pyarrow as pa

    sets = [np.arange(100 + 3 * (k % 10 > 8), dtype=np.uint64) + np.uint64(1000 * (k % 2)) for k in range(40)]  # two kinds, linked within
    sets[7] = np.arange(50, dtype=np.uint64)  # like neither
    same = b"\0" * REGISTERS
    t = pa.table({"bin": [1] * 40, "key": [1] * 40, "i": [0] * 40, "j": [0] * 40, "block": [0] * 40, "rep": list(range(40)), "n": [100] * 40, "component": list(range(40)), "bands": [[1] * 20] * 40, "sketch": [same] * 40})
    assert _suspects(85)(t).num_rows == 40 and _suspects(85)(t.set_column(7, "component", pa.array([5] * 40))).num_rows == 0
    out = _joined(85)(t.append_column("shingles", pa.array([x.tobytes() for x in sets], pa.binary())))
    links = list(zip(out["a"].to_pylist(), out["b"].to_pylist()))
    root = list(range(40))
    for a, b in links:
        root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
    assert len(links) == 37 and root == [7 if k == 7 else k % 2 for k in range(40)]


@pytest.mark.parametrize("block", [16, 1024])
def test_chains_through_one_bucket(spark, monkeypatch, block):
    """Documents linked with a few neighbours each: no hub reaches all, so blocks of the buckets are compared."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    vocabulary = [f"w{k}" for k in range(700)]
    docs = [(k, " ".join(vocabulary[3 * k : 3 * k + 100])) for k in range(120)] + [(500 + k, " ".join(reversed(vocabulary[9 * k : 9 * k + 100]))) for k in range(30)]
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out == {k: 0 if k < 500 else k for k, _ in docs}  # a shift of 9 words is 0.83


def test_bands_follow_the_threshold():
    assert bands_for(80) == bands_for(85) == (20, 4)
    for pct in (30, 50, 60, 70, 90, 100):
        bands, rows = bands_for(pct)
        assert bands * rows <= REGISTERS and (1 - (pct / 100) ** rows) ** bands <= near_dedup.MISS
    with pytest.raises(ValueError):
        bands_for(2)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 102), (200, 200)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def test_edges(edge, none):
    out = near_duplicates(edge)
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()}
    assert out.count() == edge.count() and (1, 0, 1, True) in rows and (8, 1, 8, True) in rows and (None, 4, None, True) in rows
    assert near_duplicates(none).count() == 0
    kept = drop_near_duplicates(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    assert drop_near_duplicates(edge, threshold_pct=50).where("doc_id = 6").count() == 0
