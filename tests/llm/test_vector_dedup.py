import numpy as np
import pytest

from strandweave.llm.vector_dedup import Rotations, bits_and_tables, code, drop_near_vectors, linked_pairs, near_vectors, unit

SCHEMA = "vec_id long, embedding array<double>, label int, n int, tag string, node int"


def brute(rows, threshold=0.93):
    """{row number: (vec_id, n_links, component)} over all pairs of sound rows of a label and length."""
    sound = [i for i, (d, v, lab) in enumerate(rows) if d is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in sound:
        for b in sound:
            x, y = rows[a], rows[b]
            if a < b and x[2] == y[2] and len(x[1]) == len(y[1]):
                p, q = unit(np.array([x[1], y[1]]))
                if p @ q >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for i, (d, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((d, len(links[i]), least, d is None or d == least))
    return sorted(out, key=str)


def clouds(n, dim, seed=2, spread=0.05):
    """Unit vectors, a third near copies of others, some in one large cloud."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(n // 3):
        x[rng.integers(n)] = x[rng.integers(n)] * rng.uniform(0.1, 9) + rng.normal(size=dim) * rng.uniform(0, 0.4)
    x[: n // 5] = x[0] + rng.normal(size=(n // 5, dim)) * spread
    return x


@pytest.mark.parametrize("block", [16, 1024])
def test_links_equal_brute_force(spark, block):
    """block=16: several bits, tables and blocks; recall is 1 - MISS at the threshold and more above."""
    x = clouds(240, 24)
    rows = [(int(k), [float(c) for c in v], int(k % 5 > 3)) for k, v in enumerate(x)]
    rows += [(1000 + k, rows[11][1], rows[11][2]) for k in range(20)]
    if block == 16:
        assert bits_and_tables(200, 0.93, block)[1] > 5
    out = near_vectors(spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA), block=block)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, out.collect()), key=str)
    want = brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.999 * there <= found <= there and there > 1000
    assert got == want


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    d = 64
    x = unit(rng.normal(size=(400, d)))
    y = unit(0.95 * x + 0.3 * unit(rng.normal(size=(400, d))))
    true = (x * y).sum(axis=1)
    signs, factor = code(x, Rotations(d, 1)[0])
    estimate = (np.where(signs, 1, -1) * (y @ Rotations(d, 1)[0])).sum(axis=1) / d**0.5 / factor
    spread = np.sqrt((1 - true**2) * (1 - factor**2) / (d - 1)) / factor
    assert abs((estimate - true).mean()) < 0.01 and (np.abs(estimate - true) < 4.5 * spread).all() and 0.8 < ((estimate - true) / spread).std() < 1.2
    p, q = linked_pairs(x, y, 0.93, Rotations(d, 1)[0])
    assert set(zip(p.tolist(), q.tolist())) == {(a, b) for a, b in zip(*np.nonzero(x @ y.T >= 0.93))}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [5e-320, 0.0], 1),
        (10, [1e300, 1e299], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 2), (13, [1.0], 2), (14, [3.0], 2), (8, [1.0, 0.0], 1), (8, [0.0, 1.0], 1), (15, [-0.0, 2.0], 1),
    ]
    docs = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA)
    assert sorted(map(tuple, near_vectors(docs).collect()), key=str) == brute(rows)
    assert sorted((r["vec_id"] or 0) for r in drop_near_vectors(docs).collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 8, 11, 12, 13]
    assert near_vectors(docs.limit(0)).count() == 0
