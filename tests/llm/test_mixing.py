import random

import pytest

from strandweave.llm.mixing import fair_mix


def fill(sizes, weights, share, repeats):
    """Targets by resharing the excess of capped sources until there is none."""
    target, left, open_ = {}, share * sum(sizes.values()), set(sizes)
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > repeats * sizes[s]}
        if not over:
            target |= {s: level * weights[s] for s in open_}
            break
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_taken(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["a", "b", "b", "b", "b", "d", None]), " ".join("w" * rng.randint(1, 40))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = fair_mix(df, rows_per_slot=10).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = fill(sizes, {"a": 3, "b": 1, "d": 2, None: 3}, 1.5, 2)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    # served in virtual time: a document that ends before time 1 in its source's queue is taken whole
    assert all(r["taken"] >= r["size"] for r in out if r["finish"] <= 1)
    again = {(r["doc_id"], r["taken"]) for r in fair_mix(df.repartition(7), rows_per_slot=10).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in out}
    coarse = {(r["doc_id"], r["taken"]) for r in fair_mix(df, rows_per_slot=1000).collect()}
    assert coarse == again


def simulated(rows, weights, packets):
    """Packets served one by one: always the one of the least virtual finish time, until the budget is used up."""
    import hashlib
    from math import ceil, floor

    sizes, queues = {}, {}
    for k, s, t in sorted(rows, key=lambda r: (hashlib.md5(f"17:{r[0]}".encode()).hexdigest(), r[0], len(r[2].split()))):
        sizes[s] = sizes.get(s, 0) + len(t.split())
        queues.setdefault(s, []).append((k, len(t.split())))
    target = fill(sizes, weights, 1.5, 2)
    waiting = []
    for s, queue in queues.items():
        at, quantum = 0, max(1, ceil(target[s] / packets))
        for k, n in queue * 2:
            for lo in range(0, n, quantum):
                part = min(quantum, n - lo)
                waiting.append(((at + lo + part) / target[s], "-" if s is None else "+" + s, at + lo + part, k, part))
            at += n
    left, taken = floor(sum(target.values())), {}
    for _, _, _, k, n in sorted(waiting):
        n = min(n, left)
        taken[k], left = taken.get(k, 0) + n, left - n
    return taken


@pytest.mark.parametrize("packets", [1, 7, 4096])
def test_taken_equals_a_sequential_simulation(spark, packets):
    rng = random.Random(packets)
    rows = [(k, rng.choice(["a", "b", "b", "b", "d", None]), " ".join("w" * rng.randint(0, 60))) for k in range(150)]
    out = fair_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), packets=packets, rows_per_slot=10).collect()
    want = simulated(rows, {"a": 3, "b": 1, "d": 2, None: 3}, packets)
    assert {r["doc_id"]: r["taken"] for r in out} == {k: want.get(k, 0) for k, _, _ in rows}


def test_equal_ids_and_sizes_are_told_apart(spark):
    rows = [(1, "a", "x y z"), (1, "a", "u v w"), (2, "b", "p q"), (2, "b", "p q")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    runs = [sorted((r["text"], r["taken"]) for r in fair_mix(df.repartition(n), share=0.5).collect()) for n in (1, 3)]
    assert runs[0] == runs[1]


def test_edges(edge, none):
    out = fair_mix(edge).collect()
    assert len(out) == edge.count() and {r["size"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert sum(r["taken"] for r in out) <= 1.5 * sum(r["size"] for r in out) and "component_id" in out[0].asDict()
    assert fair_mix(none).count() == 0
