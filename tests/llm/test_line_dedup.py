import random

from strandweave.llm.line_dedup import drop_repeated_lines, removed_by_doc, repeated_lines


def brute(rows, t=0.8):
    lines = [(d, k, x.strip(" \t\v\f\r").lower()) for d, text in sorted(rows) for k, x in enumerate((text or "").split("\n"))]
    lines = [(d, k, x, frozenset(x.split())) for d, k, x in lines if x.split()]
    return {(d, k) for n, (d, k, x, s) in enumerate(lines) if any(len(s & o) >= t * len(s | o) - 1e-9 for _, _, _, o in lines[:n])}


def test_equals_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"tok{k}" for k in range(400)]
    common = ["the", "of", "and"]

    def line(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]

    bases = [line(rng.randint(3, 120)) for _ in range(40)]
    rows = []
    for d in range(60):
        out = []
        for _ in range(rng.randint(1, 6)):
            b = list(rng.choice(bases)) if rng.random() < 0.5 else line(rng.randint(1, 40))
            for _ in range(rng.randint(0, max(1, len(b) // 8))):
                b[rng.randrange(len(b))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                b = [w.upper() for w in b][::-1]
            out.append(" ".join(b))
        rows.append((d, "\n".join(out)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(r["doc_id"], r["line_no"]) for r in repeated_lines(df).collect()}
    assert got == brute(rows)


def test_near_copies_of_one_line(spark):
    rng = random.Random(3)
    base = [f"b{k}" for k in range(30)]
    rows = []
    for d in range(120):
        b = list(base)
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(30)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(b)))
    got = {(r["doc_id"], r["line_no"]) for r in repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_edges(edge, none):
    gone = {r["id"]: list(r["gone"]) for r in removed_by_doc(edge).collect()}
    assert gone[5] == [1] and gone[6] == [0]
    out = drop_repeated_lines(edge)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == edge.columns and 6 not in rows and {1, 2, 3, 4, 5, 8, 9, None} == set(rows)
    assert rows[5]["text"] == "the cat sat on the mat and looked at the dog." and rows[5]["n_chars"] == 45 and rows[2]["text"] == "" and rows[1]["text"] is None
    assert drop_repeated_lines(none).count() == 0
