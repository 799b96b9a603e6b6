from itertools import permutations

from strandweave.llm.filter_audit import audit_filters, failed


def fails(rows):
    """The set of filters each (doc_id, text, source) row fails, by their definitions."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = text.split()  # the texts below have no other white space than ASCII
        own = {"A"} if len(words) < 50 else set()
        own |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        own |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        own |= {"D"} if any(c in "#$%&*|" for c in text) else set()
        own |= {"E"} if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows) else set()
        out.append(own)
    return out


def walk(rows, labels):
    out = set()
    sets = fails(rows)
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], s) for r, s in zip(rows, sets) if (r[2] or "") == part]
        lines, shapley = [], {}
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                redundant = sum(f in s for _, s in own) - len(removed)
                shapley[f] = shapley.get(f, 0) + len(removed)
                lines.append((part, "".join(order), k + 1, len(left), len(removed), redundant, sum(s == {f} for _, s in own), sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed)))
        out |= {(*x, shapley[x[1][x[2] - 1]]) for x in lines}
    return out


def test_audit_equals_walking_every_order(spark):
    varied = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", "short", varied, varied + " #", varied.upper(), "same " * 70, "SAME " * 70, "é" * 30 + "A", varied + "  \n\t", "5% A"]
    rows = [(k, texts[k * 7 % len(texts)], ["a", None, "", "b"][k % 4]) for k in range(40)] + [(None, varied, "a"), (None, varied, "a"), (12, varied, "b"), (12, varied, "a"), (0, varied, "zz")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 50, 2)] + [(None, 1, 1), (4, 1, 1), (4, 0, 0), (6, None, None)]
    docs = spark.createDataFrame([(*r, 1, "m", 2, 3) for r in rows], "doc_id long, text string, source string, mask int, part string, digest int, good int")
    marks = spark.createDataFrame([(d, None if q is None else int(q), None if t is None else int(t)) for d, q, t in labels], "doc_id long, quality int, toxic int")
    out = audit_filters(docs, marks)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = [tuple(r) for r in out.collect()]
    want = walk(rows, labels)
    assert len(got) == len(want) == 4 * 600 and set(got) == want  # a, b, zz and the empty part


def test_edges(spark, edge, none, no_labels):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in edge.collect()]
    assert {tuple(r) for r in audit_filters(edge, no_labels).collect()} == walk(rows, [])
    assert audit_filters(none, no_labels).count() == 0
    assert failed("x" * 10**6) == 1 and failed("# " * 10**6) == 2 + 8
