import math
import random

import numpy as np
import pytest
import xxhash

from strandweave.llm import quality

SYMBOLS, DIGITS = set("#$%&*|<>{}[]=@^~_\\/+"), set("0123456789")


def plain_measures(text):
    """The twelve measures, a character and a word at a time."""
    words, word = [], ""
    for ch in text + " ":
        if ch.isspace():
            words, word = words + [word] if word else words, ""
        else:
            word += ch
    if not words:
        return None
    n, chars = len(words), sum(len(w) for w in words)
    lines = [x for x in text.split("\n") if any(not c.isspace() for c in x)]
    low = []
    for w in words:
        while w and w[0] in ".,;:!?":
            w = w[1:]
        while w and w[-1] in ".,;:!?":
            w = w[:-1]
        low.append(w.lower())
    longest, run = 1, 1
    for k in range(1, n):
        run = run + 1 if low[k] == low[k - 1] else 1
        longest = max(longest, run)
    ended = [x for x in lines if x.rstrip()[-1] in ".!?…:;\"')]"]
    return [
        n, chars / n, sum(c in SYMBOLS for c in text) / chars, sum(not w[-1].isalnum() and w[-1] not in ".,;:!?)\"'" for w in words) / n, sum(c in DIGITS for c in text) / chars,
        sum(len(w) > 1 and w.isupper() for w in words) / n, text.count("!") / n, 1 - len(set(lines)) / len(lines), len(set(low)) / n**0.8, len(ended) / len(lines),
        sum(w in quality.FUNCTION_WORDS for w in low) / n, longest,
    ]


def plain_votes(m):
    x = dict(zip(quality.MEASURES, m))
    bad = {
        "words": x["words"] < 5, "word_length": x["word_length"] < 2.2 or x["word_length"] > 15, "symbols": x["symbols"] > 0.05, "marked": x["marked"] > 0.15, "digits": x["digits"] > 0.25, "upper": x["upper"] > 0.4,
        "shouts": x["shouts"] > 0.15, "repeated_lines": x["repeated_lines"] > 0.3, "distinct": x["distinct"] < 0.5 and x["words"] >= 30, "ends": x["ends"] < 0.2 and x["words"] >= 30,
        "function": x["function"] < 0.03 and x["words"] >= 20, "longest_run": x["longest_run"] >= 6,
    }
    good = {"words": x["words"] >= 50, "distinct": x["distinct"] > 0.9, "ends": x["ends"] > 0.6, "function": x["function"] > 0.08}
    return tuple(-1 if bad[k] else int(good.get(k, False)) for k in quality.MEASURES)


def texts(n, seed=3):
    rng = random.Random(seed)
    pool = ["the", "of", "THE", "word", "été", "x", "12", "3%", "a_b", "end.", "wow!!", "(so)", "veryveryverylongword", "…", "!", "same"]
    return ["".join(rng.choice(pool) + rng.choice([" ", " ", "\n", ". ", "\t"]) * rng.randint(1, 2) for _ in range(rng.choice([1, 4, 25, 70]))) + rng.choice(["", "same " * 8]) for _ in range(n)]


def test_measures_and_votes_equal_plain_versions():
    for t in texts(150):
        m, want = quality.measure(t), plain_measures(t)
        assert m.tolist() == pytest.approx(want) and quality.votes(m) == plain_votes(want)
    assert quality.measure(" \n\t") is None and quality.measure(None) is None


def test_scores_equal_a_plain_sum(spark):
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(1 << quality.BITS) + 1).astype(np.float32)
    rows = [*enumerate(texts(40, seed=8)), (100, None), (101, " "), (102, "word " * 50_000)]
    got = {r["doc_id"]: r for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).collect()}
    bucket = lambda b: xxhash.xxh3_64_intdigest(b) >> (64 - quality.BITS)
    for k, t in rows:
        m = plain_measures(t or "")
        if m is None:
            assert (got[k]["score"], got[k]["kept"]) == (0.0, False)
            continue
        counts = {}
        for w in t.lower().encode().split():
            counts[w] = counts.get(w, 0) + 1
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
        z = float(weights[-1]) + sum(math.log1p(c) / norm * float(weights[bucket(w)]) for w, c in counts.items())
        z += sum(0.5 * float(weights[bucket(f"{name}:{round(math.log2(max(x, 1e-3)) * 2)}".encode())]) for name, x in zip(quality.MEASURES, m))
        assert got[k]["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5) and got[k]["kept"] == (got[k]["score"] >= quality.KEEP)


def test_labels_of_a_fit_are_the_posteriors(spark, monkeypatch):
    """What the scorer learns from: votes of all documents, counted, and each sampled text under the posterior of its pattern."""
    seen = {}
    monkeypatch.setattr(quality, "fit_linear", lambda rows, y: seen.update(y=y, n=len(rows)) or np.zeros((1 << quality.BITS) + 1, np.float32))
    rows = [*enumerate(texts(60, seed=4)), (100, None)]
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    patterns = [plain_votes(plain_measures(t)) for _, t in rows if t]
    distinct = sorted(set(patterns))
    post, _ = quality.expectation_maximisation(np.array(distinct), np.array([patterns.count(p) for p in distinct], dtype=float))
    label = dict(zip(distinct, post))
    assert seen["n"] == 60 and seen["y"].tolist() == pytest.approx([label[p] for p in patterns])
