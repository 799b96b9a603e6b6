import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strandweave.llm import common, importance
from strandweave.llm.importance import bucket_counts, importance_resample


def plain_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=5, least=20):
    """doc_id, n_features, weight, score, rank of (doc_id, text) rows, one feature at a time."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for _, text in rows for f in plain_features(text)[1]) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, features = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in map(bucket, features))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def texts(n, seed=5):
    rng = random.Random(seed)
    words = ["Word", "été", "naïve", "x", "日本語", "a1b2", "LONG" * 30, "end", "mat", "dog"]
    return ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "\t"]) for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 40]))) for _ in range(n)]


@pytest.mark.parametrize("block", [3, 1 << 18])
def test_buckets_of_runs(monkeypatch, block):
    monkeypatch.setattr(importance, "WORDS", block)
    rows = [*texts(60), "", " ", "one", "A" * 100_000, "é" * 70 + " b", "x"]
    raw = [t.encode() for t in rows]
    who, bucket, count, words = bucket_counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for k, t in enumerate(rows):
        own, features = plain_features(t)
        assert words[k] == len(own)
        assert Counter(zlib.crc32(f.encode()) % 10000 for f in features) == dict(zip(bucket[who == k].tolist(), count[who == k].tolist()))


@pytest.mark.parametrize("hot", [3, 10_000])
def test_resampling_equals_feature_by_feature(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)  # 3: texts of many copies by broadcast, others by shuffle
    rows = [(k, t) for k, t in enumerate(texts(90))]
    rows += [(1000 + k, rows[7][1]) for k in range(60)] + [(2000, None), (2001, ""), (None, "dog " * 30), (None, "mat " * 30), (3, rows[3][1]), (3, rows[3][1])]
    target = [(k, t) for k, t in enumerate(texts(8, seed=9))] + [(9, None)]
    docs = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], "doc_id long, text string, digest int, copies string, score int")
    got = importance_resample(docs, spark.createDataFrame(target, "item_id long, text string"), percent=20)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, target, percent=20)


def test_edges(spark, edge, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted(map(tuple, importance_resample(edge, bench).collect()), key=str) == plain(rows, [])
    assert importance_resample(none, bench).count() == 0
