"""Quality classifier from weak labels.

Twelve heuristic labellers vote good, bad or abstain on a text's shape. A labeller's accuracies on good and on bad
documents, and the share of good ones, are estimated by expectation-maximisation over the counts of all documents' vote
patterns (at most 3^12, in practice dozens, counted by Spark). The posterior of each pattern then labels documents for the scorer that is
applied: logistic regression on hashed words and on hashed steps of the same measures, trained on a bounded sample of
documents by hash of the id, and broadcast (2^16 weights). It sees words that the labellers don't.

Edge cases: null, empty or blank text: score 0, not kept. Very long texts are measured whole, one at a time. No documents: no rows. If all votes abstain the prior decides.
Repeated rows score alike; extra columns are ignored by `score`, kept by nothing else here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, materialize, word_hashes

BITS, SAMPLE, KEEP, RATIO = 16, 6000, 0.5, 30
_SYMBOL = str.maketrans("", "", "#$%&*|<>{}[]=@^~_\\/+")
_DIGIT = str.maketrans("", "", "0123456789")
_END = re.compile(r"[.!?…:;\"')\]]\s*$")
# Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it with as was on are be this by at from or an have not which"
    " der die das und in zu den von mit ist des ein eine auf für nicht sich dem als"
    " le la les de des et en un une du que qui dans est pour au sur par avec"
    " el los las y en un una que por con para se del al es no".split()
)
MEASURES = ("words", "word_length", "symbols", "marked", "digits", "upper", "shouts", "repeated_lines", "distinct", "ends", "function", "longest_run")


def measure(text: str | None) -> np.ndarray | None:
    """The measures of a text, None where there is no word."""
    words = (text or "").split()
    if not words:
        return None
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    low = [w.strip(".,;:!?").lower() for w in words]
    counts = len(set(low))
    run = best = 1
    for a, b in zip(low, low[1:]):
        run = run + 1 if a == b else 1
        if run > best:
            best = run
    return np.array(
        [
            n,
            chars / n,
            (len(text) - len(text.translate(_SYMBOL))) / chars,
            sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:!?)\"'") / n,
            (len(text) - len(text.translate(_DIGIT))) / chars,
            sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
            text.count("!") / n,
            1 - len(set(lines)) / len(lines),
            counts / n**0.8,
            sum(1 for x in lines if _END.search(x)) / len(lines),
            sum(1 for w in low if w in FUNCTION_WORDS) / n,
            best,
        ]
    )


def votes(m: np.ndarray) -> tuple[int, ...]:
    """+1 good, -1 bad, 0 abstain, for each labeller."""
    n, length, symbols, marked, digits, upper, shouts, repeated, distinct, ends, function, run = m
    # most labellers only know one way to be bad, and abstain else
    return (
        -1 if n < 5 else 1 if n >= 50 else 0,
        -1 if length < 2.2 or length > 15 else 0,
        -1 if symbols > 0.05 else 0,
        -1 if marked > 0.15 else 0,
        -1 if digits > 0.25 else 0,
        -1 if upper > 0.4 else 0,
        -1 if shouts > 0.15 else 0,
        -1 if repeated > 0.3 else 0,
        -1 if distinct < 0.5 and n >= 30 else 1 if distinct > 0.9 else 0,
        -1 if ends < 0.2 and n >= 30 else 1 if ends > 0.6 else 0,
        -1 if function < 0.03 and n >= 20 else 1 if function > 0.08 else 0,
        -1 if run >= 6 else 0,
    )


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Posterior probability of `good` for each pattern of votes, and the share of good documents.

    Each labeller has vote probabilities given good and given bad; a bad vote starts out 15 times likelier for bad documents, a good one twice as likely for good ones.
    """
    k = patterns.shape[1]
    table = np.empty((2, k, 3))  # class (bad, good), labeller, vote + 1
    for j in range(k):
        table[0, j], table[1, j] = (0.3, 0.4, 0.3), (0.02, 0.43, 0.55)
    prior = 0.8
    at = patterns + 1
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        logs = [np.log(p) + np.log(table[c, np.arange(k)[None, :], at]).sum(axis=1) for c, p in ((0, 1 - prior), (1, prior))]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        done, post = np.abs(new - post).max() < 1e-7, new
        if done:
            break
        w = np.stack([(1 - post) * counts, post * counts])
        prior = float(np.clip((w[1].sum() + 8) / (w.sum() + 10), 0.05, 0.99))
        for v in range(3):
            table[:, :, v] = w @ (at == v) + np.where(v == 1, 1, [[1], [1]])
        table /= table.sum(axis=2, keepdims=True)
        # labellers are better than chance: a bad vote is RATIO times likelier for bad documents at least, a good one as likely
        table[0, :, 0] = np.maximum(table[0, :, 0], np.minimum(RATIO * table[1, :, 0], 0.6))
        table[1, :, 0] = np.minimum(table[1, :, 0], table[0, :, 0] / RATIO)
        table[1, :, 2] = np.maximum(table[1, :, 2], table[0, :, 2])
        table /= table.sum(axis=2, keepdims=True)
    return post, prior


def features(text: str, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: words weigh a unit in all, each measure's step weighs a half."""
    words, n = np.unique(word_hashes(text.lower().encode("utf-8", "surrogatepass").split()), return_counts=True)
    value = np.log1p(n)
    steps = [xxhash.xxh3_64_intdigest(f"{name}:{s}") for name, s in zip(MEASURES, np.round(np.log2(np.maximum(m, 1e-3)) * 2).astype(int).tolist())]
    index = np.concatenate([words, np.array(steps, dtype=np.uint64)]) >> np.uint64(64 - BITS)
    return index.astype(np.int64), np.concatenate([value / np.linalg.norm(value), np.full(len(steps), 0.5)])


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, updates: int = 48_000, rate: float = 0.3, decay: float = 1e-5, seed: int = 3) -> np.ndarray:
    """Weights (the last is the bias) of a logistic model for soft labels y, by adaptive gradient steps."""
    w, g = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-3)
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean(), 0.02, 0.98))
    for _ in range(-(-updates // len(rows))):
        for k in rng.permutation(len(rows)):
            i, v = rows[k]
            p = 1 / (1 + np.exp(-np.clip(w[i] @ v + w[-1], -30, 30)))
            e = (p - y[k]) * (0.5 / share * y[k] + 0.5 / (1 - share) * (1 - y[k]))
            step = e * v + decay * w[i]
            np.add.at(g, i, step * step)
            np.add.at(w, i, -rate * step / np.sqrt(g[i]))
            g[-1] += e * e
            w[-1] -= rate * e / np.sqrt(g[-1])
    return w.astype(np.float32)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = []
        for t in batch.column(0):
            m = measure(t.as_py())
            keys.append(None if m is None else ",".join(map(str, votes(m))))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["votes"])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            out = []
            for t in batch.column(1):
                text = t.as_py()
                m = measure(text)
                if m is None:
                    out.append(0.0)
                    continue
                i, v = features(text, m)
                out.append(float(1 / (1 + np.exp(-np.clip(w[i] @ v + w[-1], -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return run


def fit(docs: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray | None:
    """Weights from the votes of all documents and a training sample of at most `sample`."""
    text = docs.select(F.col(text_col).cast("string").alias("text"))
    seen = text.mapInArrow(_votes, "votes string").where("votes is not null").groupBy("votes").count().orderBy("votes").collect()
    if not seen:
        return None
    patterns = np.array([[int(x) for x in r["votes"].split(",")] for r in seen])
    post, _ = expectation_maximisation(patterns, np.array([r["count"] for r in seen], dtype=float))
    label = {tuple(p): q for p, q in zip(patterns.tolist(), post.tolist())}
    ids = materialize(hash_sample(docs.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct(), "doc_id", sample, 23))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    rows, y = [], []
    for r in own.orderBy("doc_id", "text").toLocalIterator():
        m = measure(r["text"])
        if m is not None:
            rows.append(features(r["text"], m))
            y.append(label.get(votes(m), 0.5))
    return fit_linear(rows, np.array(y)) if rows else None


def score(docs: DataFrame, weights: np.ndarray | None, *, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, score, kept` for every row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if weights is None:
        return own.select("doc_id", F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = own.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(weights)), f"doc_id {kind}, score double")
    return out.withColumn("kept", F.col("score") >= keep)


# ---------------------------------------------------------------- query


def op4_weak_label_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fit(docs))


QUERIES = {"op4_weak_label_quality": op4_weak_label_quality}
ORACLE = {}
