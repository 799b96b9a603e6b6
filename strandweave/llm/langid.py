"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; whatever is no letter becomes a blank. All 1-, 2- and 3-grams are hashed into 2^15 buckets.
Counts per language come from all training documents: each task adds up its own, Spark adds up the tasks'. The matrix of
log probabilities (2^15 x languages, a size that doesn't grow with the corpus) is broadcast, and batches are scored by
gathers and segment sums in numpy.

Edge cases: null text, or text without a letter: `und`, score 0. Null languages are not learned, and classes have no priors. Very long texts are scored whole, one at a time beyond `CHUNK`. No training rows:
`und` for all. Ties go to the language first by code point. Repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import character_kinds, held_back

BITS = 15
#: Characters scored together.
CHUNK = 400_000


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, non-letters as blanks, each text after two blanks; starts; which texts have a letter."""
    lowered = ["  " + (t or "").lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) for t in lowered[:-1]], out=starts[1:])
    letter, _ = character_kinds(points)
    has = np.logical_or.reduceat(letter, starts) if len(points) else np.zeros(0, bool)
    return np.where(letter, points, 32).astype(np.uint32), starts, has


def grams(points: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams that end at each position. Bucket 0 isn't counted: grams of blanks only, and those
    that end in a text's two leading blanks, as they reach into the text before."""
    out, mask = [], np.uint32((1 << BITS) - 1)
    h = np.zeros(len(points), dtype=np.uint32)
    blank = np.ones(len(points), dtype=bool)
    with np.errstate(over="ignore"):
        for n in range(3):
            shifted = np.concatenate([np.full(min(n, len(points)), 32, np.uint32), points[: max(0, len(points) - n)]])
            h = (h + shifted) * np.uint32(2654435761) + np.uint32(n + 1)
            blank &= shifted == 32
            b = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
            out.append(np.where(blank, 0, np.maximum((b >> np.uint32(13)) & mask, 1)))
            out[-1][starts] = out[-1][starts + 1] = 0
    return out


def _batches(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, list[str | None]]]:
    at, held, part = 0, 0, []
    for k, t in enumerate(texts):
        part.append(t.as_py())
        held += len(part[-1] or "")
        if held >= size:
            yield at, part
            at, held, part = k + 1, 0, []
    if part:
        yield at, part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for at, part in _batches(batch.column(0)):
            points, starts, _ = codes(part)
            ends = np.append(starts[1:], len(points))
            every = grams(points, starts)
            for k in range(len(part)):
                into = counts.setdefault(langs[at + k], np.zeros(1 << BITS, dtype=np.int64))
                for g in every:
                    own = g[starts[k] : ends[k]]
                    if len(own) > 4000:
                        into += np.bincount(own, minlength=1 << BITS)
                    else:
                        np.add.at(into, own, 1)
    for lang, c in counts.items():
        b = np.flatnonzero(c)
        b = b[b > 0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b), pa.string()), pa.array(b.astype(np.int32)), pa.array(c[b])], ["lang", "bucket", "n"])


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and the matrix of log probabilities (buckets x languages), from `text, lang`."""
    rows = docs.where("text is not null and lang is not null").select("text", F.col("lang").cast("string")).mapInArrow(_count, "lang string, bucket int, n long")
    counts = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique().tolist())
    table = np.full((1 << BITS, len(langs)), 0.5)
    if langs:
        np.add.at(table, (counts["bucket"].to_numpy(), np.searchsorted(langs, counts["lang"].to_numpy(dtype=str))), counts["n"].to_numpy())
    table = np.log(table / table[1:].sum(axis=0))
    table[0] = 0
    return langs, table.astype(np.float32)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        columns = [np.ascontiguousarray(table[:, j]) for j in range(len(langs))]
        for batch in batches:
            for at, part in _batches(batch.column(1)):
                points, starts, has = codes(part)
                total = np.zeros((len(part), len(langs)))
                for g in grams(points, starts):
                    for j, column in enumerate(columns):
                        total[:, j] += np.add.reduceat(column[g], starts, dtype=np.float64)
                best = total.argmax(axis=1)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names = [langs[k] if ok else "und" for k, ok in zip(best, has)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(names, pa.string()), pa.array(np.where(has, score, 0.0))], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score` for every row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not model[0]:
        return own.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = docs.schema[id_col].dataType.simpleString()
    return own.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), f"doc_id {kind}, lang_pred string, score double")


# ---------------------------------------------------------------- query


def op5_ngram_bayes_langid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, fit(docs.where(~held_back(F.col("doc_id"), 4, 2)).select("text", "lang")))
    return out.select("doc_id", held_back(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_ngram_bayes_langid": op5_ngram_bayes_langid}
ORACLE = {}
