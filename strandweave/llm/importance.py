"""Target-distribution importance resampling: draw documents by how much more likely the target text makes their n-grams.

Features are all runs of 1 to 3 consecutive words, hashed by crc32 into buckets; a bucket's gain is the scaled log ratio
of its smoothed shares in the target (`benchmark`) and in the corpus, and a document's weight is the sum of its features'
gains. Gumbel noise from a hash of the id turns the largest scores into a draw without replacement.

Identical texts are collapsed first, by grouping full texts (copies combine before the shuffle); each distinct text is
cut into words and hashed once, and kept as its distinct buckets and their counts. Corpus counts are those counts times
the text's copies. Weights go back to the documents by the sha-256 of the text, before any noise is added: noise belongs
to a document, not to its text. Texts with so many copies that there can't be over `HOT` of them are joined by broadcast,
the rest by shuffle, so a group with a third of all rows is not gathered.

The crc32 of a run is put together from the crc32s of its words: appending n bytes multiplies a crc by a fixed matrix for
n, so a word's bytes are read once for the three runs that end in it, for all words of a batch at a time.

The draw is one global order of the scores: range partitions numbered inside and offset by the sizes of those before.

Edge cases: null text: no words. Empty or blank texts: 0 features, weight 0, scored but too short to be drawn. Very long
texts: read in blocks of `WORDS` words with two words of overlap. Null ids hash as if empty, and come last among ties. Rows that
repeat an id are scored and drawn each for itself; ties beyond the id are ordered by n_features and then can't be told apart. Empty
tables: no rows; an empty target leaves smoothing alone (T = t = 0). Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import join_copies, materialize

BUCKETS, ORDER = 10_000, 3
#: Words hashed together, and bytes of texts read together; they bound a worker's memory.
WORDS, BYTES = 1 << 18, 1 << 21
#: Tasks that add up the tasks' histograms; the driver gets one of 80 kB from each.
SUMS = 16


def _byte_kinds() -> np.ndarray:
    """For each byte its lower-case form if it belongs to a word, else 0. All bytes of non-ASCII characters belong to words."""
    kinds = np.arange(256, dtype=np.uint8)
    kinds[65:91] += 32
    letter = np.zeros(256, dtype=bool)
    letter[48:58] = letter[97:123] = letter[65:91] = letter[128:] = True
    return np.where(letter, kinds, 0).astype(np.uint8)


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The 256 steps of crc32 by a byte; for k = 0, 1, ..., 30 the effect of 2^k zero bytes on each of a crc's four bytes."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    parts = np.array([[b << (8 * j) for b in range(256)] for j in range(4)], dtype=np.uint32)
    one = step[parts & 0xFF] ^ (parts >> 8)
    shifts = [one]
    for _ in range(30):
        last = shifts[-1]
        shifts.append(_apply(last, last))
    return step, np.stack(shifts)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]


_KIND = _byte_kinds()
_STEP, _SHIFT = _crc_tables()


def appended(crc: np.ndarray, more: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of texts with `crc` followed by texts with crc32 `more` and `length` bytes."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero((length >> k) & 1)
        out[at] = _apply(_SHIFT[k], out[at])
    return out ^ more


def word_crcs(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of the words text[start : start + length]."""
    crc = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    order = np.argsort(-length, kind="stable")
    ends = np.cumsum(np.bincount(length, minlength=1)[::-1])[::-1]  # words of at least so many bytes
    s, c = start[order], crc[order]
    for k in range(min(64, len(ends) - 1)):
        n = ends[k + 1]
        c[:n] = _STEP[(c[:n] ^ text[s[:n] + k]) & 0xFF] ^ (c[:n] >> 8)
    crc[order] = c ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > 64):
        crc[i] = zlib.crc32(text[start[i] : start[i] + length[i]].tobytes())
    return crc


def run_buckets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For UTF-8 texts raw[offsets[i] : offsets[i + 1]]: blocks of (text number of a feature, its bucket), and how many
    words each text has in the block."""
    low = _KIND[raw]
    inside = low != 0
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    first = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]])
    last = np.flatnonzero(inside & (~after | edge[1:]))
    owners = np.searchsorted(offsets, first, side="right") - 1
    lengths = last + 1 - first
    n_texts = len(offsets) - 1
    space = np.uint32(zlib.crc32(b" "))
    for at in range(0, len(first), WORDS):
        since = max(0, at - ORDER + 1)
        start, length, owner = (x[since : at + WORDS] for x in (first, lengths, owners))
        new = np.arange(len(start)) >= at - since
        word = word_crcs(low, start, length)
        spaced = appended(np.full(len(word), space), word, length)
        run, who, what = word, [owner[new]], [word[new]]
        for k in range(1, ORDER):
            run = appended(run[:-1], spaced[k:], length[k:] + 1)
            ok = new[k:] & (owner[k:] == owner[:-k])
            who.append(owner[k:][ok])
            what.append(run[ok])
        yield np.concatenate(who), (np.concatenate(what) % BUCKETS).astype(np.int64), np.bincount(owner[new], minlength=n_texts)


def bucket_counts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text numbers, buckets, counts) of all distinct pairs, in order, and the words of each text."""
    n_texts = len(offsets) - 1
    found, words = [], np.zeros(n_texts, dtype=np.int64)
    for who, bucket, n in run_buckets(raw, offsets):
        found.append(np.unique(who * BUCKETS + bucket, return_counts=True))
        words += n
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, words
    pair, count = found[0]
    if len(found) > 1:
        pair, back = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate([c for _, c in found])).astype(np.int64)
    return pair // BUCKETS, pair % BUCKETS, count, words


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts of about BYTES, or of one longer text."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BYTES, side="right")) - 1)
        yield at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, copies, text) to (digest, copies, n_words, n_features, buckets, counts); the lists are little-endian integers."""
    for batch in batches:
        for at, raw, offsets in _slices(batch.column(2)):
            who, bucket, count, words = bucket_counts(raw, offsets)
            part = batch.slice(at, len(words))
            cuts = np.searchsorted(who, np.arange(len(words) + 1))
            total = np.concatenate([[0], np.cumsum(count)])[cuts]
            short, long_ = bucket.astype("<u2").tobytes(), count.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(words), pa.array(np.diff(total)),
                    pa.array([short[2 * a : 2 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()), pa.array([long_[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                ["digest", "copies", "n_words", "n_features", "buckets", "counts"],
            )


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, buckets and counts of a batch of (..., buckets, counts)."""
    bucket = np.frombuffer(b"".join(batch.column(batch.num_columns - 2).to_pylist()), "<u2").astype(np.int64)
    count = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), "<u4").astype(np.int64)
    sizes = np.array([len(x.as_buffer()) // 2 for x in batch.column(batch.num_columns - 2)], dtype=np.int64)
    return np.repeat(np.arange(batch.num_rows), sizes), bucket, count


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(copies, buckets, counts) to one row: the features of all buckets."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        row, bucket, count = _lists(batch)
        np.add.at(total, bucket, count * batch.column(0).to_numpy(zero_copy_only=False)[row])
    yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], ["totals"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.frombuffer(x.as_buffer(), "<i8")
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["totals"])


def _weigh(gains):
    """(digest, copies, n_words, n_features, buckets, counts) to (digest, copies, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket, count = _lists(batch)
            weight = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(weight, row, gains.value[bucket] * count)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(weight)], ["digest", "copies", "n_words", "n_features", "weight"])

    return run


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`digest, copies, n_words, n_features, buckets, counts` of each distinct text; null counts as empty."""
    texts = docs.groupBy(_whole(text_col).alias("text")).agg(F.count("*").alias("copies"))
    texts = texts.select(_digest(F.col("text")).alias("digest"), "copies", "text")
    return texts.mapInArrow(_features, "digest binary, copies long, n_words long, n_features long, buckets binary, counts binary")


def _whole(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def histogram(features: DataFrame) -> np.ndarray:
    """Features in each bucket, copies included: a row for each task, added in SUMS tasks, and those on the driver."""
    rows = features.select("copies", "buckets", "counts").mapInArrow(_histogram, "totals binary").repartition(SUMS).mapInArrow(_added, "totals binary").collect()
    return sum((np.frombuffer(r["totals"], "<i8") for r in rows), np.zeros(BUCKETS, dtype=np.int64))


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of a bucket's smoothed share in the target to that in the corpus)."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of a sha-256 of the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(
    docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """`doc_id, n_features, weight, score, rank` of every document; rank is null where it isn't drawn."""
    spark = docs.sparkSession
    texts = materialize(text_features(docs, text_col))
    gains = gains_of(histogram(texts), histogram(text_features(target, target_col)))
    weights = materialize(texts.mapInArrow(_weigh(spark.sparkContext.broadcast(gains)), "digest binary, copies long, n_words long, n_features long, weight long"))
    rows = docs.select(F.col(id_col).alias("doc_id"), _digest(_whole(text_col)).alias("digest"))
    scored = join_copies(rows, weights, ["digest"], "copies").drop("digest", "copies")
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    fit = scored.where(F.col("n_words") >= least_words)
    draw = percent * fit.count() // 100
    order = fit.withColumn("order", -F.col("score")).withColumn("nameless", F.col("doc_id").isNull())
    placed = numbered(order, ["order", "nameless", "doc_id", "n_features"], "place").withColumn("rank", F.when(F.col("place") < draw, F.col("place") + 1))
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    return placed.select(*names).unionByName(short.select(*names))


# ---------------------------------------------------------------- query


def op12_importance_resampling(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return importance_resample(read("documents"), read("benchmark"))


QUERIES = {"op12_importance_resampling": op12_importance_resampling}

#: crc32 by bytes over the distinct features; bytes come from the hexadecimal form.
ORACLE = {
    "op12_importance_resampling": r"""
WITH tab AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t FROM range(256) v(b)),
texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
p AS (SELECT kind, id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
f AS (
  SELECT kind, id, ws[i] AS f FROM p
  UNION ALL SELECT kind, id, ws[i] || ' ' || ws[i + 1] FROM p WHERE i + 1 <= len(ws)
  UNION ALL SELECT kind, id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM p WHERE i + 2 <= len(ws)),
n AS (SELECT kind, id, f, count(*) AS c FROM f GROUP BY ALL),
u AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM n),
raw AS (
  SELECT f, list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) + 1, 2), lambda i: CAST((instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1 AS BIGINT))) AS xs FROM u),
h AS (
  SELECT f, xor(list_reduce(xs, lambda c, b: xor(c // 256, tab.t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS b FROM raw, tab),
c AS (SELECT kind, id, b, sum(c) AS c FROM n JOIN h USING (f) GROUP BY ALL),
s AS (SELECT b, sum(c) FILTER (kind = 'd') AS s, sum(c) FILTER (kind = 'b') AS t FROM c GROUP BY b),
z AS (SELECT coalesce(sum(s), 0) AS sa, coalesce(sum(t), 0) AS ta FROM s),
g AS (
  SELECT b, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sa + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * (ta + 10000)::DOUBLE))) AS BIGINT) AS g FROM s, z),
d AS (SELECT id, CAST(sum(c) AS BIGINT) AS n_features, CAST(sum(c * g) AS BIGINT) AS weight FROM c JOIN g USING (b) WHERE kind = 'd' GROUP BY id),
k AS (
  SELECT id AS doc_id, len(ws) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    (SELECT list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i: CAST(instr('0123456789abcdef', sha256('42:' || coalesce(CAST(w.id AS VARCHAR), ''))[i]) - 1 AS BIGINT))), lambda a, x: a * 16 + x)) AS hash
  FROM w LEFT JOIN d USING (id) WHERE w.kind = 'd'),
e AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((hash + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score, coalesce(words, 0) >= 20 AS fit FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fit) OVER () * 5 // 100 AS draw FROM e)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN fit AND place <= draw THEN place END AS rank FROM r
"""
}
