"""Sequence functions as column expressions: normalising, complement, homopolymers, k-mer entropy, BTOP parsing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bases and ambiguity codes with their complements.
_BASES, _COMPLEMENTS = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"


def normalize_sequence(seq: Column) -> Column:
    """Gaps `n+` out, upper case, all but AGCT to `n` (SEQ-01)."""
    return F.regexp_replace(F.upper(F.regexp_replace(seq, "n+", "")), "[^AGCT]", "n")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, _BASES, _COMPLEMENTS))


def count_bp(seq: Column) -> Column:
    """Number of A, G, C and T (SEQ-10)."""
    return F.length(seq) - F.length(F.translate(seq, "AGCT", ""))


def homopolymer_ratio(seq: Column, kmin: int = 5) -> Column:
    """Share of the sequence in runs of more than kmin equal letters; null for an empty sequence (SEQ-03)."""
    return F.when(F.length(seq) > 0, 1 - F.length(F.regexp_replace(seq, rf"([A-Z])\1{{{kmin},}}", "")) / F.length(seq))


def _entropy(codes: np.ndarray, letters: int, k: int) -> float:
    """Entropy of the k-mers of a text of letter codes, in bits over 2k; 0 where it is shorter than k."""
    n = len(codes) - k + 1
    if n < 1:
        return 0.0
    words, base = codes[:n].astype(np.int64), letters
    for j in range(1, k):
        if base > (1 << 62) // letters:  # ranks instead of numbers that no longer fit
            words = np.unique(words, return_inverse=True)[1]
            base = int(words.max()) + 1
        words, base = words * letters + codes[j : n + j], base * letters
    counts = np.bincount(words) if base <= 4 * n + 1024 else np.unique(words, return_counts=True)[1]
    counts = counts[counts > 0]
    return float((np.log2(n) - (counts * np.log2(counts)).sum() / n) / (2 * k))


def with_entropies(df: DataFrame, seq: str, ks: Sequence[int]) -> DataFrame:
    """df with `entropy{k}` for each k instead of the column seq (SEQ-02), in one Arrow pass without a shuffle.

    A sequence takes about 24 bytes of a worker's memory a base. Null sequences have entropy 0.
    """
    at, keep = df.columns.index(seq), [k for k, c in enumerate(df.columns) if c != seq]
    schema = T.StructType([*(df.schema.fields[k] for k in keep), *(T.StructField(f"entropy{k}", T.DoubleType()) for k in ks)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[float]] = [[] for _ in ks]
            for text in batch.column(at):
                points = np.frombuffer((text.as_py() or "").encode("utf-32-le"), dtype=np.uint32)
                letters, codes = np.unique(points, return_inverse=True)
                for own, k in zip(found, ks):
                    own.append(_entropy(codes, max(len(letters), 1), k))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *(pa.array(x, pa.float64()) for x in found)], [*(batch.schema.names[k] for k in keep), *(f"entropy{k}" for k in ks)])

    return df.mapInArrow(run, schema)


def sequence_entropy(df: DataFrame, key: str, seq: str, k: int, name: str | None = None) -> DataFrame:
    """`key, entropy{k}`: Shannon entropy of k-mers in bits over 2k, 0 for sequences shorter than k."""
    return with_entropies(df.select(key, seq), seq, [k]).withColumnRenamed(f"entropy{k}", name or f"entropy{k}")


def btop_ops(btop: Column) -> Column:
    """A BTOP string to array<struct<matched, q, s>>: runs of matches, each followed by one edit (SEQ-05)."""
    tokens = F.regexp_extract_all(btop, F.lit(r"([0-9]+)?([A-Za-z*-]{2}|$)"), F.lit(0))
    tokens = F.filter(tokens, lambda t: t != "")
    edit = lambda t: F.regexp_extract(t, r"([A-Za-z*-]{2})$", 1)
    return F.transform(
        tokens,
        lambda t: F.struct(
            F.coalesce(F.regexp_extract(t, r"^([0-9]+)", 1).try_cast("int"), F.lit(0)).alias("matched"), F.substring(edit(t), 1, 1).alias("q"), F.substring(edit(t), 2, 1).alias("s")
        ),
    )


def btop_lengths(ops: Column) -> tuple[Column, Column]:
    """Lengths of the query and of the subject part that the operations span."""
    one = lambda side: F.aggregate(ops, F.lit(0), lambda a, o: a + o["matched"] + ((o[side] != "") & (o[side] != "-")).cast("int"))
    return one("q"), one("s")


def is_forward(sstart: Column, send: Column) -> Column:
    """Forward only if send > sstart: a hit of one base counts as reverse (SEQ-11)."""
    return send > sstart


def sub_sequence(seq: Column, start: Column, stop: Column | None = None) -> Column:
    """1-based closed slice (SRC-06)."""
    return F.substring(seq, start, (F.length(seq) if stop is None else stop) - start + 1)
