"""Operators that need no state over a stream, and windowed coverage with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import count_bp, homopolymer_ratio, normalize_sequence


def contig_qc(records: DataFrame, kmin: int = 5) -> DataFrame:
    """Lengths and homopolymer share of streamed `acc, seq` records."""
    used = normalize_sequence(F.col("seq"))
    return records.select("acc", F.length("seq").alias("len_all"), F.length(used).alias("len_used"), count_bp(F.col("seq")).alias("bp"), homopolymer_ratio(used, kmin).alias("frac_hp"))


def reads_per_window(events: DataFrame, ts: str, key: str, *, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by key and event-time window; state older than the watermark is dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, every), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
