"""Helpers shared by the training-data operators: table access, scratch tables, word splitting and word hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import shared_folder as scratch_dir  # noqa: F401
from ..scratch import written as materialize  # noqa: F401

#: A word is a run of anything but ASCII white space, as bytes.split() sees it.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Fixed odd multipliers for mixing 64-bit hashes.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_words(text: Column) -> Column:
    """The number of words of a text, JVM-side; 0 for null. Runs of non-space become one mark, then marks are counted."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\u000b\u000c\r", "")), F.lit(0)).cast("long")


def held_back(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows that training may not use: crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


_KINDS: list[np.ndarray] = []


def character_kinds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the code points are letters, and which are white space."""
    if not _KINDS:
        plane = [chr(i) for i in range(0x10000)]
        _KINDS.extend((np.array([c.isalpha() for c in plane]), np.array([c.isspace() for c in plane])))
    low = np.minimum(points, 0xFFFF)
    high = points >= 0x10000
    letter, space = np.where(high, False, _KINDS[0][low]), np.where(high, False, _KINDS[1][low])
    for p in np.unique(points[high]):
        letter[points == p] = chr(p).isalpha()
    return letter, space


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_B
        x = (x ^ (x >> np.uint64(27))) * MIX_C
        return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of `width` words, in text order; one hash of the whole where there are fewer words."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - span + 1, np.uint64(span), dtype=np.uint64)
        for k in range(span):
            out = (out ^ hashes[k : n - span + 1 + k]) * MIX_A
            out ^= out >> np.uint64(29)
    return scramble(out)


def hash_sample(rows: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """At most `most` rows of distinct keys, those of the smallest hashes. A threshold on the hash, from a count, leaves
    hardly more rows than these for the final sort, however many tasks there are."""
    hashed = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30))
    total = rows.count()
    if total > 2 * most:
        rows = rows.where(hashed < int((1 << 30) * (most + 10 * most**0.5 + 100) / total))
    return rows.orderBy(hashed, key).limit(most)


#: Most ids for which an id list may be broadcast (16 bytes each in the hashed relation, so about 16 MB).
BROADCAST_IDS = 500_000


def by_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """rows semi- or anti-joined with ids on key, null being an id like others: by broadcast where the counted ids are
    few, else by shuffle."""
    own = unused("joined_id", rows)
    ids = ids.select(F.col(key).alias(own)).distinct()
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, rows[key].eqNullSafe(F.col(own)), how)


#: Groups of copies joined by broadcast are those with over 1 / HOT of all rows: there can't be more than HOT of them.
HOT = 10_000


def join_copies(rows: DataFrame, groups: DataFrame, keys: list[str], copies: str) -> DataFrame:
    """rows with the columns of their group. groups has one row for each combination of keys (without nulls) and how many rows share it.

    Groups with so many rows that there are HOT at most are joined by broadcast, so that no task gets all rows of one;
    the others are joined by shuffle, or broadcast too where there are few.
    """
    total, count = groups.agg(F.coalesce(F.sum(copies), F.lit(0)), F.count("*")).first()
    hot = groups.where(F.col(copies) * HOT > total)
    if count <= HOT:
        return rows.join(F.broadcast(groups), keys)
    often = rows.join(F.broadcast(hot), keys)
    seldom = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(groups.where(F.col(copies) * HOT <= total), keys)
    return often.unionByName(seldom)
