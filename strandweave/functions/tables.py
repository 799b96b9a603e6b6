"""Table functions: one value in, rows out, for lateral joins."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

_OPS = re.compile(r"(\d+)|([A-Za-z*-])([A-Za-z*-])")
_VERSION, _HEAD, _MARKS = re.compile(r"\.\d+$"), re.compile(r"^(?:>?Feature\s+)?(?:[^|]*\|)?([^|\s]+)\|?"), re.compile(r"[<>^]")


@udtf(returnType="idx int, kind string, n int, query_base string, subject_base string, q int, s int")
class btop_rows:  # noqa: N801
    """Runs and edits of a BTOP: `match` with its length, `exchange`, `insert` (the subject lacks the base), `delete`; q and s
    are the bases of the query and of the subject before it."""

    def eval(self, btop: str) -> Iterator[tuple]:
        q = s = 0
        for idx, (run, a, b) in enumerate(_OPS.findall(btop or "")):
            if run:
                yield idx, "match", int(run), None, None, q, s
                q, s = q + int(run), s + int(run)
            else:
                yield idx, "insert" if b == "-" else "delete" if a == "-" else "exchange", 1, a, b, q, s
                q, s = q + (a != "-"), s + (b != "-")


def _number(text: str) -> int | None:
    text = _MARKS.sub("", text).strip()
    return int(text) if re.fullmatch(r"[+-]?\d+", text) else None


@udtf(returnType="acc string, start int, end int, typ string, key string, value string")
class feature_rows:  # noqa: N801
    """Rows of one accession's feature table: its header's name in the first line, then features and their annotations.

    A feature's parts and annotations are held until the next one begins.
    """

    def eval(self, record: str) -> Iterator[tuple]:
        head, _, body = (record or "").partition("\n")
        found = _HEAD.match(head)
        if not found:
            return
        acc = _VERSION.sub("", found[1])
        typ, parts, notes = None, [], []

        def rows() -> Iterator[tuple]:
            for a, b in parts:
                lo, hi = min(a, b), max(a, b)
                for key, value in notes or [(None, None)]:
                    yield acc, lo, hi, typ, key, value
                if a > b:
                    yield acc, lo, hi, typ, "_reversed", ""

        for line in body.split("\n"):
            f = [*line.rstrip("\r").split("\t"), "", "", "", "", ""]
            a, b = _number(f[0]), _number(f[1])
            if a is not None and f[2]:
                yield from rows()
                typ, parts, notes = f[2], [], []
            if a is not None and b is not None:
                parts.append((a, b))
            if f[3]:
                notes.append((f[3], f[4]))
        yield from rows()


def with_btop_rows(df: DataFrame, btop: str = "btop") -> DataFrame:
    """df with a row for each run and edit of its BTOP (SEQ-05)."""
    return df.lateralJoin(btop_rows(F.col(btop).outer()))


def features_of_records(records: DataFrame, record: str = "value") -> DataFrame:
    """Rows of feature tables from a row for each accession (SRC-20)."""
    own = records.select(F.col(record).alias("_record"))
    return own.lateralJoin(feature_rows(F.col("_record").outer())).drop("_record")


def register(spark: SparkSession) -> None:
    """Makes the table functions known to SQL: `SELECT ... FROM t, LATERAL btop_rows(t.btop)`."""
    spark.udtf.register("btop_rows", btop_rows)
    spark.udtf.register("feature_rows", feature_rows)
