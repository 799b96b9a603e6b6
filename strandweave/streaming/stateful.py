"""Operators that carry state from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def islands(hits: DataFrame, keys: Sequence[str] = ("sample", "qacc"), value: str = "sacc", order: str = "ord", name: str = "island", buckets: int = 2048) -> DataFrame:
    """hits with the number of its run of consecutive equal values, from 1, over a stream (WIN-01); a null begins a run, as in a batch.

    A key's rows come in order from batch to batch; within a batch they are sorted. Keys are dealt by hash to buckets, and a call of
    the function numbers a whole bucket, so calls don't grow with the number of keys. State of a bucket are its keys' last values and the
    numbers of their runs.
    """
    kinds = {f.name: f.dataType for f in hits.schema}
    longs = [c for c, t in kinds.items() if isinstance(t, T.LongType)]  # pandas would turn them into doubles where there are nulls
    key = F.to_json(F.struct(*keys), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("_key")
    whole = [F.coalesce(c, F.lit(0).cast("long")).alias(c) if c in longs else F.col(c) for c in hits.columns]
    rows = hits.select(*whole, *[F.col(c).isNull().alias(f"_no_{c}") for c in longs], F.col(value).isNull().alias("_none"), key, F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"))
    out = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])
    state_type = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("lasts", T.ArrayType(kinds[value])), T.StructField("runs", T.ArrayType(T.LongType()))])

    def number(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(frames), ignore_index=True).sort_values(["_key", order], kind="stable", ignore_index=True)
        known = {k: (x, run) for k, x, run in zip(*state.get)} if state.exists else {}
        key, x, none = own["_key"].to_numpy(), own[value].to_numpy(), own["_none"].to_numpy(dtype=bool)
        head = np.concatenate([[True], key[1:] != key[:-1]])
        new = head | none | np.concatenate([[True], x[1:] != x[:-1]]) | np.concatenate([[True], none[:-1]])
        first = np.flatnonzero(head)
        last = np.concatenate([first[1:], [len(own)]]) - 1
        before = []
        for at, k, v in zip(first.tolist(), key[first].tolist(), own[value].iloc[first].tolist()):
            seen, run = known.get(k, (None, 0))
            new[at] = none[at] or seen is None or v != seen
            before.append(run)
        count = np.cumsum(new)
        runs = count + np.repeat(np.array(before) - (count - new)[first], last - first + 1)
        known.update(zip(key[last].tolist(), zip([None if n else v for n, v in zip(none[last].tolist(), own[value].iloc[last].tolist())], runs[last].tolist())))
        state.update((list(known), [v for v, _ in known.values()], [run for _, run in known.values()]))
        yield own.assign(**{name: runs})

    numbered = rows.groupBy("_bucket").applyInPandasWithState(number, out, state_type, "append", GroupStateTimeout.NoTimeout)
    return numbered.select(*[F.when(~F.col(f"_no_{c}"), F.col(c)).alias(c) if c in longs else F.col(c) for c in hits.columns], name)


def combined(parts: DataFrame, keys: Sequence[str], ts: str, *, late: str = "1 hour") -> DataFrame:
    """Result rows as they arrive, each key once: repeats within the watermark's delay are dropped, state older than it too."""
    return parts.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
