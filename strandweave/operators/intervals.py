"""Interval algebra on 1-based closed intervals, keyed. Reversed intervals are swapped first.

Covered lengths need one shuffle on the key and a running maximum. Segments (what holds between two neighbouring
breakpoints) are found from the distinct breakpoints of a key and meet the intervals by bins of the intervals' own size for
values; for payloads they are swept out of the intervals, bin by bin.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..scratch import written
from .ordering import TASK_ROWS, before, join_groups


def oriented(start: str, end: str) -> tuple[Column, Column]:
    return F.least(start, end), F.greatest(start, end)


def breakpoints(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Elementary segments `keys, start, end` between neighbouring breakpoints, gaps included."""
    lo, hi = oriented(start, end)
    points = df.select(*keys, F.explode(F.array(lo, hi + 1)).alias("start")).distinct()
    ahead = F.lead("start").over(Window.partitionBy(*keys).orderBy("start"))
    return points.select(*keys, "start", (ahead - 1).alias("end")).where("end is not null")


def _covered(seg: DataFrame, rows: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """seg `keys, start, end, …` joined with rows `keys, _lo, _hi, …` that contain them.

    An interval of 2^(L-1) to 2^L bases lies in two bins of width 2^L at most, and is looked up from a segment by the bin of
    its start, once for each L that occurs with the key. So intervals of any lengths meet only segments near them, and a
    key with a large share of all rows is spread over its bins.
    """
    level = F.ceil(F.log2((F.col("_hi") - F.col("_lo") + 1).cast("double"))).cast("int")
    rows = rows.withColumn("_level", level)
    cut = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_level"))).cast("long")
    binned = rows.withColumn("_bin", F.explode(F.sequence(cut("_lo"), cut("_hi"))))
    levels = rows.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))  # 63 at most
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    more = [c for c in seg.columns if c not in (*keys, "start", "end")]
    probe = seg.join(levels, same(seg, levels), "left").select(*[seg[k] for k in keys], "start", "end", *more, F.explode_outer("_levels").alias("_level"))
    probe = probe.withColumn("_bin", cut("start"))
    over = (F.col("_lo") <= F.col("start")) & (F.col("_hi") >= F.col("end"))
    on = [*same(probe, binned), probe["_level"] == binned["_level"], probe["_bin"] == binned["_bin"], over]
    return probe.join(binned, on, how).select(*[probe[k] for k in keys], "start", "end", *more, *[c for c in rows.columns if c not in (*keys, "_level")])


#: Bins of `_by_bins` are as wide as so many mean intervals; pairs of a row and a segment over it that a task lists at once.
BIN_MEANS, LISTED = 8, 2_000_000


def _by_bins(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int, int]:
    """(rows, width of a bin, number of bins): rows `keys, _gone, _ord, _payload, _lo, _hi` dealt to the bins of `_lo` to `_hi + 1`, a bin's in one
    task one after the other, by `_ord` and `_payload`. Each bin begins with a row of its own, whose `_near` has the last breakpoint of the key
    before the bin and the first behind it.

    All breakpoints of a bin and all rows over the segments that begin in it are there, and those over the segment before them. The table is read once
    and rows go to little more than one bin on average, so about what rows weigh themselves is shuffled, once.
    """
    rows = written(rows.where("_lo is not null"))
    n, mean = rows.agg(F.count("*"), F.avg(F.col("_hi") - F.col("_lo") + 1)).first()
    bits = max(0, int(np.ceil(np.log2(BIN_MEANS * float(mean or 1)))))
    cut = lambda c: F.shiftright(c.cast("long"), bits)
    dealt = rows.withColumn("_bin", F.explode(F.sequence(cut(F.col("_lo")), cut(F.col("_hi") + 1))))
    inside = [F.when(~F.col("_gone") & (cut(c) == F.col("_bin")), c.cast("long")) for c in (F.col("_lo"), F.col("_hi") + 1)]
    bins = written(dealt.groupBy(*keys, "_bin").agg(F.min(F.least(*inside)).alias("_first"), F.max(F.greatest(*inside)).alias("_last")))
    last = lambda c, order: F.last(c, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    heads = bins.select(*keys, "_bin", F.struct(last("_last", F.asc("_bin")).alias("before"), last("_first", F.desc("_bin")).alias("after")).alias("_near"))
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_ROWS))
    both = dealt.unionByName(heads, allowMissingColumns=True).repartition(tasks, *keys, "_bin")
    return both.sortWithinPartitions(*keys, "_bin", F.col("_near").isNull(), "_ord", "_payload"), 1 << bits, bins.count()


def _whole_bins(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        heads = np.flatnonzero(batch.column("_near").is_valid().to_numpy(zero_copy_only=False))
        if n + batch.num_rows >= least and len(heads) and (held or heads[-1]):
            yield pa.Table.from_batches([*held, batch[: heads[-1]]])
            held, n, batch = [], 0, batch[heads[-1] :]
        held.append(batch)
        n += batch.num_rows
    if n:
        yield pa.Table.from_batches(held)


class _Sweep:
    """Segments of some whole bins, in order, and which rows are over them: rows `at` over the segments from `a` up to `b`.

    The first of a bin may be the segment before it (`real` is false there), to compare with.
    """

    def __init__(self, table: pa.Table, wide: int):
        number = lambda c, fill=0: pc.fill_null(c.cast(pa.int64()), fill).to_numpy()
        is_head = pc.is_valid(table["_near"]).to_numpy()
        self.heads = np.flatnonzero(is_head)
        near = table["_near"].take(pa.array(self.heads)).combine_chunks()
        before, after = (pc.struct_field(near, c) for c in ("before", "after"))
        self.open, begun = pc.is_null(after).to_numpy(zero_copy_only=False), pc.is_valid(before).to_numpy(zero_copy_only=False)
        before, after = number(before), number(after)
        base, group = number(table["_bin"].take(pa.array(self.heads))) * wide, np.cumsum(is_head) - 1
        at = np.flatnonzero(~is_head)
        g, lo, end = group[at], number(table["_lo"])[at], number(table["_hi"])[at] + 1
        gone, real = pc.fill_null(table["_gone"], False).to_numpy()[at], pc.is_valid(table["_ord"]).to_numpy()[at]
        # places on one axis for all bins: of a bin first the segment before it, then its positions
        first, lo_in, end_in = g * (wide + 1), lo - base[g], end - base[g]
        points = [(first + 1 + x)[(x >= 0) & (x < wide) & ~gone] for x in (lo_in, end_in)]
        u = np.unique(np.concatenate([*points, np.flatnonzero(begun) * (wide + 1)]))
        self.group = u // (wide + 1)
        self.real = u % (wide + 1) > 0
        self.start = np.where(self.real, base[self.group] + u % (wide + 1) - 1, before[self.group])
        self.last = np.append(self.group[1:] != self.group[:-1], True)[: len(u)]
        self.next = np.where(self.last, after[self.group], np.append(self.start[1:], 0)[: len(u)])
        a = np.searchsorted(u, first + np.where(lo_in < 0, 0, lo_in + 1))
        b = np.where(real, np.searchsorted(u, first + 1 + np.minimum(end_in, wide)), a)
        self.at, self.a, self.b, self.g = at[~gone], a[~gone], b[~gone], g[~gone]
        if gone.any():  # over segments that they hold whole
            g, end, first, lo_in = g[gone], end[gone], first[gone], lo_in[gone]
            self.gone = at[gone]
            self.gone_g = g
            self.gone_a = np.searchsorted(u, first + np.where(begun[g] & (lo[gone] <= before[g]), 0, np.maximum(lo_in, 0) + 1))
            stop = np.searchsorted(u, first + 1 + np.minimum(end_in[gone], wide - 1), side="right")
            through = (stop == np.searchsorted(u, first + wide, side="right")) & ~self.open[g] & (after[g] <= end)
            self.gone_b = np.maximum(stop - 1 + through, self.gone_a)
        else:
            self.gone = np.zeros(0, np.int64)

    def chunks(self, most: int, overlap: int = 0) -> Iterator[tuple[int, int]]:
        """Ranges of segments with up to `most` pairs (one segment at least), each with the `overlap` segments before."""
        n = len(self.start)
        depth = np.cumsum(np.bincount(self.a, minlength=n + 1) - np.bincount(self.b, minlength=n + 1))[:n]
        upto, at = np.cumsum(depth), 0
        while at < n:
            end = min(max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right"))), at + 60_000, n)
            yield max(0, at - overlap), end
            at = end


def _pairs(a: np.ndarray, b: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, segment - low) for each row over a segment from low to high, by row."""
    rows = np.flatnonzero((a < high) & (b > low))
    a, b = np.maximum(a[rows], low), np.minimum(b[rows], high)
    n = b - a
    return np.repeat(rows, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - (a - low), n)


def _listed(rows: np.ndarray, segs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows by segment, in their order; where each segment's begin)."""
    order = np.argsort(segs.astype(np.uint16), kind="stable")  # 60,001 segments at most
    return rows[order], np.append(0, np.cumsum(np.bincount(segs, minlength=n)))


def _out(table: pa.Table, keys: Sequence[str], heads: np.ndarray, columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """columns, and the keys of the bins that begin at heads."""
    found = {k: table[k].take(pa.array(heads)).combine_chunks() for k in keys} | columns
    return pa.RecordBatch.from_arrays([found[f.name].cast(f.type) for f in schema], schema=schema)


def _interval_rows(df: DataFrame, keys: Sequence[str], start: str, end: str, payload: str, order: str | None) -> DataFrame:
    lo, hi = oriented(start, end)
    return df.select(*keys, F.lit(order is None).alias("_gone"), *([F.col(order).alias("_ord")] if order else []), F.col(payload).alias("_payload"), lo.alias("_lo"), hi.alias("_hi"))


def _types(rows: DataFrame, keys: Sequence[str], *more: str) -> T.StructType:
    place = rows.select((F.col("_hi") + 1).alias("p")).schema["p"].dataType
    kinds = {"start": place, "end": place, "payload": T.ArrayType(rows.schema["_payload"].dataType), "_bin": T.LongType()}
    return T.StructType([*[rows.schema[k] for k in keys], *[T.StructField(c, kinds[c]) for c in more]])


def segments(df: DataFrame, keys: Sequence[str], start: str, end: str, payload: str, order: str) -> DataFrame:
    """`keys, start, end, payload`: elementary segments with the payloads over them in insertion order, empty in gaps (REG-01, REG-04).

    Each bin of positions is swept by itself; payloads go from there to the result and are neither shuffled nor written.
    """
    keys = list(keys)
    rows = _interval_rows(df, keys, start, end, payload, order)
    (dealt, wide, _), most = _by_bins(rows, keys), LISTED
    types = _types(rows, keys, "start", "end", "payload")
    schema = to_arrow_schema(types)

    def list_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_bins(batches):
            s, values = _Sweep(table, wide), table["_payload"].combine_chunks()
            for low, high in s.chunks(most):
                rows, begin = _listed(*_pairs(s.a, s.b, low, high), high - low)
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), values.take(pa.array(s.at[rows])))
                own = np.flatnonzero(s.real[low:high] & ~(s.last & s.open[s.group])[low:high])
                segs = low + own
                yield _out(table, keys, s.heads[s.group[segs]], {"start": pa.array(s.start[segs]), "end": pa.array(s.next[segs] - 1), "payload": lists.take(pa.array(own))}, schema)

    return dealt.mapInArrow(list_rows, types)


def at_point(segs: DataFrame, position: Column | int) -> DataFrame:
    """The segment over a position (REG-03)."""
    return segs.where((F.col("start") <= position) & (F.col("end") >= position))


def last_start(points: DataFrame, segs: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """points with the other columns of the last segment of their key that starts at or before the position, null if none.

    Points and segments are put in one order of key and position, and each point takes the last segment before it: no
    join, so it doesn't matter how many of either a key has. Columns of segs that points have too are taken from points.
    """
    more = [c for c in segs.columns if c not in keys and c not in points.columns]
    own = [c for c in points.columns if c not in keys]
    point, seg = F.struct(*own).alias("_point"), F.struct(*more).alias("_seg")
    kinds = {c: x.select(s).schema[c].dataType for x, s, c in ((points, point, "_point"), (segs, seg, "_seg"))}
    both = segs.select(*keys, F.col("start").cast("double").alias("_pos"), F.lit(0).alias("_kind"), F.lit(None).cast(kinds["_point"]).alias("_point"), seg)
    both = both.unionByName(points.select(*keys, F.col(position).cast("double").alias("_pos"), F.lit(1).alias("_kind"), point, F.lit(None).cast(kinds["_seg"]).alias("_seg")))
    found = before(both, list(keys), ["_pos", "_kind"], lasts={"_last": "_seg"}).where("_kind = 1")
    return found.select(*keys, *[F.col(f"_point.{c}").alias(c) for c in own], *[F.when(F.col("_pos").isNotNull(), F.col(f"_last.{c}")).alias(c) for c in more])


def at_points(points: DataFrame, segs: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """points with the segment over each, null where there is none (REG-03). Segments of a key don't overlap."""
    more = [c for c in segs.columns if c not in keys and c not in points.columns]
    out = last_start(points, segs, keys, position)
    inside = F.col("end") >= F.col(position)
    return out.select(*points.columns, *[F.when(inside, F.col(c)).alias(c) for c in more])


def runs(segs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """`keys, start, end, value`: neighbouring segments of equal value in one, by run detection over the order of keys and starts.

    Segments that don't touch aren't neighbours.
    """
    seen = before(segs.select(*keys, "start", "end", value), list(keys), ["start"], lasts={"_prev": value, "_end": "end"})
    new = F.when((F.col("_end") + 1 == F.col("start")) & F.col("_prev").eqNullSafe(F.col(value)), 0).otherwise(1)
    marked = before(seen.withColumn("_new", new), list(keys), ["start"], sums={"_runs": "_new"}).withColumn("_run", F.col("_runs") + F.col("_new"))
    return marked.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(value, "start").alias(value)).drop("_run")


def _beside(segs: DataFrame, rows: DataFrame, keys: Sequence[str], entry: Sequence[str]) -> DataFrame:
    """segs `keys, start, end, …` with `_near`: the rows `keys, _lo, _hi, …` that touch the bin of the segment's start, as a sorted
    array of structs of entry, `_lo` and `_hi`; null if there are none. All rows over a segment are among them.

    Bins are as wide as the mean interval, rounded up to a power of two, so rows are dealt to under three bins on average,
    and it is rows that are shuffled, not their pairs with segments. A bin's rows are held by one task, next to those of one of its segments.
    """
    wide = F.broadcast(rows.agg(F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.avg(F.col("_hi") - F.col("_lo") + 1), F.lit(1.0))))).alias("_wide")))
    cut = lambda c: F.floor(F.col(c) / F.col("_wide")).cast("long")
    key = F.struct(*keys, "_bin").alias("_key")  # equal where keys are null too
    dealt = rows.crossJoin(wide).withColumn("_bin", F.explode(F.sequence(cut("_lo"), cut("_hi"))))
    near = dealt.select(key, F.struct(*entry, "_lo", "_hi").alias("_e")).groupBy("_key").agg(F.array_sort(F.collect_list("_e")).alias("_near"))
    return segs.crossJoin(wide).withColumn("_bin", cut("start")).select(*segs.columns, key).join(near, "_key", "left").select(*segs.columns, "_near")


def _held(entry: str) -> Column:
    """One field of those in `_near` that are over the segment."""
    return F.transform(F.filter("_near", lambda x: (x["_lo"] <= F.col("start")) & (x["_hi"] >= F.col("end"))), lambda x: x[entry])


def without_payloads(segs: DataFrame, removed: DataFrame, keys: Sequence[str], start: str, end: str, payload: str) -> DataFrame:
    """Segments (as of `segments`) after entries were removed: one equal entry of each segment under a removed interval goes,
    equal neighbours are merged, and nothing empty is left at a key's ends (REG-02).

    Where the intervals are at hand, `segments_without` gives the same without moving payloads. Removed intervals are such as were added, so they begin and end with segments.
    """
    lo, hi = oriented(start, end)
    gone = removed.select(*keys, lo.alias("_lo"), hi.alias("_hi"), F.col(payload).alias("_payload")).where("_payload is not null")

    @F.udf(segs.schema["payload"].dataType)
    def less(entries, gone):
        times, left = Counter(gone or ()), []
        for x in entries:
            if times[x] > 0:
                times[x] -= 1
            else:
                left.append(x)
        return left

    near = _beside(segs.select(*keys, "start", "end", "payload"), gone, keys, ["_payload"])
    kept = less("payload", _held("_payload"))
    left = written(near.select(*keys, "start", "end", kept.alias("payload")))
    # neighbours are compared by digests, so that payloads are moved only once more, to their runs
    digest = F.when(F.size("payload") > 0, F.sha2(F.to_json(F.struct("payload")), 256)).otherwise("").alias("_digest")
    own = runs(left.select(*keys, "start", "end", digest), keys, "_digest").select(F.struct(*keys, "start").alias("_key"), F.col("end").alias("_to"), F.col("_digest"))
    whole = left.select(F.struct(*keys, "start").alias("_key"), "payload").join(own, "_key").select(*[F.col(f"_key.{k}").alias(k) for k in keys], F.col("_key.start").alias("start"), F.col("_to").alias("end"), "payload")
    ends = own.where("_digest <> ''").select(*[F.col(f"_key.{k}").alias(k) for k in keys], F.col("_key.start").alias("start"), F.col("_to").alias("end"))
    ends = ends.groupBy(*keys).agg(F.min("start").alias("_first"), F.max("end").alias("_last"), F.count("*").alias("_n"))
    return join_groups(whole, ends, list(keys), "_n").where("start >= _first and end <= _last").drop("_first", "_last", "_n")


class _Removal:
    """What is left over the segments of a sweep: of equal payloads over one, as many of the first as removed intervals hold it."""

    def __init__(self, table: pa.Table, sweep: _Sweep, most: int):
        coded = table["_payload"].combine_chunks().dictionary_encode()
        self.codes, self.s, self.most = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64), sweep, most
        s, n = sweep, len(coded.dictionary) + 1
        named = self.codes[s.gone] >= 0  # a null is no entry's equal
        s.gone, s.gone_a, s.gone_b, s.gone_g = s.gone[named], s.gone_a[named], s.gone_b[named], s.gone_g[named]
        # where all rows and removed intervals of one payload are over the same segments, whole rows go
        kinds, kind = np.unique(np.concatenate([s.g * n + self.codes[s.at], s.gone_g * n + self.codes[s.gone]]), return_inverse=True)
        self.kind, gone_kind = kind[: len(s.at)], kind[len(s.at) :]
        gone = np.bincount(gone_kind, minlength=len(kinds))
        alike = np.ones(len(kinds), bool)
        for own in (np.concatenate([s.a, s.gone_a]), np.concatenate([s.b, s.gone_b])):
            some = np.zeros(len(kinds), np.int64)
            some[kind] = own
            alike[kind[own != some[kind]]] = False
        order = np.argsort(self.kind, kind="stable")
        begin = np.searchsorted(self.kind[order], np.arange(len(kinds)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - begin[self.kind[order]]
        s.b = np.where(alike[self.kind] & (rank < gone[self.kind]), s.a, s.b)
        # the rest is judged for each segment
        self.mixed = ~alike & (gone > 0)
        left = self.mixed[gone_kind]
        self.gone_kind, self.gone_a, self.gone_b = gone_kind[left], s.gone_a[left], s.gone_b[left]

    def lists(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows by segment, where each segment's begin, whether a segment's payloads differ from those of the one before it)."""
        s, n = self.s, high - low
        rows, segs = _pairs(s.a, s.b, low, high)
        theirs, at = _pairs(self.gone_a, self.gone_b, low, high)
        if len(theirs):
            gone, times = np.unique(self.gone_kind[theirs] * n + at, return_counts=True)
            judged = np.flatnonzero(self.mixed[self.kind[rows]])
            own = self.kind[rows[judged]] * n + segs[judged]
            order = np.argsort(own, kind="stable")  # rows of one segment and payload stay in their order
            own = own[order]
            place = np.minimum(np.searchsorted(gone, own), len(gone) - 1)
            stays = np.ones(len(rows), bool)
            stays[judged[order]] = np.arange(len(own)) - np.searchsorted(own, own) >= np.where(gone[place] == own, times[place], 0)
            rows, segs = rows[stays], segs[stays]
        rows, begin = _listed(rows, segs, n)
        size, codes = np.diff(begin), self.codes[s.at[rows]]
        first = np.append(True, s.group[low + 1 : high] != s.group[low : high - 1])
        new = np.where(first, size > 0, np.append(True, size[1:] != size[:-1]))
        seg = np.repeat(np.arange(n), size)
        at = np.flatnonzero(~(first | new)[seg])  # entries of segments with as many as the one before
        new[seg[at[codes[at] != codes[at - size[seg[at]]]]]] = True
        return rows, begin, new

    def runs(self, first_only: bool = False) -> np.ndarray:
        """Segments with which a run begins; with first_only the first of a bin at least. A key's first run isn't empty."""
        s = self.s
        found, pending = np.zeros(len(s.start), bool), np.ones(len(s.heads), bool)
        own = s.real & ~(s.last & s.open[s.group])
        for low, high in s.chunks(self.most // 10 if first_only else self.most, overlap=1):
            at = low + (low > 0)  # what is before is the last of the chunk before
            if pending[s.group[at:high]].any():
                found[at:high] = self.lists(low, high)[2][at - low :] & own[at:high]
                pending[s.group[at:high][found[at:high]]] = not first_only
        return np.flatnonzero(found)


#: Bins whose ends `segments_without` broadcasts, at most.
END_ROWS = 100_000


def segments_without(df: DataFrame, removed: DataFrame, keys: Sequence[str], start: str, end: str, payload: str, order: str) -> DataFrame:
    """`without_payloads` of `segments`, by sweeps over the intervals and the removed ones, so that payloads are neither shuffled nor written.

    A segment begins a run if its payloads differ from those over the segment before it, which its bin has too. A bin's last run ends where the
    next one of its key begins, in another bin: that is found by a sweep that stops at each bin's first run.
    """
    keys = list(keys)
    rows = _interval_rows(df, keys, start, end, payload, order).unionByName(_interval_rows(removed, keys, start, end, payload, None), allowMissingColumns=True)
    (dealt, wide, bins), most = _by_bins(rows, keys), LISTED
    types = _types(rows, keys, "_bin", "start", "end", "payload")
    schema = to_arrow_schema(types)
    edge_types = T.StructType([*[rows.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in ("_bin", "_first", "_stop")]])
    edge_schema = to_arrow_schema(edge_types)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each bin the start of its first run, and the key's last breakpoint, if they are there."""
        for table in _whole_bins(batches):
            s = _Sweep(table, wide)
            begun, stop = _Removal(table, s, most).runs(first_only=True), np.flatnonzero(s.real & s.last & s.open[s.group])
            at = np.full((2, len(s.heads)), -1)
            at[0, s.group[begun[::-1]]] = begun[::-1]  # the first of a bin comes last
            at[1, s.group[stop]] = stop
            own = np.flatnonzero((at >= 0).any(axis=0))
            if len(own):
                places = {c: pa.array(s.start[np.maximum(x, 0)], mask=x < 0) for c, x in zip(("_first", "_stop"), at[:, own])}
                yield _out(table, (*keys, "_bin"), s.heads[own], places, edge_schema)

    def list_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_bins(batches):
            s, values = _Sweep(table, wide), table["_payload"].combine_chunks()
            left = _Removal(table, s, most)
            begun = left.runs()
            ends = pa.array(np.append(s.start[begun[1:]], 0)[: len(begun)] - 1, mask=np.append(s.group[begun[1:]] != s.group[begun[:-1]], True)[: len(begun)])
            for low, high in s.chunks(most):
                i, j = np.searchsorted(begun, (low, high))
                if i < j:
                    rows, begin, _ = left.lists(low, high)
                    lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), values.take(pa.array(s.at[rows])))
                    yield _out(table, (*keys, "_bin"), s.heads[s.group[begun[i:j]]], {"start": pa.array(s.start[begun[i:j]]), "end": ends[i:j], "payload": lists.take(pa.array(begun[i:j] - low))}, schema)

    runs, names = dealt.mapInArrow(list_runs, types), [*keys, "_bin"]
    later = Window.partitionBy(*keys).orderBy(F.desc("_bin"))
    following = F.last("_first", ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1))
    ends = dealt.mapInArrow(edges, edge_types).select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(names)], following.alias("_following"), F.max("_stop").over(Window.partitionBy(*keys)).alias("_end"))

    def closed(open_runs: DataFrame, ends: DataFrame) -> DataFrame:
        found = open_runs.join(ends, [open_runs[k].eqNullSafe(F.col(f"_e{i}")) for i, k in enumerate(names)])
        kept = found.where("`end` is not null or _following is not null or size(payload) > 0")  # nothing empty at a key's end
        return kept.select(*keys, "start", F.coalesce("end", (F.coalesce("_following", "_end") - 1).cast(types["end"].dataType)).alias("end"), "payload")

    if bins <= END_ROWS:
        return closed(runs, F.broadcast(ends))
    return runs.where("`end` is not null").select(*keys, "start", "end", "payload").unionByName(closed(runs.where("`end` is null"), ends))


def merged(df: DataFrame, keys: Sequence[str], start: str, end: str, min_gap: int = 1) -> DataFrame:
    """`keys, start, end, n`: unions of intervals whose gap is under min_gap bases; 1 merges adjacent ones (REG-06)."""
    lo, hi = oriented(start, end)
    rows = df.select(*keys, lo.alias("_lo"), hi.alias("_hi"))
    order = Window.partitionBy(*keys).orderBy("_lo", "_hi")
    reach = F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("_lo") - reach - 1 >= min_gap), 1).otherwise(0)
    rows = rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min("_lo").alias("start"), F.max("_hi").alias("end"), F.count("*").alias("n")).drop("_island")


def beyond(keys: Sequence[str]) -> Column:
    """Bases of the interval `_lo, _hi` beyond the running maximum end of its key."""
    reach = F.max("_hi").over(Window.partitionBy(*keys).orderBy("_lo", "_hi").rowsBetween(Window.unboundedPreceding, -1))
    return F.greatest(F.lit(0), F.col("_hi") - F.greatest(F.col("_lo"), F.coalesce(reach + 1, F.col("_lo"))) + 1)


def union_length(df: DataFrame, keys: Sequence[str], start: str, end: str, name: str = "length") -> DataFrame:
    """Covered bases of each key, overlaps counted once: each interval adds what lies beyond the running maximum end."""
    lo, hi = oriented(start, end)
    rows = df.select(*keys, lo.alias("_lo"), hi.alias("_hi"))
    return rows.select(*keys, beyond(keys).alias("_added")).groupBy(*keys).agg(F.sum("_added").cast("long").alias(name))


def segment_values(df: DataFrame, keys: Sequence[str], start: str, end: str, value: str, how: str = "max") -> DataFrame:
    """`keys, start, end, value`: max or avg of the values over each covered segment."""
    lo, hi = oriented(start, end)
    rows = df.select(*keys, lo.alias("_lo"), hi.alias("_hi"), F.col(value).alias("_v"))
    joined = _covered(breakpoints(df, keys, start, end), rows, keys, "inner")
    agg = F.max("_v") if how == "max" else F.avg("_v")
    return joined.groupBy(*keys, "start", "end").agg(agg.alias("value"))


def weighted_over_segments(df: DataFrame, keys: Sequence[str], start: str, end: str, value: str, *, how: str = "max", digits: int = 1, name: str = "value") -> DataFrame:
    """Length-weighted mean over covered segments of a segment's max (identity, AGG-07) or mean (quality, AGG-11)."""
    seg = segment_values(df, keys, start, end, value, how).withColumn("_n", F.col("end") - F.col("start") + 1)
    return seg.groupBy(*keys).agg(F.round(F.sum(F.col("_n") * F.col("value")) / F.sum("_n"), digits).alias(name))


def weighted_over_segments_of(df: DataFrame, keys: Sequence[str], start: str, end: str, values: dict[str, str], digits: dict[str, int]) -> DataFrame:
    """Means as of `weighted_over_segments` for several columns at once, given as {column: max or avg}; null where a column has no value.

    The segments are those of all intervals. Those of a column's own intervals are unions of them, over which the same values hold.
    """
    lo, hi = oriented(start, end)
    rows = df.select(*keys, lo.alias("_lo"), hi.alias("_hi"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)])
    joined = _covered(breakpoints(df, keys, start, end), rows, keys, "inner")
    seg = joined.groupBy(*keys, "start", "end").agg(*[(F.max if how == "max" else F.avg)(f"_v{i}").alias(f"_v{i}") for i, how in enumerate(values.values())])
    seg = seg.withColumn("_n", F.col("end") - F.col("start") + 1)
    own = [F.round(F.sum(F.col("_n") * F.col(f"_v{i}")) / F.sum(F.when(F.col(f"_v{i}").isNotNull(), F.col("_n"))), digits[c]).alias(c) for i, c in enumerate(values)]
    return seg.groupBy(*keys).agg(*own)


#: Rows of b that `overlap_join` broadcasts, at most; and slices of a key's rows beyond that, at most, so that copies of b stay in proportion.
HELD_ROWS, SLICES = 2_000_000, 8


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], *, a_cols=("start", "end"), b_cols=("start", "end"), bin_width: int | None = None) -> DataFrame:
    """Pairs of overlapping intervals of one key, with the clipped overlap (JOI-15, REG-10).

    With bin_width both sides are dealt into bins of that width, and a pair is kept in the bin of its overlap's start,
    so a key with a large share of all rows is split over tasks. Up to HELD_ROWS rows of b are broadcast, and a is not
    shuffled. Beyond that both sides are shuffled; where keys and bins are fewer than four for each of the session's tasks, the rows of a
    in each are dealt over slices and those of b are copied to them.
    """
    a = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in a.columns if c not in keys])
    b = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in keys])
    (s1, e1), (s2, e2) = [f"a_{c}" for c in a_cols], [f"b_{c}" for c in b_cols]
    on = list(keys)
    if bin_width:
        cut = lambda c: F.floor(F.col(c) / bin_width).cast("long")
        a = a.withColumn("_bin", F.explode(F.sequence(cut(s1), cut(e1))))
        b = b.withColumn("_bin", F.explode(F.sequence(cut(s2), cut(e2))))
        on.append("_bin")
    if b.count() <= HELD_ROWS:
        b = F.broadcast(b)
    else:
        wanted = 4 * int(b.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = min(SLICES, -(-wanted // max(1, b.select(*on).distinct().count())))
        hashed = [c for c, kind in a.dtypes if "map<" not in kind and "variant" not in kind]
        a = a.withColumn("_slice", F.pmod(F.xxhash64(*hashed), F.lit(slices)))
        b = b.withColumn("_slice", F.explode(F.array(*[F.lit(i).cast("long") for i in range(slices)]))).hint("merge")  # Spark's own guess of its size is far too low
        on.append("_slice")
    out = a.join(b, on).where((F.col(s1) <= F.col(e2)) & (F.col(s2) <= F.col(e1))).drop("_slice")
    out = out.withColumn("start", F.greatest(s1, s2)).withColumn("end", F.least(e1, e2))
    return out.where(F.col("_bin") == F.floor(F.col("start") / bin_width)).drop("_bin") if bin_width else out


def disjoint_parts(exons: DataFrame, keys: Sequence[str], gene: str) -> DataFrame:
    """Elementary exonic parts that belong to exactly one gene (REG-12)."""
    parts = segments(exons.withColumn("_ord", F.lit(0)), keys, "start", "end", gene, "_ord")
    return parts.withColumn("genes", F.array_distinct("payload")).where("size(genes) = 1").select(*keys, "start", "end", F.get("genes", 0).alias(gene))


def count_fragments(reads: DataFrame, parts: DataFrame, keys: Sequence[str], part: Sequence[str], *, stranded: str = "inverted", bin_width: int = 1000) -> DataFrame:
    """Distinct fragments over each part; `inverted` reads the library's strand backwards (JOI-22).

    Reads are not paired with parts. Of a fragment's islands (unions of its reads) those over a part are consecutive, so the fragments
    over it are the islands that begin up to its end, less those that end before it, less the gaps between two islands of
    a fragment that lie inside it. The first two are running sums over positions; gaps are counted by their ends and meet the parts around them.
    Parts of several intervals are joined with the reads in bins of positions.
    """
    flip = F.when(F.col("strand") == "+", "-").when(F.col("strand") == "-", "+").otherwise(F.col("strand"))
    reads = reads.withColumn("strand", flip) if stranded == "inverted" and "strand" in reads.columns else reads
    own = list(dict.fromkeys([*keys, *part]))
    named = list(dict.fromkeys([*own, "start", "end"]))
    spans = parts.select(*named).dropna(subset=[*keys, "start", "end"]).distinct()
    sizes = spans.groupBy(*own).agg(F.count("*").alias("_n"), F.min("start").alias("_lo"), F.max("end").alias("_hi"))
    one = sizes.where("_n = 1").drop("_n")
    shapes = one.select(*keys, "_lo", "_hi").distinct()

    islands = merged(reads.dropna(subset=[*keys, "fragment", "start", "end"]), [*keys, "fragment"], "start", "end")
    ahead = F.lead("start").over(Window.partitionBy(*keys, "fragment").orderBy("start"))
    islands = islands.select(*keys, "start", "end", ahead.alias("_next"))
    zero, none = F.lit(0).cast("long"), [F.lit(None).cast(shapes.schema[c].dataType).alias(c) for c in ("_lo", "_hi")]
    event = lambda c, kind: islands.groupBy(*keys, F.col(c).cast("double").alias("_pos")).agg(F.count("*").alias("_w")).select(*keys, "_pos", F.lit(kind).alias("_kind"), *(("_w", zero.alias("_v")) if kind == 0 else (zero.alias("_w"), F.col("_w").alias("_v"))), *none, F.lit(None).cast("int").alias("_side"))
    asked = shapes.select(*keys, "_lo", "_hi", F.explode(F.array(F.struct(F.col("_hi").cast("double").alias("p"), F.lit(1).alias("s")), F.struct(F.col("_lo").cast("double").alias("p"), F.lit(-1).alias("s")))).alias("_a"))
    asked = asked.select(*keys, F.col("_a.p").alias("_pos"), F.lit(1).alias("_kind"), zero.alias("_w"), zero.alias("_v"), "_lo", "_hi", F.col("_a.s").alias("_side"))
    seen = before(event("start", 0).unionByName(event("end", 2)).unionByName(asked), list(keys), ["_pos", "_kind"], sums={"_begun": "_w", "_ended": "_v"}).where("_kind = 1")
    met = seen.groupBy(*keys, "_lo", "_hi").agg(F.sum(F.when(F.col("_side") == 1, F.col("_begun")).otherwise(-F.col("_ended"))).alias("_met"))

    longest = F.broadcast(shapes.agg(F.max(F.col("_hi") - F.col("_lo")).alias("_longest")))
    gaps = islands.where("_next is not null").crossJoin(longest).where(F.col("_next") - F.col("end") <= F.col("_longest"))
    gaps = gaps.groupBy(*keys, F.col("end").alias("start"), F.col("_next").alias("end")).agg(F.count("*").alias("_w"))
    twice = _covered(gaps, shapes, keys, "inner").groupBy(*keys, "_lo", "_hi").agg(F.sum("_w").alias("_twice"))
    found = one.join(met, [*keys, "_lo", "_hi"]).join(twice, [*keys, "_lo", "_hi"], "left")
    out = found.select(*own, (F.col("_met") - F.coalesce("_twice", F.lit(0))).alias("n")).where("n > 0")
    several = sizes.where("_n > 1")
    if several.isEmpty():
        return out
    same = [spans[c].eqNullSafe(several[c]) for c in own]
    pairs = overlap_join(reads, spans.join(several, same, "left_semi"), keys, bin_width=bin_width)
    more = [c for c in own if c not in keys]
    return out.unionByName(pairs.groupBy(*keys, *[F.col(f"b_{c}").alias(c) for c in more]).agg(F.countDistinct("a_fragment").alias("n")).where("n > 0"))


def islands_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with `_island`: intervals of a key that touch no position in common with any before begin a new one."""
    seen = before(df, list(keys), list(order), highs={"_reach": "end"})
    seen = seen.withColumn("_new", F.when(F.col("_reach").isNull() | (F.col("_reach") < F.col("start")), 1).otherwise(0))
    return before(seen, list(keys), list(order), sums={"_islands": "_new"}).withColumn("_island", F.col("_islands") + F.col("_new")).drop("_reach", "_new", "_islands")


def pack_lanes(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("start", "end")) -> DataFrame:
    """The first free lane, from 1, for each interval in order, so that those of one lane don't overlap (REG-08).

    Where nothing covers a position all lanes are free, so intervals between two such positions are packed by themselves.
    They are streamed in order; what is held are the ends of the lanes in use.
    """
    cut = islands_of(df, keys, order)
    schema = T.StructType([*df.schema.fields, T.StructField("lane", T.IntegerType())])
    names = [*keys, "_island"]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, busy, free, used = None, [], [], 0
        for pdf in frames:
            lanes = []
            for row in zip(*[pdf[c] for c in names], pdf["start"], pdf["end"]):
                if row[:-2] != own:
                    own, busy, free, used = row[:-2], [], [], 0
                while busy and busy[0][0] < row[-2]:
                    heappush(free, heappop(busy)[1])
                if free:
                    lane = heappop(free)
                else:
                    lane = used = used + 1
                heappush(busy, (row[-1], lane))
                lanes.append(lane)
            yield pdf.drop(columns="_island").assign(lane=lanes)

    return cut.repartition(*names).sortWithinPartitions(*names, *order).mapInPandas(pack, schema)


def spread(df: DataFrame, keys: Sequence[str], spacing: int = 0, rounds: int = 100) -> DataFrame:
    """Moves intervals that overlap or are closer than spacing apart (REG-07): each cluster is laid out side by side around its
    centre, again while clusters meet, rounds at most. Groups are one plot's contigs."""
    half = spacing // 2

    def move(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"], kind="stable").reset_index(drop=True)
        start, width = pdf["start"].to_numpy(dtype=np.int64) - half, (pdf["end"] - pdf["start"] + 1).to_numpy(dtype=np.int64) + 2 * half
        for _ in range(rounds):
            order = np.argsort(start, kind="stable")
            s, reach = start[order], np.maximum.accumulate((start + width)[order])  # one past the last end so far
            if not (s[1:] < reach[:-1]).any():
                break
            new = np.concatenate([[True], s[1:] > reach[:-1]])  # clusters, touching ones included
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            w = width[order]
            laid = np.cumsum(w) - w
            offset = laid - laid[first]
            total, merged_width = np.bincount(np.cumsum(new) - 1, w), reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])] - s[new]
            left = ((total - merged_width + 1) / 2)[np.cumsum(new) - 1]
            start[order] = s + np.trunc(s[first] + offset - s - left).astype(np.int64)
        start = start + half
        return pdf.assign(start=start, end=start + width - 2 * half - 1)

    return df.groupBy(*keys).applyInPandas(move, df.schema)


def compressed_axis(blocks: DataFrame, keys: Sequence[str], gap: int, merge_gap: int = 1) -> DataFrame:
    """Blocks, merged where less than merge_gap bases lie between, with their place on an axis where every gap is drawn `gap` wide (REG-09, WIN-10)."""
    b = merged(blocks, keys, "start", "end", merge_gap).withColumn("_wide", F.col("end") - F.col("start") + 1 + gap)
    earlier = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # blocks of a key stand in one task since they were merged
    return b.select(*keys, "start", "end", (F.coalesce(F.sum("_wide").over(earlier), F.lit(0)) + 1 - F.col("start")).alias("offset"))


def to_axis(points: DataFrame, axis: DataFrame, keys: Sequence[str], position: str, back: bool = False) -> DataFrame:
    """points with `mapped`: positions on the compressed axis, or back from it (REG-09).

    A block is shifted, a gap is stretched between the ends of the blocks around it, what lies before the first or after the last block is
    shifted with it. Null positions, and those of keys without blocks, are null.

    Blocks and points are shuffled by key once and meet in windows; keys of over KEY_ROWS rows in one range-partitioned order.
    """
    keys = list(keys)
    both = points.select(*keys).unionByName(axis.select(*keys))
    hot = written(both.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > KEY_ROWS).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    if hot.isEmpty():
        return _axis_windows(points, axis, keys, position, back)
    on = lambda a: [a[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    often, rest = [[df.join(F.broadcast(hot), on(df), how) for df in (points, axis)] for how in ("left_semi", "left_anti")]
    return _axis_windows(*rest, keys, position, back).unionByName(_axis_ranges(*often, keys, position, back))


#: Rows of a key that one task takes in `to_axis`.
KEY_ROWS = 1_000_000


def _mapped(x: Column) -> Column:
    """The place of x by the anchor at or before it, `_from` to `_to`, and the one after it."""
    stretched = F.col("_to") + (x - F.col("_from")) * (F.col("_after.t") - F.col("_to")) / F.nullif(F.col("_after.f") - F.col("_from"), F.lit(0.0))
    return F.when(F.col("_to").isNull(), F.col("_after.t") + (x - F.col("_after.f"))).when(F.col("_after").isNull(), F.col("_to") + (x - F.col("_from"))).otherwise(stretched)


def _anchors(back: bool) -> list[Column]:
    here, there = (F.col("offset"), F.lit(0)) if back else (F.lit(0), F.col("offset"))
    return [F.struct((F.col(c) + here).cast("double").alias("f"), (F.col(c) + there).cast("double").alias("t")) for c in ("start", "end")]


def _axis_windows(points: DataFrame, axis: DataFrame, keys: list[str], position: str, back: bool) -> DataFrame:
    """to_axis for keys whose rows fit in a task. A block is shuffled as one row and becomes two anchors behind the shuffle."""
    own = [c for c in points.columns if c not in keys]
    point, ends = F.struct(*own), F.array_distinct(F.array(*_anchors(back)))
    kinds = {"_point": points.select(point.alias("p")).schema["p"].dataType, "_ends": axis.select(ends.alias("e")).schema["e"].dataType}
    none = {k: F.lit(None).cast(t).alias(k) for k, t in kinds.items()}
    both = axis.select(*keys, none["_point"], ends.alias("_ends")).unionByName(points.select(*keys, point.alias("_point"), none["_ends"]))
    rows = both.repartition(*keys).select(*keys, "_point", F.explode_outer("_ends").alias("_a"))
    is_point = F.col("_point").isNotNull()
    rows = rows.withColumn("_pos", F.when(is_point, F.col(f"_point.{position}").cast("double")).otherwise(F.col("_a.f"))).withColumn("_kind", is_point.cast("int"))
    order = Window.partitionBy(*keys).orderBy("_pos", "_kind")
    last = F.last("_a", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = Window.partitionBy(*keys).orderBy(F.desc("_pos"), F.desc("_kind"))
    later = F.last(F.when(F.col("_kind") == 0, F.col("_a")), ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_last", last).withColumn("_after", later).where("_kind = 1")
    known = F.col("_pos").isNotNull()
    found = found.select(*keys, *[F.col(f"_point.{c}").alias(c) for c in own], F.when(known, F.col("_last.f")).alias("_from"), F.when(known, F.col("_last.t")).alias("_to"), F.when(known, F.col("_after")).alias("_after"))
    return found.select(*points.columns, _mapped(F.col(position)).alias("mapped"))


def _axis_ranges(points: DataFrame, axis: DataFrame, keys: list[str], position: str, back: bool) -> DataFrame:
    """to_axis without a key's rows in one task."""
    anchors = axis.select(*keys, F.explode(F.array(*_anchors(back))).alias("_a")).select(*keys, F.col("_a.f").alias("start"), F.col("_a.t").alias("_to")).distinct()
    anchors = before(anchors.withColumns({"_down": -F.col("start"), "_one": F.struct(F.col("start").alias("f"), F.col("_to").alias("t"))}), list(keys), ["_down"], lasts={"_next": "_one"})
    first = anchors.groupBy(*keys).agg(F.min_by("_one", "start").alias("_next")).select(*keys, F.lit(float("-inf")).alias("start"), F.lit(None).cast("double").alias("_to"), "_next")
    segs = anchors.select(*keys, "start", "_to", "_next").unionByName(first).withColumnRenamed("_next", "_after").withColumn("_from", F.col("start"))
    found = last_start(points, segs.select(*keys, "start", "_from", "_to", "_after"), keys, position)
    return found.select(*points.columns, _mapped(F.col(position)).alias("mapped"))
