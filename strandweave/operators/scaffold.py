"""Consensus scaffolds of contigs aligned to a subject.

A subject's alignments are cut at all their ends; every section is filled with the contig over it, the consensus of
several, or `n`. It is sequential along a subject: rows are streamed in order, and what is held are one subject's contigs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import written

_FLIP = str.maketrans("ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn")
_TOKEN = re.compile(r"(\d+)|([A-Za-z*-]{2})")


def flip(seq: str) -> str:
    return seq.translate(_FLIP)[::-1]


@dataclass(frozen=True)
class Slice:
    """Part of an alignment: text of one side with `-`, where the other side lacks bases, and the query's coordinates."""

    text: str
    inserts: tuple[int, ...]  # offsets in the text of bases that the subject lacks
    qstart: int
    qend: int


class Alignment:
    """A hit as columns (query base, subject base), in the query's direction; built from BTOP and the contig."""

    def __init__(self, qacc: str, query: str, qstart: int, qend: int, sstart: int, send: int, btop: str):
        self.qacc, self.qstart, self.qend, self.sstart, self.send, self.query = qacc, qstart, qend, sstart, send, query
        self.forward = send > sstart
        columns, at = [], qstart - 1
        for run, edit in _TOKEN.findall(btop):
            if run:
                part = query[at : at + int(run)]
                columns += [(c, c) for c in part]
                at += int(run)
            else:
                columns.append((edit[0] if edit[0] == "-" else query[at], edit[1]))
                at += edit[0] != "-"
        self.columns = columns
        # position of each subject base (1-based, in alignment direction): first column that belongs to it; an insertion
        # belongs to the base that follows it
        self.first, self.last, begin = [], [], 0
        for k, (_, s) in enumerate(columns):
            if s != "-":
                self.first.append(begin)
                self.last.append(k)
                begin = k + 1

    def aligned(self, start: int, stop: int, side: int = 0) -> Slice:
        """Columns of subject bases start..stop, counted along the alignment; side 0 is the query's text, 1 the subject's."""
        if start < 1 or stop > len(self.first) or start > stop:
            raise IndexError(f"{start}..{stop} is not within 1..{len(self.first)}")
        lo, hi = self.first[start - 1], self.last[stop - 1] + 1
        if stop == len(self.first):
            hi = len(self.columns)
        before = sum(q != "-" for q, _ in self.columns[:lo])
        inside = sum(q != "-" for q, _ in self.columns[lo:hi])
        part = self.columns[lo:hi]
        return Slice("".join(c[side] for c in part), tuple(k for k, (_, s) in enumerate(part) if s == "-"), self.qstart + before, self.qstart + before + inside - 1)

    def over(self, start: int, stop: int, side: int = 0) -> Slice:
        """The same by subject coordinates; on the reverse strand the slice is reverse-complemented."""
        if self.forward:
            return self.aligned(start - self.sstart + 1, stop - self.sstart + 1, side)
        s = self.aligned(self.sstart - stop + 1, self.sstart - start + 1, side)
        n = len(s.text)
        return Slice(flip(s.text), tuple(sorted(n - 1 - k for k in s.inserts)), s.qstart, s.qend)


def reconcile(slices: Sequence[Slice]) -> list[str]:
    """Texts of equal length: where some have bases that the subject lacks, the others get `-` (SEQ-07)."""
    need: Counter = Counter()
    runs = []
    for s in slices:
        own, base, marks = Counter(), 0, set(s.inserts)
        for k in range(len(s.text)):
            if k in marks:
                own[base] += 1
            else:
                base += 1
        runs.append((own, base))
        for p, n in own.items():
            need[p] = max(need[p], n)
    out = []
    for s, (own, bases) in zip(slices, runs):
        text, at = [], 0
        for p in range(bases + 1):
            text.append(s.text[at : at + own[p]] + "-" * (need[p] - own[p]))
            at += own[p]
            if p < bases:
                text.append(s.text[at])
                at += 1
        out.append("".join(text))
    return out


def consensus(texts: Sequence[str], strip: bool = True) -> str:
    """Column-wise vote; a tie of the two most frequent is `n`; a winning `-` is dropped unless strip is False (SEQ-08)."""
    if len({len(t) for t in texts}) > 1:
        raise ValueError("texts differ in length")
    out = []
    for column in zip(*texts):
        top = Counter(column).most_common(2)
        best = "n" if len(top) > 1 and top[0][1] == top[1][1] else top[0][0]
        if best != "-" or not strip:
            out.append(best)
    return "".join(out)


@dataclass
class Section:
    start: int
    end: int
    alignments: list[Alignment]
    text: str = ""
    kind: str = "gap"


def _sections(alignments: Sequence[Alignment]) -> list[Section]:
    spans = [(min(a.sstart, a.send), max(a.sstart, a.send), a) for a in alignments]
    points = sorted({p for lo, hi, _ in spans for p in (lo, hi + 1)})
    return [Section(s, e - 1, [a for lo, hi, a in spans if lo <= s and hi >= e - 1]) for s, e in zip(points, points[1:])]


def scaffold_contigs(alignments: Sequence[Alignment], max_fill: int = 50_000) -> tuple[dict[str, str], list[dict]]:
    """Scaffold sequences by id, and mapping rows of their sections (SEQ-09)."""
    secs = _sections(alignments)
    pieces: list[tuple[Section, list[tuple[str, int, int, bool]]]] = []
    for k, sec in enumerate(secs):
        over = [(a, a.over(sec.start, sec.end)) for a in sec.alignments]
        where = [(a.qacc, s.qstart, s.qend, not a.forward) for a, s in over]
        if not over:
            sec.text, sec.kind = "n" * (sec.end - sec.start + 1), "gap"
        elif len(over) == 1:
            sec.text, sec.kind = over[0][1].text.replace("-", ""), "unique"
        else:
            subject = consensus(reconcile([a.over(sec.start, sec.end, 1) for a, _ in over]), strip=False)
            queries = reconcile([s for _, s in over])
            votes = [*queries, subject] if len(subject) == len(queries[0]) else queries
            sec.text, sec.kind = consensus(votes), "consensus"
        if k >= 2 and over and not secs[k - 1].alignments:
            _join_split(pieces, over)
        pieces.append((sec, where))
    _overhang(pieces, alignments)
    return _split(pieces, max_fill, {a.qacc: len(a.query) for a in alignments})


def _join_split(pieces, over) -> None:
    """A gap between two parts of one contig on the same strand gets the contig's bases between them, none where they overlap."""
    (_, before), (gap, _) = pieces[-2:]
    for a, s in over:
        left = [w for w in before if w[0] == a.qacc]
        if len(left) != 1 or left[0][3] == a.forward:
            continue
        lo, hi = (left[0][2], s.qstart) if a.forward else (s.qend, left[0][1])
        text = a.query[lo : max(lo, hi - 1)]
        gap.text = text if a.forward else flip(text)
        if text:
            pieces[-1] = (gap, [(a.qacc, lo + 1, hi - 1, not a.forward)])
            return


def _overhang(pieces, alignments) -> None:
    """Contig ends beyond the first and the last section are kept where one contig lies there once, unless they are used elsewhere.

    They take subject coordinates before the first section's start and after the last one's end.
    """
    for first in (True, False):
        sec, where = pieces[0] if first else pieces[-1]
        if len(where) != 1:
            continue
        qacc, lo, hi, rev = where[0]
        query = next(a.query for a in alignments if a.qacc == qacc)
        a, b = (1, lo - 1) if first != rev else (hi + 1, len(query))
        if a > b or any(q == qacc and (x <= a <= y or x <= b <= y) for _, own in pieces for q, x, y, _ in own):
            continue
        text, n = flip(query[a - 1 : b]) if rev else query[a - 1 : b], b - a + 1
        edge = Section(sec.start - n, sec.start - 1, [], text, "edge") if first else Section(sec.end + 1, sec.end + n, [], text, "edge")
        pieces.insert(0 if first else len(pieces), (edge, [(qacc, a, b, rev)]))


def _split(pieces, max_fill: int, lengths: dict[str, int]) -> tuple[dict[str, str], list[dict]]:
    groups: list[list] = [[]]
    for sec, where in pieces:
        if max_fill > 0 and sec.text and set(sec.text) == {"n"} and len(sec.text) > max_fill:
            groups.append([])
        else:
            groups[-1].append((sec, where))
    groups = [g for g in groups if g]
    name = "+".join(sorted({w[0] for _, where in pieces for w in where}))
    seqs, rows = {}, []
    for k, group in enumerate(groups):
        acc = name if k == 0 else f"{name}.{k + 1}"
        seqs[acc] = "".join(s.text for s, _ in group)
        for s, where in group:
            for qacc, lo, hi, rev in where:
                rows.append({"acc": acc, "sstart": s.start, "send": s.end, "qacc": qacc, "qstart": lo, "qend": hi, "qlen": lengths[qacc], "reversed": rev, "bp": sum(s.text.count(c) for c in "ACGT"), "scaffold": s.kind})
    return seqs, rows


_ROW = "sstart int, send int, qacc string, qstart int, qend int, qlen int, reversed boolean, bp int, scaffold string"


def scaffold_table(hits: DataFrame, contigs: DataFrame, *, max_fill: int = 50_000) -> DataFrame:
    """`sample, sacc, acc, seq, parts`: each scaffold with the mapping rows of its sections, in one pass."""
    rows = hits.join(contigs, "qacc").select("sample", "sacc", "qacc", "qstart", "qend", "sstart", "send", "btop", "seq", "ord")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [c.split(" ")[0] for c in _ROW.split(", ")]
    fields = ", ".join(c.replace(" ", ": ") for c in _ROW.split(", "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scaffolds of sorted rows; a subject's may be spread over batches."""
        kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
        row = pa.struct([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in _ROW.split(", ")])
        key, own, types = None, [], None

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 5
            types_ = [*types, pa.string(), pa.string(), pa.list_(row)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types_)], ["sample", "sacc", "acc", "seq", "parts"])

        def close() -> list[tuple]:
            found, parts = scaffold_contigs(own, max_fill)
            by: dict[str, list] = {acc: [] for acc in found}
            for p in parts:
                by[p["acc"]].append({c: p[c] for c in names})
            return [(*key, acc, seq, by[acc]) for acc, seq in found.items()]

        for batch in batches:
            types, out = [batch.schema.field(c).type for c in ("sample", "sacc")], []
            for sample, sacc, qacc, qstart, qend, sstart, send, btop, seq in zip(*[batch.column(c).to_pylist() for c in ("sample", "sacc", "qacc", "qstart", "qend", "sstart", "send", "btop", "seq")]):
                if own and (sample, sacc) != key:
                    out += close()
                    own = []
                key = (sample, sacc)
                own.append(Alignment(str(qacc), seq, int(qstart), int(qend), int(sstart), int(send), btop))
            yield table(out)
        if own:
            yield table(close())

    dealt = rows.repartition("sample", "sacc").sortWithinPartitions("sample", "sacc", "ord")
    return dealt.mapInArrow(run, f"sample {kind['sample']}, sacc {kind['sacc']}, acc string, seq string, parts array<struct<{fields}>>")


def scaffolds(hits: DataFrame, contigs: DataFrame, *, max_fill: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(sequences, mapping) of all (sample, sacc): hits with btop, joined with contigs `qacc, seq`. Gaps have no mapping rows."""
    both = written(scaffold_table(hits, contigs, max_fill=max_fill))
    return both.drop("parts"), both.select("sample", "sacc", "acc", F.inline("parts"))
