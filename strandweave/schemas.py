"""Declared schemas. Coordinates are 1-based and closed; a reverse-strand hit has sstart > send."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "a": T.ArrayType(T.IntegerType())}


def _schema(spec: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.rsplit(":", 1) for x in spec.split())])


HIT = _schema(
    "sample:s ord:l qacc:s qlen:i sacc:s qstart:i qend:i sstart:i send:i evalue:d bitscore:d score:d length:i pident:d mismatch:i gapopen:i"
    " qframe:i sframe:i btop:s staxids:a stitle:s sstrand:s"
)
BLAST6 = _schema("qseqid:s sseqid:s pident:d length:i mismatch:i gapopen:i qstart:i qend:i sstart:i send:i evalue:d bitscore:d")
COVERAGE = _schema("#rname:s startpos:d endpos:d numreads:i covbases:i coverage:d meandepth:d meanbaseq:d meanmapq:d")
DEPTH = _schema("contig:s pos:i depth:i")
FEATURE = _schema("acc:s start:i end:i typ:s key:s value:s")
SCAFFOLD = _schema("acc:s bin:s sstart:i send:i qacc:s qstart:i qend:i qlen:i reversed:b bp:i scaffold:s")
CALLHIT = _schema("sample:s sacc:s qacc:s qlen:i pident:d bitscore:d qstart:i qend:i sstart:i send:i btop:s numreads:i")
CLASSIFY = _schema("qacc:s score:d taxname:s genus:s lineage:s ranks:s")
VHDB = T.StructType(
    [
        T.StructField(n, T.IntegerType() if n in ("virus tax id", "host tax id", "source organism") else T.StringType())
        for n in (
            "virus tax id", "virus name", "virus lineage", "refseq id", "KEGG GENOME", "KEGG DISEASE", "DISEASE", "host tax id", "host name", "host lineage",
            "pmid", "evidence", "sample type", "source organism",
        )
    ]
)


def fasta_qc(ks: list[int]) -> T.StructType:
    return _schema("acc:s len_all:i len_used:i " + " ".join(f"entropy{k}:d" for k in ks) + " frac_hp:d")


def calls(ks: list[int] = (), *, reads: bool = False, genome: bool = False) -> T.StructType:
    """The calls table; columns for reads, sequence quality and genome size exist only where these were supplied."""
    spec = "sample:s words:s log_evalue:d slen:i n_frag:i contig_coverage:d sacc:s stitle:s staxids:s pident:d"
    spec += " numreads:i" * reads + "".join([" pcthp:d", *(f" entropy{k}:d" for k in ks)] if ks else []) + " genome_size_source:s genome_size:d" * genome
    return _schema(spec + " taxname:s species:s lineage:s lineage_ranks:s taxid:i")


#: Long field names of tabular alignment output and their short names.
FIELD_NAMES = {
    "query acc.": "qacc", "query acc.ver": "qaccver", "query id": "qseqid", "query length": "qlen", "subject acc.": "sacc", "subject acc.ver": "saccver",
    "subject id": "sseqid", "subject length": "slen", "q. start": "qstart", "q. end": "qend", "s. start": "sstart", "s. end": "send", "evalue": "evalue",
    "bit score": "bitscore", "score": "score", "alignment length": "length", "% identity": "pident", "identical": "nident", "mismatches": "mismatch",
    "gap opens": "gapopen", "gaps": "gaps", "query frame": "qframe", "sbjct frame": "sframe", "BTOP": "btop", "subject tax ids": "staxids", "subject tax id": "staxid",
    "subject title": "stitle", "subject strand": "sstrand", "% query coverage per subject": "qcovs",
}
FIELD_TYPES = {
    **dict.fromkeys("qlen slen qstart qend sstart send length nident mismatch gapopen gaps qframe sframe staxid".split(), "int"),
    **dict.fromkeys("evalue bitscore score pident qcovs".split(), "double"),
}
