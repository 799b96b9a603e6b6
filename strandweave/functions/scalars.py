"""Scalar column functions: names, lists, rounding, titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing in titles of sequences.
STOP_WORDS = (
    "genome", "complete", "sequence", "strain", "isolate", "and", "or", "sapiens", "genes", "predicted", "human", "homo", "assembly", "mus", "musculus", "virus", "polyprotein",
)


def tax_ids(text: Column) -> Column:
    """`a;b;c` to an int array; `N/A`, null or anything malformed to an empty one (SCL-22)."""
    ids = F.transform(F.split(text, ";"), lambda v: v.try_cast("int"))
    return F.when(text.isNull() | F.exists(ids, lambda v: v.isNull()), F.array().cast("array<int>")).otherwise(ids)


def file_safe(name: Column) -> Column:
    """Blanks, slashes and dots to underscores, pairs of these to one, none at the ends (PRJ-14)."""
    return F.btrim(F.replace(F.translate(name, " /.", "___"), F.lit("__"), F.lit("_")), F.lit("_"))


def head_tail(text: Column) -> tuple[Column, Column]:
    """The text up to the first white space, and the rest (SCL-01)."""
    parts = F.split(F.trim(text), r"\s+", 2)
    return F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(""))


def separate(text: Column, into: Sequence[str], sep: str, merge: bool = False) -> list[Column]:
    """Columns split off by a regex; missing ones null, extra pieces dropped or merged into the last (PRJ-07)."""
    parts = F.split(text, sep, len(into) if merge else -1)
    return [F.get(parts, k).alias(name) for k, name in enumerate(into)]


def before_last(text: Column, sep: str = ".") -> Column:
    """The text before the last separator, all of it if there is none (SCL-02)."""
    n = F.length(text) - F.length(F.substring_index(text, sep, -1)) - len(sep)
    return F.when(n > 0, F.substring(text, F.lit(1), n)).otherwise(text)


def sample_name(file_name: Column, suffix: str) -> Column:
    """`X.blast7.gz` to `X` (SRC-03)."""
    return F.regexp_replace(file_name, rf"\.{suffix}(\.gz)?$", "")


def round_half_even(x: Column, digits: int) -> Column:
    """Rounding as binary floating point sees it: the exact binary value, ties to even."""
    return F.bround(x.cast("decimal(38,18)"), digits).cast("double")


def genome_coverage(bp: Column, size: Column, digits: int = 0) -> Column:
    """bp in percent of the genome size, null unless the size is positive (PRJ-04)."""
    return F.when(size > 0, F.round(bp / size * 100, digits))


def swap_if(cond: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """(y, x) where cond holds, (x, y) elsewhere; a null condition leaves them (PRJ-08)."""
    return F.when(cond, y).otherwise(x), F.when(cond, x).otherwise(y)


def merge_lists(values: Column, sep: str) -> Column:
    """Collected separated strings to one of their sorted distinct parts (AGG-18)."""
    parts = F.flatten(F.transform(values, lambda v: F.split(v, sep)))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda v: v.isNotNull()))), sep)


def drop_last(lineage: Column, sep: str = ";") -> Column:
    """A lineage without its last element (TAX-13)."""
    return F.regexp_replace(lineage, rf"{sep}[^{sep}]*$", "")


def first_elements(lineage: Column, n: int, sep: str = ";") -> Column:
    return F.substring_index(lineage, sep, n)


def last_match(text: Column, cases: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """CASE over regexes where the last one that matches wins (PRJ-19)."""
    out = F.lit(default)
    for pattern, value in cases:
        out = F.when(text.rlike(pattern), value).otherwise(out)
    return out


def recode(text: Column, steps: Sequence[tuple[str, str]]) -> Column:
    """Regex replacements in order, of the first match each (PRJ-18). Groups that replacements use must be named."""
    for pattern, value in steps:
        text = F.regexp_replace(text, f"(?s)^(?<before>.*?)(?:{pattern})", "${before}" + value)
    return text


# Steps from names of taxa to short names of viruses with their strains.
VIRUS_STEPS = (
    (" virus.*", ""), ("rhinovirus sp.", "rhinovirus B"), ("rhinovirus 1B", "rhinovirus A"), ("(?:Human )?[Rr]hinovirus (?<strain>[A-Z]).*", "HRV ${strain}"),
    ("Human orthopneumovirus", "RSV"), ("Human metapneumovirus", "HMPV"), ("Human respirovirus", "HPIV"), ("Human coronavirus", "CoV"), ("(?:Human )?[Ee]nterovirus", "EV"),
)


def virus_and_strain(taxname: Column) -> tuple[Column, Column]:
    """(virus, strain) of a taxon's name: the nine steps, then cut at what is neither letter nor digit; further pieces dropped."""
    parts = F.split(recode(taxname, VIRUS_STEPS), r"[^\p{Alnum}]+")
    return F.get(parts, 0), F.get(parts, 1)


def recode_values(value: Column, names: dict[str, str]) -> Column:
    """Values renamed by a map of old to new names, others as they are (PRJ-11)."""
    pairs = [x for old, new in names.items() for x in (F.lit(old), F.lit(new))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value) if pairs else value


def contig_number(acc: Column) -> Column:
    """`NODE_12_length_…` to `12` (PRJ-13)."""
    return F.regexp_replace(acc, r"^NODE_([0-9]+)_.*", "$1")


def species_of_path(path: Column) -> Column:
    """`…/Some_name.fasta.gz` to `Some name`; null for other names (SCL-07)."""
    name = F.regexp_extract(path, r"(?:^|/)([^.]+)\.fasta\.gz", 1)
    return F.when(name != "", F.replace(F.substring_index(name, "/", -1), F.lit("_"), F.lit(" ")))


def clock_seconds(text: Column) -> Column:
    """`h:m:s` in seconds; hours may exceed a day (SCL-21)."""
    parts = F.transform(F.split(text, ":"), lambda x: x.try_cast("double"))
    return F.when(F.size(parts) == 3, F.get(parts, 0) * 3600 + F.get(parts, 1) * 60 + F.get(parts, 2))


def xml_text(document: Column, path: str) -> Column:
    """All texts at an XPath of an XML document (SCL-28)."""
    return F.xpath(document, F.lit(f"{path}/text()"))


def log_evalue(score: Column, qlen: Column, *, lam: float = 0.625, kappa: float = 0.41, db_size: int = 1_004_024_614) -> Column:
    """log10 of the expected number of hits of a raw score (AGG-08)."""
    natural = score * -lam + F.log(F.lit(kappa)) + F.log(F.lit(float(db_size))) + F.log(qlen.cast("double"))
    return F.round(natural / F.log(F.lit(10.0)), 2)


def bit_score(score: Column, *, lam: float = 0.625, kappa: float = 0.41) -> Column:
    return (score * lam - F.log(F.lit(kappa))) / F.log(F.lit(2.0))


# ---- words of titles (TXT-01 to TXT-06)


def title_words(title: Column, stop_words: Sequence[str] = STOP_WORDS, short: int = 2) -> Column:
    """Words of a title: punctuation off at the ends, sentence case undone, short words (also what was punctuation only)
    joined to what precedes them, then stop words of any case out. `alpha b c delta` gives `alpha b c`, `alpha b`,
    `alpha`, `delta`."""
    words = F.filter(F.split(F.trim(title), r"\s+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", ""))
    rest = lambda w: F.substring(w, F.lit(2), F.length(w))
    words = F.transform(words, lambda w: F.when((rest(w) == F.lower(rest(w))) & (rest(w) != F.upper(rest(w))), F.lower(w)).otherwise(w))
    # done: finished words; run: the current word with its short followers, longest first
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), empty.alias("run"))

    def step(acc, w):
        joined = F.concat(F.array(F.concat_ws(" ", F.get(acc["run"], 0), w)), acc["run"])
        short_word = (F.length(w) <= short) & (F.size(acc["run"]) > 0)
        return F.struct(
            F.when(short_word, acc["done"]).otherwise(F.concat(acc["done"], acc["run"])).alias("done"),
            F.when(short_word, joined).otherwise(F.array(w)).alias("run"),
        )

    found = F.aggregate(words, start, step, lambda acc: F.concat(acc["done"], acc["run"]))
    stops = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(found, lambda w: ~F.array_contains(stops, F.lower(w)))


def best_words(scored: Column, k: int = 4) -> Column:
    """The first k single words of a score-ordered array of (possibly joined) words, none twice (SRT-04)."""
    start = F.array().cast("array<string>")

    def step(acc, w):
        new = F.filter(F.split(w, " "), lambda x: (x != "") & ~F.array_contains(acc, x))
        return F.when(F.size(acc) > k, acc).otherwise(F.concat(acc, new))

    return F.slice(F.aggregate(scored, start, step), 1, k)
