"""PII: validated numbers, dates and secrets become keyed pseudonyms of the same format.

A value is taken apart to its letters and digits, each with its own radix; the mixed-radix number is permuted by an
eight-round Feistel network (rounds keyed by BLAKE2b over key, kind and domain) with cycle walking, until it lies in
the domain and validates. Longer values (over 64 letters and digits) are permuted as digit strings: the halves are shifted
in turn, digit by digit, by a keyed hash of the other half, which takes linear time and never leaves the domain. Separators, case and lengths stay (numbers of an IP address may take more or fewer digits); check
digits are recomputed. The permutation depends on the key, the kind and the format only, so equal values stay linked
across documents, and `replace(..., back=True)` inverts it. Who has the key can invert it, so there is no default: it is
an argument, and the query takes it from `spark.strandweave.pii.key`, else a new one for each run.

Kinds: payment cards (13 to 19 digits, Luhn), IBANs (mod 97), IPv4 addresses, calendar dates (1900 to 2099, ISO or with
slashes or dots), social security numbers (valid areas), phone numbers (7 to 15 digits, country code kept), local
parts of e-mail addresses, access keys and values of password, token and key assignments.

Edge cases: null text: null, no finds. Very long texts, with or without blanks, take time in proportion to their length. Invalid numbers (a failed check, 31 February) are left alone. Values that
overlap: the first, then the longest by the order above. A value over a line break isn't found. Repeated rows give equal results. Extra columns pass through
`pseudonymize`; a column named `n_found` is replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import secrets
from collections.abc import Iterator
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

_EPOCH, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()

_FIND = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,})"
    r"|(?P<secret>(?i:(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?)[A-Za-z0-9+/_\-]{8,}|\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<iban>\b[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d))"
    r"|(?P<date>(?<![\d/.-])(?:\d{4}-\d\d-\d\d|\d\d?/\d\d?/\d{4}|\d\d?\.\d\d?\.\d{4})(?![\d/-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]))"
    r"|(?P<phone>(?<![\w.+])(?:\+\d(?:[ .()-]{0,3}\d){6,14}|(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{4})(?![\w-]))"
)
_MAYBE = re.compile(r"\d|@|[=:]")
_SECRET = re.compile(r"(?i)^((?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?)(.*)$|^(AKIA|ASIA)(.*)$", re.S)


class Feistel:
    """A keyed permutation of range(size), by balanced Feistel rounds and cycle walking."""

    def __init__(self, key: bytes, tweak: str, size: int, rounds: int = 8):
        self.size, self.rounds = size, rounds
        self.half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.bytes = (self.half + 7) // 8
        self.seed = hashlib.blake2b(f"{tweak}:{size}".encode(), key=key[:64]).digest()

    def _f(self, k: int, x: int) -> int:
        out = b""
        block = 0
        while len(out) < self.bytes:
            out += hashlib.blake2b(x.to_bytes(self.bytes, "big") + bytes([k, block]), key=self.seed).digest()
            block += 1
        return int.from_bytes(out[: self.bytes], "big") & self.mask

    def _once(self, x: int, back: bool) -> int:
        left, right = x >> self.half, x & self.mask
        for k in reversed(range(self.rounds)) if back else range(self.rounds):
            if back:
                left, right = right ^ self._f(k, left), left
            else:
                left, right = right, left ^ self._f(k, right)
        return left << self.half | right

    def __call__(self, x: int, back: bool = False, valid=lambda x: True) -> int:
        """The image of x; walks on while the value is outside the domain or not valid. x itself must be valid."""
        y = x
        while True:
            y = self._once(y, back)
            if y < self.size and valid(y):
                return y


def permute_digits(digits: np.ndarray, bases: np.ndarray, key: bytes, tweak: str, back: bool = False, rounds: int = 8) -> np.ndarray:
    """Feistel rounds over the two halves of a digit string: each half in turn is shifted, digit by digit, by a keyed hash of the other."""
    out, cut = digits.astype(np.int64), len(digits) // 2
    seed = hashlib.blake2b(f"{tweak}:{len(digits)}".encode(), key=key[:64]).digest()
    for k in reversed(range(rounds)) if back else range(rounds):
        own, other = (slice(0, cut), slice(cut, None)) if k % 2 else (slice(cut, None), slice(0, cut))
        noise = hashlib.shake_256(seed + bytes([k]) + out[other].astype(np.uint8).tobytes()).digest(8 * len(out[own]))
        shift = (np.frombuffer(noise, "<u8") % bases[own].astype(np.uint64)).astype(np.int64)
        out[own] = (out[own] - shift if back else out[own] + shift) % bases[own]
    return out


#: Values of more letters and digits are permuted as digit strings, in linear time, instead of as one number.
AS_NUMBER = 64
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = "0123456789abcdef"


def _kinds(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a text, which of the three classes each is of (3: none), and its place in the class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kind = np.select([(points >= ord(c[0])) & (points <= ord(c[-1])) for c in _CLASSES], [0, 1, 2], 3)
    return points, kind, points - np.array([ord(c[0]) for c in _CLASSES] + [0])[kind]


def _permute_long(text: str, key: bytes, tweak: str, back: bool) -> str:
    points, kind, digit = _kinds(text)
    at = np.flatnonzero(kind < 3)
    bases = np.array([len(c) for c in _CLASSES])[kind[at]]
    shape = hashlib.blake2b(kind[at].astype(np.uint8).tobytes()).hexdigest()
    new = permute_digits(digit[at], bases, key, f"{tweak}:{shape}", back)
    points[at] += new - digit[at]
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def permute_text(text: str, key: bytes, kind: str, back: bool = False, valid=lambda s: True) -> str:
    """Digits, small and capital letters are permuted among their like; all else stays."""
    if len(text) > AS_NUMBER and (_kinds(text)[1] < 3).sum() > AS_NUMBER:
        while True:
            text = _permute_long(text, key, kind, back)
            if valid(text):
                return text
    at = [(i, c) for i, ch in enumerate(text) for c in _CLASSES if ch in c]
    if not at:
        return text
    bases = [len(c) for _, c in at]

    def join(n: int) -> str:
        out = list(text)
        for (i, c), b in zip(reversed(at), reversed(bases)):
            n, d = divmod(n, b)
            out[i] = c[d]
        return "".join(out)

    n = 0
    for (i, c), b in zip(at, bases):
        n = n * b + c.index(text[i])
    shape = "".join("9aA"[_CLASSES.index(c)] for _, c in at)
    return join(Feistel(key, f"{kind}:{shape}", prod(bases))(n, back, lambda y: valid(join(y))))


def permute_hex(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Hexadecimal digits among each other."""
    if len(text) <= AS_NUMBER:
        return format(Feistel(key, kind, 16 ** len(text))(int(text, 16), back), f"0{len(text)}x")
    raw = np.frombuffer(text.encode(), np.uint8)
    digits = np.where(raw >= ord("a"), raw - ord("a") + 10, raw - ord("0")).astype(np.int64)
    new = permute_digits(digits, np.full(len(raw), 16), key, kind, back)
    return np.frombuffer(_HEX.encode(), np.uint8)[new].tobytes().decode()


def luhn(digits: str) -> int:
    """The check digit that follows digits."""
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(text: str, chars: str) -> str:
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in text)


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _card(v, key, back):
    d = re.sub(r"\D", "", v)
    if luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = permute_text(d[:-1], key, "card", back)
    return _refill(v, body + str(luhn(body)))


def _iban(v, key, back):
    raw = v.replace(" ", "")
    if not 15 <= len(raw) <= 34 or _iban_check(raw[:2], raw[4:]) != raw[2:4]:
        return None
    rest = permute_text(raw[4:], key, "iban", back)
    return _refill(v, raw[:2] + _iban_check(raw[:2], rest) + rest)


def _ip(v, key, back):
    parts = [int(x) for x in v.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in v.split(".")):
        return None
    n = Feistel(key, "ip", 1 << 32)(int.from_bytes(bytes(parts), "big"), back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def _date(v, key, back):
    sep = "-" if "-" in v else "/" if "/" in v else "."
    p = [int(x) for x in v.split(sep)]
    wide = len(v) == 10
    order = (0, 1, 2) if sep == "-" else (2, 1, 0) if sep == "." or p[1] <= 12 else (2, 0, 1)  # day first unless it can't be
    try:
        day = dt.date(p[order[0]], p[order[1]], p[order[2]]).toordinal() - _EPOCH
    except ValueError:
        return None
    if not 0 <= day < _DAYS:
        return None

    def form(n: int) -> str:
        d = dt.date.fromordinal(n + _EPOCH)
        f = {order[0]: f"{d.year:04d}", order[1]: f"{d.month:02d}" if wide else str(d.month), order[2]: f"{d.day:02d}" if wide else str(d.day)}
        return sep.join(f[k] for k in range(3))

    def same_form(n: int) -> bool:
        s = form(n)
        q = [int(x) for x in s.split(sep)]
        return (len(s) == 10) == wide and (sep != "/" or (q[1] <= 12) == (p[1] <= 12))

    return form(Feistel(key, f"date:{sep}:{order}:{wide}", _DAYS)(day, back, same_form))


def _ssn(v, key, back):
    ok = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"
    return permute_text(v, key, "ssn", back, ok) if ok(v) else None


def _phone(v, key, back):
    n = sum(c.isdigit() for c in v)
    if not 7 <= n <= 15:
        return None
    code = re.match(r"\+\d{1,3}(?=\D)|\+\d", v)
    head = code.group() if code else ""
    return head + permute_text(v[len(head) :], key, "phone", back)


def _email(v, key, back):
    local, _, host = v.partition("@")
    return f"{permute_text(local, key, 'email', back)}@{host}"


def _secret(v, key, back):
    m = _SECRET.match(v)
    head, body = (m[1], m[2]) if m[1] is not None else (m[3], m[4])
    if m[1] is not None and not re.search(r"\d", body):
        return None  # a word, not a secret
    if re.fullmatch(r"[0-9a-f]+", body):  # stay hexadecimal
        return head + permute_hex(body, key, "hex", back)
    return head + permute_text(body, key, "secret", back)


_KINDS = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all values that validate."""
    return [(m.lastgroup, m.start(), m.end()) for m in _FIND.finditer(text) if _KINDS[m.lastgroup](m.group(), b"any", False) is not None]


def replace(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, int]:
    """text with pseudonyms, and their number. back: restores what was replaced with the same key."""
    if not text or not _MAYBE.search(text):
        return text, 0
    count = 0

    def swap(m: re.Match) -> str:
        nonlocal count
        new = _KINDS[m.lastgroup](m.group(), key, back)
        if new is None:
            return m.group()
        count += 1
        return new

    lines = text.split("\n")
    out = "\n".join(_FIND.sub(swap, line) if _MAYBE.search(line) else line for line in lines)
    return out, count


def _run(key: bytes, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                new = [replace(t.as_py(), key) for t in part.column(column)]
                columns = list(part.columns)
                columns[column] = pa.array([t for t, _ in new], part.schema.field(column).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in new], pa.int64())], [*part.schema.names, "n_found"])

    return run


def pseudonymize(docs: DataFrame, *, key: bytes, text_col: str = "text") -> DataFrame:
    """docs with pseudonyms in the text, and n_found, their number."""
    docs = docs.drop("n_found")
    schema = StructType([*docs.schema.fields, StructField("n_found", LongType())])
    return docs.mapInArrow(_run(key, docs.columns.index(text_col)), schema)


# ---------------------------------------------------------------- query


def op6_feistel_pseudonyms(spark, sf_dir):
    key = spark.conf.get("spark.strandweave.pii.key", None) or secrets.token_hex(32)
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), key=key.encode())


QUERIES = {"op6_feistel_pseudonyms": op6_feistel_pseudonyms}
ORACLE = {}
