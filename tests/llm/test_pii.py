import hashlib
import random
import string
import time

import numpy as np
import pytest

from strandweave.llm import pii

CLASSES = (string.digits, string.ascii_lowercase, string.ascii_uppercase)


def plain_digits(digits, bases, key, tweak, back=False):
    """The digit-string rounds, one digit at a time."""
    out, cut = list(digits), len(digits) // 2
    seed = hashlib.blake2b(f"{tweak}:{len(digits)}".encode(), key=key).digest()
    for k in range(8)[:: -1 if back else 1]:
        left, right = list(range(cut)), list(range(cut, len(out)))
        own, other = (left, right) if k % 2 else (right, left)
        noise = hashlib.shake_256(seed + bytes([k]) + bytes(out[i] for i in other)).digest(8 * len(own))
        for j, i in enumerate(own):
            shift = int.from_bytes(noise[8 * j : 8 * j + 8], "little")
            out[i] = (out[i] + (-shift if back else shift)) % bases[i]
    return out


def plain_number(n, size, key, tweak):
    """Eight rounds on one number, walking until it is in the domain."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    wide = (half + 7) // 8
    seed = hashlib.blake2b(f"{tweak}:{size}".encode(), key=key).digest()
    while True:
        left, right = n >> half, n % (1 << half)
        for k in range(8):
            noise = b"".join(hashlib.blake2b(right.to_bytes(wide, "big") + bytes([k, block]), key=seed).digest() for block in range(-(-wide // 64)))
            left, right = right, left ^ int.from_bytes(noise[:wide], "big") % (1 << half)
        n = (left << half) + right
        if n < size:
            return n


@pytest.mark.parametrize("text", ["a", "Zz-09", "correct-horse7", "x" * 64, "x" * 65 + "-Q7", "aB3_" * 90])
def test_text_equals_plain_version(text):
    at = [(i, c) for i, ch in enumerate(text) for c in CLASSES if ch in c]
    digits, bases = [c.index(text[i]) for i, c in at], [len(c) for _, c in at]
    if len(at) <= 64:
        n = size = 0
        for d, b in zip(digits, bases):
            n, size = n * b + d, (size or 1) * b
        n = plain_number(n, size, b"key", "secret:" + "".join("9aA"[CLASSES.index(c)] for _, c in at))
        new = []
        for b in reversed(bases):
            n, d = divmod(n, b)
            new.insert(0, d)
    else:
        shape = hashlib.blake2b(bytes(CLASSES.index(c) for _, c in at)).hexdigest()
        new = plain_digits(digits, bases, b"key", f"secret:{shape}")
    want = list(text)
    for (i, c), d in zip(at, new):
        want[i] = c[d]
    assert pii.permute_text(text, b"key", "secret") == "".join(want)
    assert pii.permute_text("".join(want), b"key", "secret", back=True) == text


@pytest.mark.parametrize("bases", [[2, 3], [10], [3, 2, 4, 2], [5, 5, 5]])
def test_digit_strings_are_permuted(bases):
    size = int(np.prod(bases))
    every = [np.array(np.unravel_index(n, bases)) for n in range(size)]
    seen = {tuple(pii.permute_digits(d, np.array(bases), b"k", "t").tolist()) for d in every}
    assert len(seen) == size
    for d in every:
        there = pii.permute_digits(d, np.array(bases), b"k", "t")
        assert there.tolist() == plain_digits(d.tolist(), bases, b"k", "t")
        assert (pii.permute_digits(there, np.array(bases), b"k", "t", back=True) == d).all()


@pytest.mark.parametrize("alphabet", [string.ascii_letters + string.digits + "+/_-", "0123456789abcdef"])
def test_long_secrets_take_linear_time(alphabet):
    value = "".join(random.Random(3).choices(alphabet, k=1_000_000))
    began = time.perf_counter()
    new, n = pii.replace(f"x token={value} y", b"k")
    assert n == 1 and pii.replace(new, b"k", back=True) == (f"x token={value} y", 1)
    assert time.perf_counter() - began < 5
    assert new[:8] == "x token=" and len(new) == len(value) + 10 and [c.isdigit() for c in value[:50]] != [] and sum(a == b for a, b in zip(new[8:], value)) < 0.15 * len(value)
    if len(alphabet) == 16:
        assert set(new[8:-2]) <= set(alphabet)


def test_long_names_are_replaced_whole():
    rng = random.Random(5)
    for n in (1, 2, 63, 64, 65, 80, 3000):
        name = "".join(rng.choices(string.ascii_lowercase, k=n))
        new, found = pii.replace(f"to {name}@example.org", b"k")
        local = new[3 : -len("@example.org")]
        assert found == 1 and len(local) == n and (n < 60 or sum(a == b for a, b in zip(local[:16], name)) < 8)
        assert pii.replace(new, b"k", back=True)[0] == f"to {name}@example.org"
    assert pii.replace("-._abc@example.org", b"k")[0].startswith("-._")
    began = time.perf_counter()
    assert pii.replace("a." * 300_000 + " @", b"k")[1] == 0 and pii.replace("a@" * 100_000, b"k")[1] == 0
    assert time.perf_counter() - began < 10


def test_long_secret_in_a_table(spark):
    rows = [(1, "token=" + "a1B2" * 900), (2, None), (3, "token=" + "a1B2" * 900), (4, "plain words")]
    out = {r["doc_id"]: r for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), key=b"k").collect()}
    assert out[1]["text"] == out[3]["text"] != rows[0][1] and [out[k]["n_found"] for k in (1, 2, 3, 4)] == [1, 0, 1, 0]
