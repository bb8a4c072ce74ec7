"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.conftest import doc
from trailmark.llm import periodic
from trailmark.llm.queries import QUERIES


def all_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            a = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i - a + p >= max(12, 2 * p):
                found.setdefault((a, i + p), p)
    return sorted((a, e - a, p) for (a, e), p in found.items())


def expected(doc_id, text):
    """The contract's row, by the letter."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *first, sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    assert df.columns == COLUMNS
    assert [t for c, t in df.dtypes if c in COLUMNS[1:6]] == ["bigint"] * 5
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_small_alphabets():
    random.seed(11)
    for _ in range(150):
        texts = []
        for _ in range(random.randint(1, 6)):
            n, v = random.choice([0, 1, 11, 12, 13, 40, 130, 600]), random.choice([1, 2, 2, 3, 40])
            w = [random.randrange(v) for _ in range(n)]
            if n > 20 and random.random() < 0.6:
                a = random.randrange(n)
                p = 1 + random.randrange(max(1, (n - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        got = periodic.find_runs([np.array(t, np.int64) for t in texts])
        assert [[tuple(map(int, r)) for r in g] for g in got] == [all_runs(t) for t in texts]


def test_transform_is_exact():
    rng = np.random.default_rng(3)
    for n in (8, 16, 64, 4096):
        a, b = rng.integers(0, periodic.PRIME, (2, 3, n))
        got = periodic._backward(periodic._fold(periodic._forward(a.copy()) * periodic._forward(b.copy())), n) % periodic.PRIME
        for x, y, z in zip(a, b, got):
            full = np.zeros(2 * n, object)
            for i in range(n) if n <= 64 else rng.integers(0, n, 5):
                full[i:i + n] += int(x[i]) * y.astype(object)
            if n <= 64:
                assert [(int(u) + int(v)) * n % periodic.PRIME for u, v in zip(full[:n], full[n:])] == z.tolist()


def test_chance_zeros_do_no_harm():
    """Words that differ by the prime look alike to the transform only."""
    p = periodic.PRIME
    text = np.array([1, 2, 3, 4] * 5 + [1 + p, 2, 3, 4] + [1, 2, 3, 4] * 5, np.int64)
    got = periodic.find_runs([text, text % p])
    assert [[tuple(map(int, r)) for r in g] for g in got] == [all_runs(list(text)), all_runs(list(text % p))]


def test_long_repeats_are_cheap():
    n = 150_000
    broken = np.r_[np.zeros(n, np.int64), 1, np.zeros(n, np.int64)]
    assert [tuple(r) for r in periodic.find_runs([broken])[0]] == [(0, n, 1), (n + 1, n, 1)]
    cycle = np.tile(np.arange(70_000), 3)[:180_000]  # a period beyond the widest block
    assert [tuple(r) for r in periodic.find_runs([cycle])[0]] == [(0, 180_000, 70_000)]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    short = [(i, t) for i, t in pairs if len((t or "").split()) <= 3000]
    want = sorted((expected(i, t) for i, t in short), key=repr)
    assert any(w[1] for w in want) and len(want) >= 0.95 * len(pairs)
    got = rows_of(QUERIES["op11_periodic_runs"](spark, SF))
    ids = {i for i, _ in short}
    assert [g for g in got if g[0] in ids] == want and len(got) == len(pairs)


def test_odd_rows(spark, odd, empty, frame):
    got = rows_of(periodic.op11_query(odd))
    pairs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    short = [(i, t) for i, t in pairs if len(t or "") < 100_000]
    want = [expected(i, t) for i, t in short]
    assert len(got) == len(pairs)
    for w in want:
        assert w in got
    assert rows_of(periodic.op11_query(empty)) == []
    spaced = "\x0b a b\x0c\x1c c " * 8 + " x\x1fy" * 13  # only six bytes part words
    rows = [doc(i, spaced) for i in range(40)] + [doc(None, "z " * 30), doc(7, None)]
    assert rows_of(periodic.op11_query(frame(rows))) == sorted((expected(r[0], r[1]) for r in rows), key=repr)


@pytest.mark.parametrize("text, runs, collapsed", [
    ("a " * 12, [(0, 12, 1)], "a"), ("a " * 11, [], "a a a a a a a a a a a"), ("x " + "a b " * 6 + "a y", [(1, 13, 2)], "x a b y"),
])
def test_operator(frame, text, runs, collapsed):
    row = periodic.periodic_runs(frame([doc(1, text)])).collect()[0]
    assert ([tuple(r) for r in row["runs"]], row["collapsed"], row["n_words"]) == (runs, collapsed, len(text.split()))
