"""Quality scores: statistics by brute force, the fit's parts, held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.conftest import SF
from tests.llm.conftest import LONG, TEXTS, doc
from trailmark.llm import quality
from trailmark.llm.queries import QUERIES

COLUMNS = ["doc_id", "held_out", "score", "predicted"]


def slow_statistics(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    high = lambda c: ord(c) > 127
    letter = lambda c: high(c) or c.isalpha()
    spaces, common = " \t\n\r\x0b\f", ".,;:!?'\"()-"
    share = lambda a, b: a / max(b, 1)
    lines = [x for x in text.split("\n") if x]
    sizes = [len(w) for w in words]
    plain = sum(c.isalpha() for c in text if not high(c))
    counts = Counter(words)
    pairs = list(zip(words, words[1:]))
    raw = text.encode()
    p = np.array([n / len(raw) for n in Counter(raw).values()]) if raw else np.ones(1)
    # The last byte of a word, as a character below 128 or part of one beyond.
    end = [w.encode()[-1] for w in words]
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), share(sum(sizes), len(words)), np.log1p(max(sizes, default=0)),
        np.std(sizes) if sizes else 0, share(sum(map(letter, text)), len(text)), share(sum("A" <= c <= "Z" for c in text), plain),
        share(sum("0" <= c <= "9" for c in text), len(text)), share(sum(c in common for c in text), len(text)),
        share(sum(not letter(c) and not "0" <= c <= "9" and c not in spaces and c not in common for c in text), len(text)),
        share(sum(c in spaces for c in text), len(text)), share(sum(map(high, text)), len(text)), -(p * np.log2(p)).sum(),
        share(sum(not (e > 127 or chr(e).isalnum()) for e in end), len(words)),
        share(sum(chr(e) in ".!?" and any(map(letter, w)) for e, w in zip(end, words)), len(words)),
        share(sum(not any(map(letter, w)) for w in words), len(words)), share(sum("A" <= w[0] <= "Z" for w in words), len(words)),
        share(sum(len(w) > 1 and any(map(letter, w)) and not any(high(c) or "a" <= c <= "z" for c in w) for w in words), len(words)),
        share(len(counts), len(words)), share(max(counts.values(), default=0), len(words)), share(sum(a == b for a, b in pairs), len(words)),
        share(len(set(pairs)), len(pairs)), share(len(set(lines)), len(lines)), np.log1p(share(len(words), len(lines))),
    ]


def test_statistics_by_brute_force(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + TEXTS + ["\n", "\n\na\n", " a", "a ", "\x00\x7f \u0085 b"]
    got = quality.statistics(pa.array(texts))
    want = np.array([slow_statistics(t) for t in texts])
    assert got.shape == want.shape == (len(texts), len(quality.STATISTICS))
    for i, name in enumerate(quality.STATISTICS):
        assert np.abs(got[:, i] - want[:, i]).max() < 1e-9, name
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 25))
    z = quality.fourier(x, np.zeros(25), np.ones(25), 20_000)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(2)
    kernel = np.exp(-far / (2 * (quality.BANDWIDTH**2 * 25)))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_ridge_and_left_out_error_from_sums():
    rng = np.random.default_rng(4)
    z = np.column_stack([rng.standard_normal((300, 6)), np.ones(300)])
    y = (z[:, 0] + 0.3 * rng.standard_normal(300) > 0).astype(float)
    fold = np.arange(300) % 5
    a = np.column_stack([z, y])
    folds = {f: a[fold == f].T @ a[fold == f] for f in range(5)}
    error = 0.0
    for f in range(5):
        train, shrink = z[fold != f], np.diag([0.01 * (fold != f).sum()] * 6 + [0.0])
        w = np.linalg.solve(train.T @ train + shrink, train.T @ y[fold != f])
        assert np.allclose(w, quality.ridge(sum(folds.values()) - folds[f], 0.01))
        error += ((y[fold == f] - z[fold == f] @ w) ** 2).sum()
    assert np.isclose(error, quality.left_out_error(folds, 0.01))


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(6)
    for _ in range(50):
        n = int(rng.integers(1, 12))
        weight = rng.integers(1, 5, n).astype(float)
        good = np.array([rng.integers(0, w + 1) for w in weight], float)
        raw, level = quality.isotonic(np.arange(n, dtype=float), good, weight)
        assert (np.diff(level) > 0).all() and (np.diff(raw) > 0).all()
        # The fit at a place is the largest over its beginnings of the least mean up to an end.
        mean = lambda a, b: good[a:b].sum() / weight[a:b].sum()
        best = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(sorted(set(np.round(best, 12))), level)


def by_id(df):
    assert df.columns == COLUMNS and [t for _, t in df.dtypes][1:] == ["boolean", "double", "int"]
    rows = df.collect()
    for r in rows:
        crc = zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode())
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (crc % 5 == 0)
    return rows


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    rows = by_id(QUERIES["op13_fourier_quality"](spark, sf))
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = [p for q, p in held if q == 1], [p for q, p in held if q == 0]
    assert len(held) > 50 and sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_labels_held_out_and_metadata_do_not_count(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    first = sorted(map(tuple, by_id(quality.op13_query(docs, labels))))
    flipped = [(r["doc_id"], 1 - r["quality"] if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 else r["quality"]) for r in labels.collect()]
    other = spark.createDataFrame(flipped + [(None, 0), (10**9, 0)], "doc_id bigint, quality int")
    blind = docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source", "0 as quality", "1 as label", "2 as h")
    assert sorted(map(tuple, by_id(quality.op13_query(blind, other)))) == first


LABELS = "doc_id bigint, quality int, text string, stats int"


def test_odd_rows(spark, odd, empty, frame):
    labels = spark.createDataFrame([(i, i % 2, "t", 1) for i in range(14)] + [(2, 1, "t", 1), (None, 1, "t", 1), (3, None, None, None)], LABELS)
    assert sorted(str(r["doc_id"]) for r in by_id(quality.op13_query(odd, labels))) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert by_id(quality.op13_query(empty, labels)) == []
    for none in (spark.createDataFrame([], LABELS), spark.createDataFrame([(1, None, "", 0)], LABELS)):
        assert {r["score"] for r in by_id(quality.op13_query(odd, none))} == {0.5}
    single = spark.createDataFrame([(1, 1, "t", 1), (2, 1, "t", 1)], LABELS)
    assert {r["score"] for r in by_id(quality.op13_query(odd, single))} == {1.0}
    same = by_id(quality.op13_query(frame([doc(7, LONG), doc(7, LONG), doc(8, LONG)]), single))
    assert len({r["score"] for r in same}) == 1
