"""Whitening against a dense eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import SF
from trailmark.llm import whitening
from trailmark.llm.queries import QUERIES

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
TYPES = ["int", "bigint", "bigint", "double", "double", "double"]


def check(rows, got, components=4, scale=256):
    """All properties of the contract, from the rows (id, vector)."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in ok), default=0)
    x = np.array([[math.floor(scale * float(c)) for c in v] + [0] * (width - len(v)) for _, v in ok], dtype=object).reshape(len(ok), width)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(fit), [sum(c) for c in fit.T]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    centred = fit.astype(float) - mean
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    m = min(components, int((e > e[0] * width * 2.3e-16).sum()))
    assert len(got) == len(ok) * m
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    sign = {}
    for (i, v), row in zip(ok, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        mine = by_id[i, deviation if deviation < 2**63 else None]
        assert sorted(mine) == list(range(1, m + 1))
        for j in range(m):
            want = float((row.astype(float) - mean) @ u[:, j] / math.sqrt(e[j]))
            near = [r["whitened"] for r in mine[j + 1]]
            if abs(want) > 1e-6:
                sign.setdefault(j, 1 if abs(near[0] - want) < abs(near[0] + want) else -1)
            assert min(abs(z - sign.get(j, 1) * want) for z in near) < 1e-7 * max(1, abs(want)), (i, j)
            assert all(r["n"] == n and abs(r["explained"] - e[j] / e.sum()) < 1e-10 and r["identity_error"] < 1e-9 for r in mine[j + 1])


def typed(df):
    assert df.columns == COLUMNS and [t for _, t in df.dtypes][1:] == TYPES
    return df.collect()


@pytest.mark.parametrize("width, rank", [(1, 1), (2, 1), (7, 7), (60, 60), (250, 250), (40, 3)])
def test_eigenpairs(width, rank):
    rng = np.random.default_rng(width)
    q = np.linalg.qr(rng.standard_normal((width, rank)))[0]
    # Close together, the third twice.
    values = np.sort(np.concatenate([[1.01, 1.001, 1.0, 1.0, 0.9999], rng.random(rank) ** 0.2])[:rank])[::-1]
    a = (q * values) @ q.T
    found, vectors = whitening.leading_pairs(lambda b: a @ b, width, 4)
    m = min(4, rank)
    assert np.allclose(found, values[:m], rtol=1e-13) and found.shape == (m,)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(m)).max() < 1e-13


def test_a_pair_the_start_misses_is_found():
    """The start is blind to one axis, which carries the largest value."""
    width = 50
    a = np.diag(np.linspace(1, 2, width))
    a[0, 0] = 9.0
    seen = []

    def multiply(b):
        seen.append(b.shape[1])
        return a @ b

    class Blind:
        def __init__(self):
            self.rng = np.random.default_rng(1)
            self.calls = 0

        def standard_normal(self, shape):
            self.calls += 1
            out = self.rng.standard_normal(shape)
            if self.calls == 1:
                out[0] = 0.0
            return out

    found, _ = whitening.leading_pairs(multiply, width, 4, Blind())
    assert abs(found[0] - 9) < 1e-12 and abs(found[1] - 2) < 1e-12


def test_minres_solves():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    q = np.linalg.qr(rng.standard_normal((12, 2)))[0]
    right = rng.standard_normal(12)
    solver = whitening._Minres(0.3, right, q)
    while solver.live:
        solver.step(a @ solver.v)
    p = np.eye(12) - q @ q.T
    assert np.linalg.norm(p @ (a - 0.3 * np.eye(12)) @ p @ solver.solution - p @ right) < 1e-3 * np.linalg.norm(right)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, typed(QUERIES["op12_jacobi_davidson_whitening"](spark, SF)))


SCHEMA = "vec_id bigint, embedding array<float>, dim int, n string, component double"


def frame(spark, pairs):
    return spark.createDataFrame([(i, v, 1, "n", 0.5) for i, v in pairs], SCHEMA)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(5).astype(np.float32).tolist()) for i in range(60)]
    rows += rows[:7] + rows[:7] + [(None, rows[3][1]), (None, None), (90, None), (91, [1.0, None, 2.0, 0.0, 0.0]), (92, [nan] * 5), (93, [inf, 0.0, 0.0, 0.0, 0.0])]
    rows += [(94, []), (95, [1.0, -0.0]), (96, [-0.0] * 5)]
    check(rows, typed(whitening.op12_query(frame(spark, rows))))


def test_no_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, []), (2, [])], [(1, [0.001]), (2, [0.002])]):
        assert typed(whitening.op12_query(frame(spark, rows))) == []


def test_few_dimensions_and_rows(spark):
    check([(1, [1.0]), (2, [2.0]), (3, [4.0])], typed(whitening.op12_query(frame(spark, [(1, [1.0]), (2, [2.0]), (3, [4.0])]))))
    rows = [(1, [1.0, 0.0, 3.0, 1.0, 1.0]), (2, [2.0, 1.0, 0.0, 0.0, 7.0]), (3, [0.5, 0.5, 0.5, 0.5, 2.0])]
    check(rows, typed(whitening.op12_query(frame(spark, rows))))


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i) * 1e7, 1.0, float(i % 3)]) for i in range(30)] + [(99, [1e15, 0.0, 0.0])]
    got = typed(whitening.op12_query(frame(spark, rows)))
    check([(i, np.array(v, np.float32).tolist()) for i, v in rows], got)
    assert any(r["deviation"] is None for r in got)
