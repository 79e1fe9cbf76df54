import math
from fractions import Fraction

import numpy as np
import pytest

from layerspark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, count=4):
    """Rows and exact covariance by the definition, in fractions."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    cov = [[Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit), n**3) for b in range(dim)]
           for a in range(dim)]
    deviation = {tuple(x): sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in kept}
    return kept, n, sums, np.array([[float(v) for v in line] for line in cov]), deviation


def check(spark, rows, components=4):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=components).collect()
    kept, n, sums, cov, deviation = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, len(sums))
    assert len(got) == len(kept) * count
    assert {(r.n, r.identity_error) for r in got} == {(n, got[0].identity_error)}
    assert got[0].identity_error <= 1e-4
    table = {}
    for r in got:
        table.setdefault(r.vec_id, []).append(r)
    for key, x in kept:
        lines = sorted(table[key], key=lambda r: r.component)[:count]
        assert {int(r.deviation) for r in lines} == {deviation[tuple(x)]}
        for r, e in zip(lines, values):
            assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-9)
    # Signs are free but the same in all rows: compare products of two components and squares.
    mean = np.array([float(Fraction(s, n)) for s in sums])
    for key, x in kept:
        want = ((np.array(x) - mean) @ vectors[:, :count]) / np.sqrt(values[:count])
        lines = sorted(table[key], key=lambda r: r.component)[:count]
        assert np.abs([r.whitened for r in lines]) == pytest.approx(np.abs(want), rel=1e-6, abs=1e-7)
    return got


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 7)) @ rng.normal(size=(7, 7))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    # Copies count once in the fit list, and a key may repeat.
    got = check(spark, rows + [(200 + i, rows[0][1]) for i in range(70)])
    signs = {}
    for r in got:
        signs.setdefault(r.vec_id, {})[r.component] = r.whitened
    values = np.array([[signs[i][c] for c in range(1, 5)] for i in range(150)])
    assert np.abs(np.cov(values.T, bias=True) - np.eye(4)).max() < 1e-9


def test_fewer_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a) * 1e9, float(b) * 1e12]) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    check(spark, rows)


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 45, 1 << 60, 1 << 80])
def test_exact_square_sums(size):
    rng = np.random.default_rng(5)
    values = [[int(v * size) for v in line] for line in rng.uniform(-1, 1, (50, 3))]
    array = np.array(values, dtype=object if size > 1 << 61 else np.int64)
    assert [int(v) for v in whitening.square_sums(array)] == [sum(v * v for v in col) for col in zip(*values)]
    if size <= 1 << 60:
        assert [int(v) for v in whitening.column_sums(array)] == [sum(col) for col in zip(*values)]


def test_odd_rows(spark):
    good = [(1, [0.5, -1.0]), (1, [0.5, -1.0]), (None, [2.0, 0.25]), (3, [-1.0, 1.0])]
    bad = [(4, None), (5, []), (6, [None, 1.0]), (7, [math.nan, 1.0]), (8, [math.inf, 1.0]), (9, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(good + bad, SCHEMA)
    extra = table.selectExpr("*", "1 AS x", "2 AS w", "3 AS n", "4 AS i", "5 AS deviation", "6 AS dim")
    got = whitening.whiten(extra).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i or 0, c) for i, _ in good for c in (1, 2))
    assert {r.n for r in got} == {3}
    assert whitening.whiten(table.limit(0)).count() == 0


def test_no_variance(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got if r.whitened is not None} == {1}
    assert got[0].identity_error < 1e-9


def test_entries_beyond_a_long(spark):
    rows = [(0, [1e200, 1.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted({r.vec_id for r in got}) == [0, 1, 2] and all(r.identity_error < 1e-4 for r in got)
