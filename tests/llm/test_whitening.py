"""Whitening against eigenvectors of a covariance matrix added up in Python's whole numbers."""

import math

import numpy as np
import pytest

from tripledger.llm import whitening


def plain(vectors):
    """Whole numbers, exact deviations, eigenvalues and eigenvectors of the remaining vectors."""
    kept = [v for v in vectors if v is not None and all(
        c is not None and math.isfinite(c) for c in v)]
    d = max(map(len, kept), default=0)
    rows = [[math.floor(1024 * c) + 100_000 for c in [*v, *[0.0] * (d - len(v))]] for v in kept]
    n = len(rows)
    sums = [sum(r[j] for r in rows) for j in range(d)]
    apart = [[n * r[j] - sums[j] for j in range(d)] for r in rows]
    squares = [sum(a * a for a in row) for row in apart]
    centred = np.array([[float(a) / n for a in row] for row in apart])
    values, axes = np.linalg.eigh(centred.T @ centred / max(n, 1))
    return n, squares, values[::-1], axes[:, ::-1].T, centred


def check(spark, vectors, kind="double", tolerance=1e-9, k=None):
    table = spark.createDataFrame([(i, v, i) for i, v in enumerate(vectors)],
                                  f"vec_id long, embedding array<{kind}>, component int").repartition(5)
    rows = whitening.whitened(table).collect()
    n, squares, values, axes, centred = plain(vectors)
    ids = [i for i, v in enumerate(vectors) if v is not None and all(
        c is not None and math.isfinite(c) for c in v)]
    k = k or min(8, int((values > 1e-9 * values.max()).sum()))
    assert sorted((r.vec_id, r.component) for r in rows) == [(i, c) for i in ids for c in range(1, k + 1)]
    by_row = {(r.vec_id, r.component): r for r in rows}
    for c in range(1, k + 1):
        y = centred @ axes[c - 1] / math.sqrt(values[c - 1])
        got = np.array([by_row[i, c].whitened for i in ids])
        assert min(abs(got - y).max(), abs(got + y).max()) < tolerance * abs(y).max() + 1e-8
        assert by_row[ids[0], c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-6)
    for i, square in zip(ids, squares):
        assert {r.deviation for r in rows if r.vec_id == i} == {square if square < 1 << 63 else None}
    assert {r.n for r in rows} == {n}
    assert all(r.identity_error < 1e-6 for r in rows) and len({r.identity_error for r in rows}) == 1
    return rows


def vectors(n, d, seed=1, spread=3.0):
    draw = np.random.default_rng(seed)
    mix = draw.normal(size=(d, d)) * np.exp(-spread * np.arange(d) / d)
    return (draw.normal(size=(n, d)) @ mix + draw.normal(size=d)).tolist()


def test_components_equal_the_covariance(spark):
    given = vectors(300, 12)
    given[3:3] = [None, [0.0] * 5 + [None] + [0.0] * 6, [math.nan] * 12, [math.inf, *[1.0] * 11]]
    given += given[:40]
    check(spark, given)
    check(spark, [[float(np.float32(c)) for c in v] for v in vectors(80, 20, 2)], "float")


def test_missing_directions_and_short_vectors(spark):
    given = [[a, b, a + b, 1.0, a] for a, b in vectors(50, 2, 3)]
    given = [[math.floor(1024 * c) / 1024 for c in v[:2]] for v in given]
    given = [[a, b, a + b, 1.0, 2 * a] for a, b in given]
    assert {r.component for r in check(spark, given)} == {1, 2}
    check(spark, [v[:2 + i % 3] for i, v in enumerate(vectors(60, 4, 4))])
    check(spark, [[1.0, 2.0, 3.0], [2.0, 1.0, 0.0]])


def test_wide_range_of_variances(spark):
    """The smallest of eight components has a variance of 1e-11 of the largest."""
    draw = np.random.default_rng(6)
    axes = np.linalg.qr(draw.normal(size=(8, 8)))[0]
    given = (draw.normal(size=(200, 8)) * 10.0 ** -np.linspace(-4, 1.5, 8) @ axes).tolist()
    check(spark, given, tolerance=1e-4, k=8)


def test_large_numbers(spark):
    rows = check(spark, [[c * 1e6 for c in v] for v in vectors(60, 3, 5)])
    assert rows[0].deviation is None or rows[0].deviation > 0


def test_nothing_to_whiten(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)],
                 [(1, [math.nan]), (None, [None])]):
        found = whitening.whitened(spark.createDataFrame(rows, kind))
        assert found.collect() == [] and found.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    alone = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 2.0])], kind)
    assert {r.vec_id for r in whitening.whitened(alone).collect()} == {None}
