from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tripflow.llm import whitening


def covariance_of(seed: int, scales: list[float], mixed: bool = True) -> np.ndarray:
    draw = np.random.default_rng(seed)
    d = len(scales)
    q = np.linalg.qr(draw.standard_normal((d, d)))[0] if mixed else np.eye(d)
    made = q @ np.diag(scales) @ q.T
    return (made + made.T) / 2


SPECTRA = {
    "spread": [10.0 ** (-i / 4) for i in range(40)],
    "close": [1 + 1e-6 * i for i in range(40)],
    "equal": [3.0] * 20 + [2.0] * 3 + [1.0] * 20,
    "one large": [1e9, *[1 + i / 50 for i in range(39)]],
    "singular": [5.0, 4.0, 3.0, *[0.0] * 30],
    "single": [7.0],
    "all the same": [2.0] * 25,
    "random": list(np.random.default_rng(5).gamma(1.0, 4.0, 64)),
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("mixed", [True, False])
def test_leading_components_against_a_dense_solver(name, mixed):
    matrix = covariance_of(1, SPECTRA[name], mixed)
    values, vectors = whitening.leading(matrix, 32)
    expected = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    rank = int((expected > 1e-12 * expected[0]).sum())
    assert len(values) == min(32, rank)
    assert np.allclose(values, expected[: len(values)], rtol=1e-6 if name == "one large" else 1e-10, atol=1e-13 * expected[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * expected[0]


def test_inertia_counts():
    matrix = covariance_of(2, SPECTRA["random"])
    values = np.linalg.eigvalsh(matrix)
    for shift in (-1.0, 0.5, 3.0, float(values[10] + values[11]) / 2, 1e3):
        assert whitening.eigenvalues_above(matrix, shift) == int((values > shift).sum())
    assert whitening.eigenvalues_above(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1
    assert whitening.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


def test_intervals_are_apart_and_hold_what_they_count():
    matrix = covariance_of(3, SPECTRA["spread"])
    values = np.linalg.eigvalsh(matrix)
    found = sorted(whitening.intervals(matrix, 32))
    assert all(b <= c for (_, b, _), (c, _, _) in zip(found, found[1:]))
    assert all(((values > a) & (values < b)).sum() == n for a, b, n in found)


def test_exact_products_of_large_numbers():
    draw = np.random.default_rng(4)
    entries = draw.integers(-(1 << 50), 1 << 50, (50, 3))
    entries[7] = [-(1 << 61), 1 << 61, 5]
    whole = entries.astype(object)
    assert (whitening.exact_gram(entries) == whole.T @ whole).all()
    assert (whitening.exact_gram(np.zeros((0, 2), np.int64)) == 0).all()


def expected_rows(vectors: list[tuple], wanted: int = 32):
    """Exact sums in fractions, components by a dense solver."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    whole = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept]
    n = len(whole)
    sums = [sum(column) for column in zip(*whole)]
    deviations = [d if d < 1 << 63 else None for d in (sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in whole)]
    centred = [[Fraction(n * x - s, n) for x, s in zip(row, sums)] for row in whole]
    matrix = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(width)] for i in range(width)])
    return kept, n, deviations, np.array([[float(c) for c in r] for r in centred]), matrix


def check(spark, vectors, kind="float"):
    frame = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>")
    got = whitening.components_of(frame).collect()
    kept, n, deviations, centred, matrix = expected_rows(vectors)
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(32, int((values > 1e-11 * values[0]).sum()))
    assert len(got) == len(kept) * k
    by_row: dict = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and r.identity_error <= 1e-6
        assert r.explained == pytest.approx(values[r.component - 1] / matrix.trace(), rel=1e-6)
    whitened = centred @ axes[:, :k] / np.sqrt(values[:k])
    for (key, _), deviation, own in zip(kept, deviations, whitened):
        rows = sorted(by_row[(key, deviation)], key=lambda r: r.component)
        assert {r.component for r in rows} == set(range(1, k + 1))
        if len(rows) == k:
            assert sum(r.whitened**2 for r in rows) == pytest.approx(float((own**2).sum()), rel=1e-6)
            gaps = [i for i in range(k) if all(abs(values[i] - values[j]) > 1e-3 * values[i] for j in range(len(values)) if j != i)]
            for i in gaps:
                assert abs(rows[i].whitened) == pytest.approx(abs(own[i]), rel=1e-4, abs=1e-5)


def test_against_fractions(spark):
    draw = np.random.default_rng(6)
    vectors = [(i, (draw.standard_normal(40) * (1 + np.arange(40)) / 8).astype(np.float32).tolist()) for i in range(120)]
    vectors += [(200, None), (201, [None] + [1.0] * 39), (202, [float("nan")] * 40), (203, [float("inf")] + [0.0] * 39)]
    vectors += [vectors[3], (None, vectors[4][1]), (204, [0.5] * 7), (205, [])]
    check(spark, vectors)


def test_large_and_far_off_entries(spark):
    draw = np.random.default_rng(7)
    vectors = [(i, (1e6 + 100 * draw.standard_normal(5)).tolist()) for i in range(50)] + [(99, [3e7, -2e7, 0.0, 1.0, 5.0])]
    vectors = [(i, np.float32(v).tolist()) for i, v in vectors]
    check(spark, vectors)


def test_a_deviation_beyond_a_long_is_null(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 5.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.components_of(frame).collect()}
    assert set(got) == {1, 2, 3} and got[1] is None


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.components_of(spark.createDataFrame(rows, schema))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0


def test_other_columns_are_ignored(spark):
    schema = "vec_id long, embedding array<float>, label int, n string, component string, whitened string, at string"
    rows = [(i, [float(i % 3), float(i % 5)], 0, "n", "c", "w", "a") for i in range(15)]
    assert whitening.components_of(spark.createDataFrame(rows, schema)).count() == 30
