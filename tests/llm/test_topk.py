from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tripflow.llm import topk


def brute(rows, k=5, every=50):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q in {i for i, _ in sound if i % every == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for j, v in sound if j == q for i, w in sound if i != q and len(w) == len(v)]
        out.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k]))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def got(spark, rows):
    return Counter(tuple(r) for r in topk.search(table(spark, [(i, v, 0, "x") for i, v in rows])).collect())


def vectors(n, width, seed, values=None):
    draw = random.Random(seed)
    return [(i, [float(np.float32(draw.choice(values) if values else draw.gauss(0, 0.3))) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("values", [None, (0.0, 0.5, -0.25)])
def test_against_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(topk, "BLOCK", 90)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rows = vectors(330, 6, 1, values)
    assert got(spark, rows) == brute(rows)


def test_messy_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(120, 3, 2) + [(0, [0.5, 0.5, 0.5]), (50, None), (100, []), (None, [1.0, 0.0, 0.0]), (200, [1.0, None, 0.0])]
    rows += [(250, [nan, 0.0, 0.0]), (300, [inf, 0.0, 1.0]), (350, [0.25, 0.25]), (351, [0.5, 0.5]), (400, [1.0]), (7, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:3]) == brute(rows[:3]) and got(spark, []) == Counter()


def test_one_vector_repeated_very_often(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rows = [(i, v if i % 3 else [0.5, -0.5, 0.25]) for i, v in vectors(300, 3, 4)]
    assert got(spark, rows) == brute(rows)


def test_reading_stops_before_the_end_and_loses_nothing():
    draw = np.random.default_rng(2)
    matrix = draw.integers(-20, 20, (4000, 8))
    matrix[:40] *= 6
    lists, queries = topk.Lists(matrix), draw.integers(-20, 20, (30, 8)).astype(float)
    found = lists.best(queries, 5)
    scores = matrix @ queries.T
    for at, rows in enumerate(found):
        bar = np.sort(scores[:, at])[-5]
        assert set(np.flatnonzero(scores[:, at] >= bar)) <= set(rows.tolist())
    assert np.median([len(rows) for rows in found]) < 400


@pytest.mark.parametrize("large", [8e6, 9e6, 1e12])
def test_large_components_are_exact_and_drop_no_row(spark, large):
    rows = vectors(160, 4, 6)
    draw = random.Random(7)
    # One axis each for queries and candidates, so that no score leaves the longs: large times small, with close scores.
    rows += [(1000 + 50 * i, [large + 1024 * i, 0.0, 0.25, 0.0]) for i in range(3)]
    rows += [(2001 + i, [0.5 + draw.randrange(9) / 256, large, draw.randrange(9) / 256, 0.0]) for i in range(30)]
    if large < 1e9:
        rows += [(3001 + i, [large + 0.5 * i, 0.0, draw.randrange(9) / 256, 0.0]) for i in range(30)]
        rows += [(4050, [large, large, 0.0, 0.0])]
    else:
        rows = [(i, v) for i, v in rows if i not in (1050, 1100)]
    want = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    assert got(spark, rows) == want and any(q == 1000 for q, *_ in want)


def test_bounds_widened_by_rounding_lose_nothing():
    draw = np.random.default_rng(3)
    matrix = np.floor(draw.normal(0, 2.0**30, (900, 7)))
    matrix[draw.integers(0, 900, 200)] = matrix[0] + draw.integers(0, 3, (200, 7))
    queries = np.floor(draw.normal(0, 2.0**29, (12, 7)))
    queries[0], queries[1] = 1e300, queries[1] * 2.0**40
    lists = topk.Lists(matrix)
    for at, rows in enumerate(lists.best(queries, 5)):
        scores = [sum(int(a) * int(b) for a, b in zip(row, queries[at])) for row in matrix]
        bar = sorted(scores)[-5]
        assert {i for i, s in enumerate(scores) if s >= bar} <= set(rows.tolist())
        assert lists.exact(rows, queries[at]).tolist() == [scores[i] for i in rows]


def test_a_score_beyond_a_long_is_an_error():
    lists = topk.Lists(np.array([[2.0**40, 1], [2.0**41, 0], [1, 1]]))
    with pytest.raises(OverflowError):
        topk.resolved(np.arange(3), lists, 50, np.array([2.0**40, 0]), np.arange(3), 2)
