from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from tripflow.llm import quality, toxicity

from .conftest import MESSY, make, words

BAD = ["vile", "rotten", "dreadful", "nasty"]


def corpus(n: int) -> tuple[list[tuple], list[tuple]]:
    """Documents and (doc_id, quality, toxic): every fifth shouted junk, every fourth with bad words."""
    draw, docs, labels = random.Random(8), [], []
    for i in range(n):
        line = words(i, 60).split()
        junk, toxic = i % 5 == 0, i % 4 == 1
        if toxic:
            line[draw.randrange(60)] = draw.choice(BAD)
            line[draw.randrange(60)] = draw.choice(BAD)
        docs.append((i, " ".join(w.upper() + "!!" for w in line) if junk else " ".join(line)))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(600)
    return make(spark, docs, clashing=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize("module, of, fold, least", [(quality, 1, (5, 0), 0.98), (toxicity, 2, (3, 1), 0.95)])
def test_held_out_accuracy(tables, module, of, fold, least):
    docs, labels, rows = tables
    truth = {r[0]: r[of] for r in rows}
    got = module.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1])
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= least


@pytest.mark.parametrize("module, fold", [(quality, (5, 0)), (toxicity, (3, 1))])
def test_labels_of_the_held_out_fold_change_nothing(tables, module, fold, spark):
    docs, labels, rows = tables
    flipped = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % fold[0] == fold[1] else (i, q, t) for i, q, t in rows]
    other = spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")
    scores = [{r.doc_id: round(r.score, 9) for r in module.classify(docs, x).collect()} for x in (labels, other)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_messy_rows_and_labels(spark, messy, nothing, module):
    labels = [(1, 1, 0), (1, 0, 1), (2, 0, 1), (None, 1, 1), (5, None, None), (8, 1, 0), (11, 7, 7), (12, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = module.classify(messy, table).collect()
    assert len(rows) == len(MESSY) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert module.classify(nothing, table).count() == 0
    assert {r.score for r in module.classify(messy, table.limit(0)).collect()} == {0.5}


def test_pair_sum_equals_all_pairs():
    draw = np.random.default_rng(1)
    machine = quality.start(np.zeros(quality.STATS), np.ones(quality.STATS))
    machine.weight[:] = draw.normal(size=len(machine.weight))
    at, x = draw.choice(quality.BUCKETS, 9, replace=False), draw.normal(size=9)
    v = machine.factor[at]
    slow = machine.flat[0] + machine.weight[at] @ x + sum(v[i] @ v[j] * x[i] * x[j] for i in range(9) for j in range(i))
    assert machine.sums(at, x)[0] == pytest.approx(slow)


def test_keeping_changes_no_column(tables):
    docs, labels, rows = tables
    kept = quality.keep(docs, quality.fit(docs, labels))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, q, _ in rows if q} <= ids and len(ids) < 500


def test_long_texts_give_the_features_of_short_parts(monkeypatch):
    text = words(5, 900).encode()
    whole = toxicity.present(text)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    assert np.array_equal(toxicity.present(text), whole)


def test_proximal_weights_are_zero_within_the_bound():
    z, n = np.array([0.5, -toxicity.L1, 3.0, -5.0]), np.array([1.0, 4.0, 4.0, 4.0])
    weights = toxicity.weights_of(z, n)
    assert weights[0] == weights[1] == 0 and weights[2] < 0 < weights[3]


def plain_ftrl(rows: list[set], labels: list[int]) -> dict[int, tuple[float, float]]:
    """z and n of every coordinate, one row and one coordinate at a time."""
    sums: dict[int, tuple[float, float]] = {}

    def weight(key):
        z, n = sums.get(key, (0.0, 0.0))
        if abs(z) <= toxicity.L1:
            return 0.0
        return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for row, label in zip(rows, labels):
            weights = {key: weight(key) for key in row}
            g = 1 / (1 + math.exp(-sum(weights.values()))) - label
            for key, w in weights.items():
                z, n = sums.get(key, (0.0, 0.0))
                sums[key] = z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA * w, n + g * g
    return sums


def learnable(docs, labels):
    """(text, toxic) of the rows that may be learned from, in the fit's order."""
    toxic = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    return [(i, text.encode(), toxic[i]) for i, text in docs if i in toxic]


@pytest.mark.parametrize("shards", [1, 3])
def test_fit_is_the_mean_of_plain_ftrl_over_the_parts_with_rows(spark, shards):
    docs, labels = corpus(90)
    rows = learnable(docs, labels)
    ids = spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long").selectExpr("doc_id", f"pmod(xxhash64(doc_id, 'shard'), {shards}) AS part").collect()
    part_of = {r.doc_id: r.part for r in ids}
    parts = [[r for r in rows if part_of[r[0]] == part] for part in sorted(set(part_of.values()))]
    sums = [plain_ftrl([set(toxicity.present(t).tolist()) for _, t, _ in part], [y for *_, y in part]) for part in parts]
    want = {}
    for key in set().union(*sums):
        z, n = (sum(s.get(key, (0.0, 0.0))[i] for s in sums) / len(sums) for i in (0, 1))
        if abs(z) > toxicity.L1 or key == toxicity.BIAS:
            want[key] = float(toxicity.weights_of(np.array([z]), np.array([n]))[0])
    keys, weights = toxicity.fit(make(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), shards=shards)
    assert set(keys.tolist()) == set(want)
    assert np.allclose(weights, [want[k] for k in keys.tolist()], atol=1e-9)


def test_a_single_toxic_row_is_learned_from(spark):
    """One row gives two coordinates that occur once; parts without rows take no share of the mean."""
    keys, weights = toxicity.fit(make(spark, [(0, "vile rotten")]), spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int"))
    assert len(keys) == 4 and (weights > 0).all()
