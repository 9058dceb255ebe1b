from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tripflow.llm import brown

from .conftest import MESSY, make


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def slow_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base) by the definition."""
    held = [r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    counts = Counter(t for r, h in zip(rows, held) if not h for t in tokens(r[1]))
    total, types = sum(counts.values()), len(counts)
    for r, h in zip(rows, held):
        line = tokens(r[1])
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in line)
        yield r[0], h, len(line), sum(counts[t] > 0 for t in line), total, round(base, 6)


def rounded(rows):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.mark.parametrize("sent", [1 << 18, 3])
def test_base_of_messy_rows_by_definition(messy, monkeypatch, sent):
    monkeypatch.setattr(brown, "SENT", sent)
    monkeypatch.setattr(brown.frequent, "__defaults__", (sent,))
    monkeypatch.setattr(brown, "ROUNDS", 1)
    monkeypatch.setattr(brown.exchange, "__defaults__", (1,))
    got = brown.score(messy).collect()
    assert rounded(got) == Counter(slow_base(MESSY))
    assert all(math.isfinite(r.score) for r in got)


def two_languages(n):
    draw = random.Random(4)
    left, right = [f"le{i}a" for i in range(60)], [f"zu{i}b" for i in range(60)]
    return [(i, " ".join(draw.choices((left, right)[i % 2], k=60))) for i in range(n)]


def test_classes_beat_the_base_on_held_out_texts(spark):
    rows = brown.score(make(spark, two_languages(1500))).where("held_out").collect()
    model, base = (sum(r[c] for r in rows) / sum(r.n_tokens for r in rows) for c in ("score", "base_score"))
    assert model > base + 0.2  # knowing the language is worth log10(2) a word


def test_scores_are_a_distribution_over_known_and_unknown_words(spark):
    rows = two_languages(60)
    texts = make(spark, rows).selectExpr("cast(text as binary) AS text")
    counts = brown.count_words(texts).cache()
    model = brown.train(counts, texts)
    found = counts.collect()
    vocabulary = brown.Vocabulary(model.hashes, model.forms.copy(), model.counts)
    unit = dict(zip(model.hashes.tolist(), vocabulary.units.tolist()))
    end = brown.word_hash(brown.END_WORD)
    classes = {r["hash"]: brown.CLASSES if r["hash"] == end else int(model.classes[unit[r["hash"]]]) for r in found}
    for before in (0, brown.CLASSES, classes[found[0]["hash"]]):
        step = 10 ** model.steps[before]
        emitted = np.zeros(brown.CLASSES + 1)
        for r in found:
            emitted[classes[r["hash"]]] += 10 ** (np.log10(r["n"] + 0.5) - model.spread[classes[r["hash"]]])
        emitted += 10 ** (np.log10(0.5) - model.spread)  # the unknown word of each class
        assert step.sum() == pytest.approx(1) and emitted == pytest.approx(1)


def test_gain_is_the_change_of_the_likelihood():
    draw = np.random.default_rng(3)
    units, kinds = 12, 4
    pairs = draw.integers(0, 6, (units, units)).astype(float)
    classes = draw.integers(0, kinds, units)

    def likelihood(of):
        matrix = np.zeros((kinds, kinds))
        np.add.at(matrix, (of[:, None], of[None, :]), pairs)
        return (brown.xlogx(matrix).sum() - brown.xlogx(matrix.sum(0)).sum() - brown.xlogx(matrix.sum(1)).sum()), matrix

    for unit in range(units):
        start, matrix = likelihood(classes)
        itself = pairs[unit, unit]
        after = np.bincount(classes, pairs[unit], kinds)
        before = np.bincount(classes, pairs[:, unit], kinds)
        after[classes[unit]] -= itself
        before[classes[unit]] -= itself
        gain = brown.gains(matrix, classes[unit], after, before, itself)
        for to in range(kinds):
            moved = classes.copy()
            moved[unit] = to
            assert gain[to] - gain[classes[unit]] == pytest.approx(likelihood(moved)[0] - start, abs=1e-6)


def test_nothing_to_train_on_and_no_rows(spark, nothing):
    assert brown.score(nothing).count() == 0
    only_held = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    assert {r.n_known for r in brown.score(make(spark, only_held)).collect()} == {0}
