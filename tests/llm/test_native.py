"""The scans, fingerprints and mixes that are DataFrame expressions only, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripflow.llm import licenses, mixing, order_minhash

from .conftest import MESSY, make, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LICENSED = [
    (20, "x Released under the MIT License. Under the mit license!", "a"),
    (21, "Apache License, Version 2.0 and apache license version 20, apache licence version 2", "a"),
    (22, "CC BY-NC cc by nc CC-BY-NC 4.0", "a"),
    (23, "cc by-nc", "a"),
    (23, "cc by-nc", "a"),
    (24, "CC BY NC LıCENSE", "a"),
    (25, "under the mit", "a"),
    (26, licenses.TEMPLATES["gpl-notice"].replace("redistribute", "kindly redistribute").upper(), "a"),
    (27, words(3, 3000) + " under the mit license " + words(4, 10), "a"),
    (28, "K İ apacheK license version 2", "a"),
]


def base(text):
    line = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    found = [
        (at, label)
        for phrase, label in licenses.PHRASES.items()
        for at in range(len(line))
        if line[at : at + len(phrase.split())] == phrase.split()
    ]
    starts = [at for at, _ in found]
    return len(line), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_places_by_definition(spark, messy, nothing):
    rows = MESSY + LICENSED
    got = licenses.scan(make(spark, rows, clashing=True)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((r[0], *base(r[1])) for r in rows)
    by_id = {r.doc_id: r for r in got}
    assert "gpl-notice" in by_id[26].labels and by_id[26].base_labels == "" and licenses.COVERED <= by_id[26].score < 1
    assert "mit-line" in by_id[20].labels.split(",") and by_id[25].labels == ""
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert licenses.scan(nothing).count() == 0


def test_no_letter_outside_ascii_becomes_a_word(spark):
    letters = [chr(c) for c in range(0x80, 0x2FFF)]
    rows = spark.createDataFrame([(c, f"a{c}b") for c in letters], "c string, text string")
    got = {r.c: r.w for r in rows.select("c", licenses.words_of(F.col("text")).alias("w")).collect()}
    assert all(len(w) == 1 and not w[0].isascii() for w in got.values())


def edited(rows):
    """The edited text of each row, by descending id, equal ids by nothing that the test looks at."""
    order = sorted(rows, key=lambda r: -r[0])
    for at, r in enumerate(order):
        text, after = r[1] or "", order[(at + 1) % len(order)][1] or ""
        third = len(text) // 3
        yield r[0], text[: len(text) - third] + after[:third]


@pytest.mark.parametrize("n", [1, 2, 60])
def test_edited_texts_follow_descending_ids(spark, n):
    rows = [(i * i - 300, words(i, 5 + i) if i % 7 else None) for i in range(n)]
    got = {r.doc_id: r for r in order_minhash.fingerprints(make(spark, rows, clashing=True)).collect()}
    assert len(got) == n
    for doc_id, text in edited(rows):
        assert got[doc_id].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_messy_fingerprints(messy, nothing):
    got = order_minhash.fingerprints(messy).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in MESSY)
    assert order_minhash.fingerprints(nothing).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[9].fingerprint != by_id[8].fingerprint
    assert by_id[5].fingerprint == by_id[6].fingerprint == by_id[7].fingerprint == "" and by_id[6].near_edited == 1
    assert by_id[10].near_edited > 0 and by_id[11].near_edited > 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def signed(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.s for r in rows.select("i", order_minhash.signature(F.col("text")).alias("s")).orderBy("i").collect()]


def test_order_counts_and_repeats_are_numbered(spark):
    line = [f"w{i}" for i in range(400)]
    halves = " ".join(line[200:] + line[:200])
    one, other, doubled, again = signed(spark, [" ".join(line), halves, " ".join(line * 2), " ".join(line * 3)])
    alike = lambda a, b: len(set(a) & set(b)) / len({e >> 16 for e in a} | {e >> 16 for e in b})
    assert alike(one, one) == 1 and alike(one, other) < 0.75  # nearly the same set, in another order
    assert alike(one, doubled) < 0.5 and alike(doubled, again) > alike(one, again)
    assert all(len(s) == 64 for s in (one, other, doubled))


def slow_targets(sizes: dict, weights=(3, 1, 2)) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, capped = {s: weights[i % 3] for i, s in enumerate(order)}, set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        targets = {s: 2 * sizes[s] if s in capped else rest * weight[s] / total for s in order}
        more = {s for s in order if s not in capped and targets[s] > 2 * sizes[s]}
        if not more:
            return targets
        capped |= more


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 700)
    monkeypatch.setattr(mixing, "REGION", 2)
    draw = random.Random(6)
    rows = [(i, words(i, draw.choice((1, 5, 40, 900 if i % 9 == 0 else 60))), draw.choice(["big", "big", "big", "a", "é", None, "z"])) for i in range(300)]
    docs = make(spark, rows, clashing=True)
    got = mixing.mix(docs).collect()
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in mixing.mix(docs.repartition(7)).collect())
    source = {r[0]: r[2] for r in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    targets = slow_targets(sizes)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(targets[source[r.doc_id]])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.05 * targets[s] + 32
    made = Counter()
    for r in mixing.mixed_documents(docs).collect():
        assert r.text.strip() and r.n_chars == len(r.text) and (r.text in rows[r.doc_id][1])
        made[r.doc_id] += len(r.text.split())
    assert made == Counter({r.doc_id: r.taken for r in got if r.taken})


def test_mix_of_messy_and_empty_tables(messy, nothing):
    got = mixing.mix(messy).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in MESSY)
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    empty = mixing.mix(messy.where("doc_id in (5, 6, 7)")).collect()
    assert {(r.size, r.target, r.taken) for r in empty} == {(0, 0.0, 0)}


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 40, 333])
def test_apportionment_by_highest_quotients(spark, seats):
    draw = random.Random(seats)
    votes = {(g, m): float(draw.choice((0, 1, 5, 60, 1000))) for g in "ab" for m in range(9)}
    rows = [(g, m, v, seats) for (g, m), v in votes.items()]
    frame = spark.createDataFrame(rows, "g string, m int, votes double, seats long")
    got = {(r.g, r.m): r.quota for r in mixing.apportion(frame, ["g"], ["m"]).collect()}
    for g in "ab":
        quotients = sorted(((-votes[g, m] / (2 * j - 1), m) for m in range(9) for j in range(1, seats + 1) if votes[g, m]))[:seats]
        assert {m: got[g, m] for m in range(9)} == {m: sum(x == m for _, x in quotients) for m in range(9)}
