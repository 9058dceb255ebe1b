from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tripflow.llm import divergence

from .conftest import CLASHING, COLUMNS

ROW = ["lang", "source", "part", "item", "value", "rank"]


def brute(docs: list[tuple], least: int = 30, top: int = 50) -> list[tuple]:
    """The rows of (text, lang, source) by definition."""
    counts: dict = defaultdict(Counter)
    whole: dict = defaultdict(Counter)
    seen: dict = defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(found)
        whole[lang].update(found)
        seen[lang].update(set(found))
    out = []
    for lang, source in counts:
        kept = [t for t, d in seen[lang].items() if d >= least]

        def p(own, kept=kept):
            total = sum(own[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (own[t] + 5) // (total + 5 * len(kept)) for t in kept}

        mine, every = p(counts[lang, source]), p(whole[lang])
        pairs = [(sum(abs(mine[t] - x) for t, x in p(counts[lang, other]).items()), other) for lg, other in counts if lg == lang and other != source]
        liked = [(mine[t] - every[t], t) for t in kept if counts[lang, source][t] and mine[t] > every[t]]
        for part, found, limit in (("pair", pairs, None), ("term", liked, top)):
            ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:limit]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def prose(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    vocabulary = ["Alpha", "beta", "Größe", "größe", "İx", "naïve", "ＡＢ", "zeta", "q", "K", "🙂", "von", "zu"] + [f"w{c}" for c in "abcdefgh"]
    rows = []
    for _ in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(0, 30))]
        text = "".join(w + draw.choice([" ", "-", "'", ", ", "9", "\n", "\x7f", "[", "@"]) for w in words)
        rows.append((draw.choice([text, text, text, None, ""]), draw.choice(["en", "en", "de", None, ""]), draw.choice(["a", "b", "b", "é", "z\x00", None, ""])))
    return rows


def frame(spark, docs, extra=False):
    rows = [(i, t, lang, s, 0, *(["7"] * len(CLASHING) if extra else [])) for i, (t, lang, s) in enumerate(docs)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + ("".join(f", `{c}` string" for c in CLASHING) if extra else "")
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("cells", [1, divergence.CELLS])
def test_against_the_definition(spark, cells):
    docs = prose(1, 400) + [("solo Solo", "fr", "only"), (None, "fr", "none"), ("x", "it", "alone")]
    docs += [("rare words here and there", "nl", "a"), ("", "nl", "b")]
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, docs, extra=True), least_documents=10, cells=cells).collect())
    assert got == brute(docs, 10)


def test_only_the_best_terms_are_ranked(spark):
    docs = [(" ".join(f"t{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100) if (i + s) % 3), "en", f"s{s}") for s in (0, 1, 2) for _ in range(20)]
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, docs)).collect())
    assert got == brute(docs) and max(r[5] for r in got if r[2] == "term") == 50


def test_sql_against_the_definition(spark):
    docs = prose(2, 700)
    db = duckdb.connect()
    table = frame(spark, docs).toPandas()
    db.register("documents", table)
    made = sorted(tuple(r) for r in db.sql(f"SELECT {', '.join(ROW)} FROM ({divergence.ORACLE_SQL})").fetchall())
    assert made == brute(docs)
    assert any(r[2] == "term" for r in made)


def test_empty_table(spark, nothing):
    got = divergence.audit(nothing)
    assert got.columns == ROW and got.count() == 0


def test_long_texts_are_worked_off_in_pieces(monkeypatch):
    text = ("Grün-über, alles " * 50).encode()
    whole = list(divergence.terms(text))
    for size in (1, 3, 7, 100):
        monkeypatch.setattr(divergence, "PIECE", size)
        assert list(divergence.terms(text)) == whole
    monkeypatch.setattr(divergence, "PIECE", 5)
    assert list(divergence.terms(b"x" * 100)) == [b"x" * 100]


def test_full_tallies_are_handed_on_and_summed(spark, monkeypatch):
    docs = prose(3, 200)
    monkeypatch.setattr(divergence, "HELD", 3)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, docs), 10).collect()) == brute(docs, 10)


def test_trees_share_nodes_and_walks_price_pairs_once():
    draw = np.random.default_rng(1)
    counts = np.repeat(draw.integers(0, 2, (6, 1)), 64, 1)
    counts[:, :3] = draw.integers(0, 5, (6, 3))
    trees = divergence.Trees(counts)
    assert sum(trees.sizes[1:]) < 6 * 63 / 3
    pair, u, v, times = trees.leaf_pairs(np.array([0, 0, 1]), np.array([1, 2, 5]))
    assert times.sum() == 3 * 64 and len(times) < 3 * 10
    for i, (a, b) in enumerate([(0, 1), (0, 2), (1, 5)]):
        walked = Counter()
        for p, x, y, n in zip(pair, u, v, times):
            if p == i:
                walked[trees.counts[x], trees.counts[y]] += n
        assert walked == Counter(zip(counts[a].tolist(), counts[b].tolist()))


def test_counts_beyond_a_long_product():
    big = np.array([[10**13, 0, 7], [1, 10**12, 10**13]])
    totals = big.sum(1)
    (a, b, value), *_ = divergence.block_distances(big, totals, 3)
    def p(count, total):
        return 1 + 10**9 * (count + 5) // (total + 15)
    assert value.tolist() == [sum(abs(p(int(x), int(totals[0])) - p(int(y), int(totals[1]))) for x, y in zip(*big))]


def test_columns_of_documents_only(messy):
    assert set(COLUMNS) <= set(messy.columns)
    assert divergence.audit(messy).where("part = 'pair'").count() == 12
