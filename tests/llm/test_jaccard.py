from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripflow.llm import jaccard

from .conftest import MESSY, make


def slow_set(text: str | None) -> frozenset[bytes]:
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows: list[tuple], share: int = 90) -> Counter:
    """(doc_id, set size, smallest reachable id) of (doc_id, text) rows, by all pairs."""
    sets = [slow_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets)))


def found(docs, **options) -> Counter:
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(docs, **options).collect())


def edited(draw: random.Random, words: list[str], changes: int) -> list[str]:
    words = list(words)
    for _ in range(changes):
        at = draw.randrange(len(words) + 1)
        kind = draw.choice(("swap", "drop", "add"))
        if kind == "add" or at == len(words):
            words.insert(at, f"new{draw.randrange(10**6)}")
        elif kind == "drop" and len(words) > 1:
            del words[at]
        else:
            words[at] = f"new{draw.randrange(10**6)}"
    return words


def families(seed: int, sizes: list[int], copies: int, common: int = 0) -> list[tuple]:
    """Families of edited texts of several lengths, with a passage of ``common`` words that all share."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(common)]
    rows = []
    for size in sizes:
        base = [f"v{draw.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            words = edited(draw, base, draw.choice((0, 0, 1, 1, 2, max(1, size // 60), size // 30)))
            rows.append((len(rows) * 3 % 1009, " ".join(passage + words if draw.random() < 0.7 else words)))
    draw.shuffle(rows)
    return rows


def test_messy_rows_against_brute_force(messy):
    assert found(messy) == brute(MESSY)


def test_empty_table(nothing):
    got = jaccard.joined(nothing)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0


def test_families_against_brute_force(spark):
    rows = families(1, [3, 4, 8, 12, 13, 20, 21, 22, 25, 40, 60, 120, 300, 700], 8, common=6)
    assert found(make(spark, rows)) == brute(rows)


def test_a_passage_that_all_texts_share(spark):
    """Texts that are mostly one passage: some link, some fall just short of it."""
    draw = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(edited(draw, passage, draw.choice((0, 1, 1, 2, 2, 3)) ))) for i in range(150)]
    assert found(make(spark, rows), boundary=0) == brute(rows)


def test_components_that_no_hub_joins(spark):
    """A chain: each text is near the next only, so components have to grow over many lists."""
    draw = random.Random(3)
    words, rows = [f"c{i}" for i in range(100)], []
    for i in range(80):
        rows.append((500 - i, " ".join(words)))
        words = edited(draw, words, 1)
    rows += [(1000 + i, r[1] + " tail") for i, r in enumerate(rows[::7])]
    assert found(make(spark, rows)) == brute(rows)


def test_other_shares(spark):
    rows = families(4, [5, 10, 30, 80], 10)
    assert found(make(spark, rows), share=80) == brute(rows, 80)


def test_small_sets_link_only_by_enough_shared_shingles(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(edited(draw, [f"s{k}" for k in range(n)], draw.choice((0, 1, 1, 2))))) for i, n in enumerate([11, 12, 20, 21, 22, 23, 24] * 14)]
    assert found(make(spark, rows), boundary=24) == brute(rows)


def test_bounds_of_memory_change_nothing(spark, monkeypatch):
    rows = families(6, [30, 90, 200], 6, common=20)
    monkeypatch.setattr(jaccard, "SENT", 0)
    monkeypatch.setattr(jaccard, "CHUNK", 100)
    monkeypatch.setattr(jaccard, "COUNTED", 7)
    assert found(make(spark, rows)) == brute(rows)


def test_shingles_do_not_depend_on_slices(monkeypatch):
    texts = [r[1] or "" for r in MESSY] + ["A b  C\td", "a B c d", "", "x" * 300 + " y z w", "\x1c a\x1fb \x85 c"]
    column = pa.array([t.encode() for t in texts], pa.binary())
    whole = [s.tolist() for s in jaccard.shingle_sets(column)]
    assert [len(s) for s in whole] == [len(slow_set(t)) for t in texts]
    assert whole[-5] == whole[-4]
    for size in (1, 5, 50, 1000):
        monkeypatch.setattr(jaccard, "SLICE", size)
        assert [s.tolist() for s in jaccard.shingle_sets(column)] == whole
        assert [s.tolist() for s in jaccard.shingle_sets(column.slice(3, 6))] == whole[3:9]


def test_shingle_hashes_tell_words_apart():
    draw = random.Random(8)
    words = sorted({"".join(draw.choice("abAB01é") for _ in range(draw.randint(1, 9))).lower() for _ in range(20000)})
    assert len({int(jaccard.shingle_set(w)[0]) for w in words}) == len(words)
    assert jaccard.shingle_set("a b").tolist() != jaccard.shingle_set("b a").tolist()
    assert not set(jaccard.shingle_set("a b").tolist()) & set(jaccard.shingle_set("a b c").tolist())


def test_sizes_of_overlaps():
    for share in (80, 90):
        for s in range(1, 80):
            for t in range(s, 120):
                reach = [o for o in range(s + 1) if 100 * o >= share * (s + t - o)]
                assert (t in jaccard.partners(s, share)) == bool(reach)
                if reach:
                    assert jaccard.least_shared(s, t, share) == reach[0]
                    assert t - jaccard.probed(t, share) + 1 <= reach[0] and s - jaccard.indexed(s, share) + 1 <= reach[0]
                    assert (s, t, reach[0]) in jaccard.listings(s, share) and (s, t, reach[0]) in jaccard.listings(t, share)


def test_parity_never_exceeds_the_difference():
    draw = np.random.default_rng(9)
    for size in (100, 511, 512, 3000):
        base = draw.integers(0, 1 << 63, size).astype(np.uint64)
        for n in (0, 1, 5, 50):
            other = np.concatenate([base[n:], draw.integers(0, 1 << 63, n).astype(np.uint64)])
            apart = int(np.bitwise_count(jaccard.parity(np.unique(base)) ^ jaccard.parity(np.unique(other))).sum())
            assert apart <= 2 * n


def test_bitmaps_of_different_length_are_folded(spark):
    """Sets on both sides of a power of two have bitmaps of different length; no link is lost."""
    draw = random.Random(10)
    words = [f"x{i}" for i in range(1060)]
    rows = [(i, " ".join(edited(draw, words[: 990 + 6 * i], draw.choice((0, 1, 10))))) for i in range(12)]
    assert len({len(jaccard.parity(jaccard.shingle_set(t))) for _, t in rows}) == 2
    assert found(make(spark, rows)) == brute(rows)


def test_boundary_follows_the_costs():
    assert jaccard.choose_boundary({}, {}) == 0
    assert jaccard.choose_boundary({5: 10, 30: 1}, {5: 1000, 30: 50}) == 5
    assert jaccard.choose_boundary({5: 10}, {5: 3}) == 0


def test_digest_hash_is_sparks(spark):
    value = bytes(range(16))
    made = spark.createDataFrame([(value,)], "b binary").select(F.xxhash64("b")).first()[0]
    assert made == jaccard._spark_hash(value)
