from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash

from tripflow.llm import components, simhash

from .conftest import COLUMNS, MESSY, make


def slow_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes) and hashes)


def slow_components(marks: list[int]) -> list[int]:
    """The first index that each index reaches over links of at most four bits."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(marks))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_messy_rows_against_brute_force(messy):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(messy).collect())
    marks = [slow_fingerprint(r[1]) for r in MESSY]
    roots = slow_components(marks)
    least = {}
    for row, root in zip(MESSY, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    assert got == Counter((r[0], f"{m:016x}", least.get(root)) for r, m, root in zip(MESSY, marks, roots))


def chain(seed: int, steps: int) -> list[int]:
    """Fingerprints each a few bits from the last, and some far ones."""
    draw, out = random.Random(seed), []
    mark = draw.getrandbits(64)
    for _ in range(steps):
        out.append(mark)
        for bit in draw.sample(range(64), draw.choice((1, 3, 4, 5, 20))):
            mark ^= 1 << bit
    return list(dict.fromkeys(out))


def linked(spark, marks: list[int]) -> set[tuple]:
    frame = spark.createDataFrame([(signed(m),) for m in marks], "mark long")
    return {tuple(r) for r in components.smallest_reachable(simhash.links(frame)).collect()}


def wanted(marks: list[int]) -> set[tuple]:
    roots = slow_components(marks)
    groups = {}
    for mark, root in zip(marks, roots):
        groups.setdefault(root, []).append(signed(mark))
    return {(m, min(g)) for g in groups.values() if len(g) > 1 for m in g}


def test_chains_of_links(spark):
    marks = chain(1, 80) + chain(2, 40)
    assert linked(spark, marks) == wanted(marks)


def test_crowded_postings_give_the_same_components(spark, monkeypatch):
    draw = random.Random(9)
    centre = draw.getrandbits(64)
    marks = list(dict.fromkeys(centre ^ sum({1 << b for b in draw.sample(range(64), draw.randint(0, 7))}) for _ in range(150)))
    expected = wanted(marks)
    assert linked(spark, marks) == expected
    monkeypatch.setattr(simhash, "PAIRED", 4)
    assert linked(spark, marks) == expected
    monkeypatch.setattr(simhash, "SENT", 0)
    assert linked(spark, marks) == expected


def test_one_row_of_each_group_with_its_columns(spark, messy, nothing):
    kept = simhash.one_of_each(messy)
    assert kept.columns == messy.columns
    roots = slow_components([slow_fingerprint(r[1]) for r in MESSY])
    assert kept.count() == len(set(roots))
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 9 not in ids  # 9 has the text of 1
    assert simhash.one_of_each(nothing).count() == 0 and simhash.near_duplicates(nothing).count() == 0
    assert kept.select("text").where("n <> '7'").count() == 0 and set(COLUMNS) <= set(kept.columns)


def test_very_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == whole == signed(slow_fingerprint(text.decode()))
    assert np.int64(whole) == whole


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)] + [(7, 7)]
    frame = spark.createDataFrame(path + star, "a long, b long")
    got = {tuple(r) for r in components.smallest_reachable(frame).collect()}
    assert got == {(i, 100) for i in range(100, 141)} | {(i, 500) for i in range(500, 560)}
