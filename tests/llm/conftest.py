"""Small documents with every kind of defect that the operators define a result for."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

#: Names that operators use inside; documents may have columns of these names too.
CLASHING = ["fingerprint", "score", "label", "row", "hash", "size", "n", "part", "place", "mark", "words", "block", "_row", "shard"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(["lorem", "ipsum", "dolor", "sit", "amet", "Élan", "ünd", "x1", "a", "of"]) + draw.choice(["", "", ",", "s"]) for _ in range(n))


def make(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if clashing:
        full = [(*r, *["7"] * len(CLASHING)) for r in full]
        schema += "".join(f", `{c}` string" for c in CLASHING)
    return spark.createDataFrame(full, schema)


MESSY = [
    (1, words(1, 40), "b"),
    (2, words(2, 300), "a"),
    (2, words(2, 300), "a"),
    (2, words(3, 20), None),
    (None, words(4, 30), "c"),
    (None, None, None),
    (5, None, "a"),
    (6, "", "a"),
    (7, " \t\n ", "b"),
    (8, "one", "b"),
    (9, words(1, 40), None),
    (10, "y" * 5000, "c"),
    (11, words(11, 6000), "c"),
    (12, "naïve ＡＢ İ K 🙂🙂 '’s don't", "b"),
]


@pytest.fixture(scope="session")
def messy(spark):
    return make(spark, MESSY, clashing=True)


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [])
