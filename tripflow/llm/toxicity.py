"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Inputs are the presence of hashed single words, neighbouring pairs and pairs with one or two words
between; labels, language, source and id are never inputs. Every coordinate has its own rate, and
the L1 term holds most weights at exactly zero. Up to FIT_ROWS labelled rows are fitted in SHARDS
parts; the sums z and n of each coordinate are averaged by Spark over the parts that had rows (z and
n are 0 in a part without the coordinate), and only the nonzero weights, bounded by the bounded
sample, are broadcast. Every row is scored over its whole text.

Defined results: a null or empty text gets the score of the bias; without any labelled row every
score is 0.5; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import Cache, by_batch, fold, labelled, text_rows
from tripflow.session import stage

SHARDS = 8
EPOCHS = 8
#: The fit's bound on labelled rows.
FIT_ROWS = 20_000
ALPHA, BETA, L1, L2 = 3.0, 1.0, 2.0, 0.1
THRESHOLD = 0.7
BIAS = 0
GAPS = (1, 2, 3)
CHUNK = 1 << 18

_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
_WORDS = Cache(lambda word: xxhash.xxh3_64_intdigest(word))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def features(text: bytes):
    """Hashes of the n-grams and skip-grams, in parts of bounded size; repeats are left in."""
    words = text.translate(_FOLDED).split()
    for at in range(0, len(words), CHUNK):
        part = words[at : at + CHUNK + max(GAPS)]
        single = np.fromiter(map(_WORDS.__getitem__, part), np.uint64, len(part))
        own = single[:CHUNK]
        yield own | np.uint64(1)  # never the bias
        for gap in GAPS:
            first = single[: max(0, min(CHUNK, len(single) - gap))]
            second = single[gap : gap + len(first)]
            yield (first * _MIX[0] + second * _MIX[gap]) | np.uint64(1)


def present(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate([np.array([BIAS], np.uint64), *features(text)]))


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed form of the proximal step: zero within L1, else shrunk by it at the coordinate's rate."""
    return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(rows: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coordinate, z, n) of every present feature after EPOCHS passes over the rows."""
    keys, places = np.unique(np.concatenate(rows), return_inverse=True)
    rows = np.split(places, np.cumsum([len(r) for r in rows])[:-1])
    z, n = np.zeros(len(keys)), np.zeros(len(keys))
    for _ in range(EPOCHS):
        for at, label in zip(rows, labels):
            zs, ns = z[at], n[at]
            weight = weights_of(zs, ns)
            error = 1 / (1 + np.exp(-np.clip(weight.sum(), -50, 50))) - label
            rate = (np.sqrt(ns + error * error) - np.sqrt(ns)) / ALPHA
            z[at] = zs + error - rate * weight
            n[at] = ns + error * error
    return keys, z, n


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray] | None:
    """(coordinates ascending, nonzero weights), the bias first; None without labelled rows."""
    sample = labelled(docs, labels, "toxic", rows, fold("doc_id", 3) != 1)
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int")

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "text"])
        keys, z, n = learn([present(t) for t in part["text"]], part["label"].tolist())
        return pd.DataFrame({"key": keys.view(np.int64), "z": z, "n": n})

    parts = sample.select("doc_id", "label", "text", shard.alias("shard")).groupBy("shard")
    sums = stage(parts.applyInPandas(one, "key long, z double, n double"), "toxicity-fit")
    had = sums.where(F.col("key") == BIAS).count()  # every part with rows has the bias once
    if not had:
        return None
    # A mean beyond L1 needs a part beyond L1: only the coordinates of such a part are summed. All come from FIT_ROWS rows.
    beyond = (F.abs("z") > L1) | (F.col("key") == BIAS)
    candidates = sums.where(beyond).select("key").distinct()
    summed = sums.join(F.broadcast(candidates), "key", "left_semi").groupBy("key").agg((F.sum("z") / had).alias("z"), (F.sum("n") / had).alias("n"))
    found = summed.where(beyond).collect()
    keys = np.array([r["key"] for r in found], np.int64).view(np.uint64)
    weights = weights_of(np.array([r["z"] for r in found]), np.array([r["n"] for r in found]))
    order = np.argsort(keys)
    return keys[order], weights[order]


def score(text: bytes, keys: np.ndarray, weights: np.ndarray) -> float:
    """Sigmoid of the bias and the weights of the distinct present features."""
    found = [np.zeros(0, np.int64)]
    for hashes in features(text):
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        found.append(np.unique(at[keys[at] == hashes]))
    used = np.unique(np.concatenate(found))
    raw = weights[used].sum() + weights[keys == BIAS].sum()
    return float(1 / (1 + np.exp(-np.clip(raw, -50, 50))))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (no labels were learned from its fold), score and predicted for every row.

    A null id is never learned from and counts as held out.
    """

    def run(batch: dict, model: tuple | None) -> dict:
        return {"doc_id": batch["doc_id"], "score": [score(t, *model) if model else 0.5 for t in batch["text"]]}

    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    scored = by_batch(text_rows(docs), run, "doc_id long, score double", model)
    held = F.coalesce(fold("doc_id", 3) == 1, F.lit(True))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))
