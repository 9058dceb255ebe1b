"""Quality classifier: a factorisation machine over hashed words, structure statistics and the text's length.

score = sigmoid(bias + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pair sum is taken in
linear time as half of (sum of v_i x_i) squared minus the sum of (v_i x_i) squared. Labels, language,
source and id are never inputs. The model is fitted on a bounded sample of labelled rows in SHARDS
parts at a time, whose parameters are averaged after every round; it has a fixed size and is
broadcast. Every row is scored over its whole text.

Defined results: a null or empty text has no words and gets the score of its statistics; without any
labelled row every score is 0.5; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import Cache, by_batch, fold, labelled, text_rows
from tripflow.session import stage

BUCKETS = 1 << 15
FACTORS = 4
SHARDS = 8
ROUNDS = 4
#: The fit's bound on labelled rows.
FIT_ROWS = 12_000
RATE, DECAY = 0.1, 1e-5
THRESHOLD = 0.3
STATS = 14

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_WORDS = Cache(lambda word: zlib.crc32(word) % BUCKETS)


def statistics(text: bytes, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Structure of a text: lengths, shares of kinds of characters, repetition of words and lines."""
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, w = max(len(text), 1), max(len(words), 1)
    letters = int(byte[_LETTERS].sum())
    upper, digits = int(byte[65:91].sum()), int(byte[48:58].sum())
    spaces = int(byte[9:14].sum() + byte[32])
    lines = text.split(b"\n")
    return np.array(
        [
            np.log1p(len(text)),
            np.log1p(len(words)),
            n / w if words else 0,
            upper / max(letters, 1),
            digits / n,
            spaces / n,
            (n - letters - digits - spaces) / n,
            (n - letters - digits - spaces) / w,
            int(byte[124]) / w,
            int(byte[33]) / w,
            int(byte[128:].sum()) / n,
            np.count_nonzero(counts) / w,
            (counts.max() if len(counts) else 0) / w,
            1 - len(set(lines)) / len(lines),
        ],
        np.float64,
    )


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, values, statistics): word counts of unit length, and the structure of the text."""
    words = text.split()
    hashed = np.fromiter(map(_WORDS.__getitem__, words), np.int64, len(words))
    buckets, counts = np.unique(hashed, return_counts=True)
    values = np.sqrt(counts)
    return buckets, values / max(np.sqrt(counts.sum()), 1e-9), statistics(text, words, counts)


class Machine:
    """Parameters of the factorisation machine; statistics stand behind the word buckets."""

    def __init__(self, flat: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        size = BUCKETS + STATS
        self.flat, self.mean, self.spread = flat, mean, spread
        self.weight, self.factor = flat[1 : 1 + size], flat[1 + size :].reshape(size, FACTORS)

    def inputs(self, buckets: np.ndarray, values: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 2
        return np.concatenate([buckets, np.arange(BUCKETS, BUCKETS + STATS)]), np.concatenate([values, scaled])

    def sums(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The raw score, the sum of v_i x_i and the rows v_i of the inputs."""
        rows = self.factor[at]
        scaled = rows * x[:, None]
        total = scaled.sum(0)
        pairs = 0.5 * (total @ total - np.square(scaled).sum())
        return float(self.flat[0] + self.weight[at] @ x + pairs), total, rows

    def score(self, text: bytes) -> float:
        raw = self.sums(*self.inputs(*features(text)))[0]
        return float(1 / (1 + np.exp(-np.clip(raw, -50, 50))))


def start(mean: np.ndarray, spread: np.ndarray) -> Machine:
    size = BUCKETS + STATS
    flat = np.zeros(1 + size * (1 + FACTORS), np.float64)
    flat[1 + size :] = np.random.default_rng(7).normal(0, 0.05, size * FACTORS)
    return Machine(flat, mean, spread)


def learn(machine: Machine, rows: list[tuple]) -> np.ndarray:
    """One pass of per-coordinate gradient steps over (buckets, values, stats, label); the new parameters."""
    own = Machine(machine.flat.copy(), machine.mean, machine.spread)
    grown, factor_grown, bias_grown = np.full(BUCKETS + STATS, 1e-2), np.full(own.factor.shape, 1e-2), 1e-2
    for buckets, values, stats, label in rows:
        at, x = own.inputs(buckets, values, stats)
        raw, total, vectors = own.sums(at, x)
        error = 1 / (1 + np.exp(-np.clip(raw, -50, 50))) - label
        by_weight = error * x + DECAY * own.weight[at]
        by_factor = error * (x[:, None] * total - vectors * np.square(x)[:, None]) + DECAY * vectors
        grown[at] += np.square(by_weight)
        factor_grown[at] += np.square(by_factor)
        bias_grown += error * error
        own.weight[at] -= RATE * by_weight / np.sqrt(grown[at])
        own.factor[at] -= RATE * by_factor / np.sqrt(factor_grown[at])
        own.flat[0] -= RATE * error / np.sqrt(bias_grown)
    return own.flat


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Machine | None:
    """The machine fitted to at most ``rows`` labelled rows whose fold allows it; None without any."""
    sample = labelled(docs, labels, "quality", rows, fold("doc_id", 5) != 0)
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int")

    def featured(batch: dict) -> dict:
        made = [features(text) for text in batch["text"]]
        return {
            "doc_id": batch["doc_id"],
            "label": batch["label"],
            "shard": batch["shard"],
            "buckets": [m[0] for m in made],
            "rest": [m[1] for m in made],
            "stats": [m[2] for m in made],
        }

    schema = "doc_id long, label int, shard int, buckets array<int>, rest array<double>, stats array<double>"
    table = stage(by_batch(sample.select("doc_id", "label", "text", shard.alias("shard")), featured, schema), "quality-fit")
    each = table.select(F.posexplode("stats").alias("place", "value"))
    moments = each.groupBy("place").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("spread")).orderBy("place").collect()
    if not moments:
        return None
    machine = start(np.array([m["mean"] for m in moments]), np.array([max(m["spread"], 1e-6) for m in moments]))
    context = docs.sparkSession.sparkContext
    for _ in range(ROUNDS):
        shared = context.broadcast((machine.flat, machine.mean, machine.spread))

        def one(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("doc_id")
            columns = (part[c] for c in ("buckets", "rest", "stats", "label"))
            return pd.DataFrame({"flat": [learn(Machine(*shared.value), list(zip(*columns))).astype(np.float32).tobytes()]})

        parts = table.groupBy("shard").applyInPandas(one, "flat binary").collect()
        machine.flat[:] = np.mean([np.frombuffer(p["flat"], np.float32) for p in parts], axis=0)
    return machine


def scores(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id and score of every row of ``docs``."""

    def run(batch: dict, parameters: tuple | None) -> dict:
        own = Machine(*parameters) if parameters else None
        return {"doc_id": batch["doc_id"], "score": [own.score(t) if own else 0.5 for t in batch["text"]]}

    shared = docs.sparkSession.sparkContext.broadcast(machine and (machine.flat, machine.mean, machine.spread))
    return by_batch(text_rows(docs), run, "doc_id long, score double", shared)


def keep(docs: DataFrame, machine: Machine | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine and (machine.flat, machine.mean, machine.spread))

    def passing(batches):
        import pyarrow as pa

        own = Machine(*shared.value) if shared.value else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            chosen = [(own.score((t or "").encode()) if own else 0.5) >= threshold for t in texts]
            yield batch.filter(pa.array(chosen, pa.bool_()))

    return docs.mapInArrow(passing, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (no labels were learned from its fold), score and predicted for every row.

    A null id is never learned from and counts as held out.
    """
    scored = scores(docs, fit(docs, labels))
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))
