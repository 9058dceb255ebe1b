"""Brown class-based n-grams: exchange clustering of words, then class transitions times word emissions.

    p(text) = product over tokens of p(class | class before) * p(word | class)

Tokens are lower-cased words and one end per text; a text begins after an end. Word counts cover all
training texts. What is clustered are units: the TOP most frequent words, each its own unit, and
FORMS units that every other word falls into by its ending, so every word has a class and the
clustering has a fixed size however large the vocabulary grows. The neighbour counts of units are
summed over all training texts. In a round of the exchange every unit of one third computes, from
its neighbours' classes and the class matrix, the gain in log likelihood of each class it could move
to, and moves to the best; units are spread over tasks, only assignments and class matrices meet on
the driver. The end is a class of its own.

Emissions and base share the add-half estimate, so the count of a word is all that scoring needs:
counts of up to SENT frequent words are broadcast, the other words of a text are joined to the full
table by hash. Words are identified by 64-bit hashes.

Defined results: a null or empty text is its end; repeated rows get equal rows; a null id is not
trained on and counts as held out; without training texts both scores are sums of log10(1) and class
terms of one class; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import Cache, fold, slices, text_rows
from tripflow.session import stage

#: Words with counts that are broadcast (16 bytes each), words that are units of their own, units of endings.
SENT = 1 << 18
TOP = 4096
FORMS = 1024
UNITS = TOP + FORMS
END = UNITS
CLASSES = 64
ROUNDS = 12
HALF = 0.5
FOLDS, HELD = 5, 1
END_WORD = b"\n"  # no word holds white space
#: Distinct words, and neighbouring units, that a task holds before it hands on their counts.
WORDS_HELD, UNITS_HELD = 1 << 18, 3 << 20
#: Tasks over which the units are spread.
UNIT_TASKS = 24


def word_hash(word: bytes) -> int:
    """The word's hash as a signed number."""
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def form_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % FORMS


def count_words(texts: DataFrame) -> DataFrame:
    """(hash, form, n) of every word of ``texts`` and of the end, counted inside each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(counts)
            columns = [[word_hash(w) for w in words], [form_of(w) for w in words], list(counts.values())]
            counts.clear()
            kinds = (pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["hash", "form", "n"])

        for batch in batches:
            for part in slices(batch, 1 << 22):
                for text in part.column("text").to_pylist():
                    counts.update(text.lower().split())
                counts[END_WORD] += part.num_rows
                if len(counts) >= WORDS_HELD:
                    yield flush()
        if counts:
            yield flush()

    each = texts.select("text").mapInArrow(run, "hash long, form int, n long")
    return each.groupBy("hash").agg(F.min("form").alias("form"), F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = SENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes ascending, forms and counts of the words above the count threshold that at most ``most`` words reach."""
    step = F.floor(8 * F.log2("n")).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # a few hundred steps
    total, least = 0, None
    for size in sizes:
        total += size["count"]
        if total > most:
            break
        least = size["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = counts.where(step >= least).select("hash", "form", "n").toArrow()
    columns = [table.column(c).to_numpy().astype(np.int64) for c in ("hash", "form", "n")]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


class Vocabulary:
    """Numbers words: a frequent word by its place in the sorted hashes, any other word as -1 - form."""

    def __init__(self, hashes: np.ndarray, forms: np.ndarray, counts: np.ndarray):
        self.hashes, self.counts = hashes, counts
        self.units = TOP + forms
        top = np.lexsort((hashes, -counts))
        top = top[hashes[top] != word_hash(END_WORD)][:TOP]
        self.units[top] = np.arange(len(top))
        self.cache = Cache(self._number, 400_000)

    def _number(self, word: bytes) -> int:
        key = word_hash(word)
        at = int(np.searchsorted(self.hashes, key))
        return at if at < len(self.hashes) and self.hashes[at] == key else -1 - form_of(word)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))

    def units_of(self, numbers: np.ndarray) -> np.ndarray:
        out = TOP - 1 - numbers
        known = numbers >= 0
        out[known] = self.units[numbers[known]]
        return out


def neighbours(texts: DataFrame, vocabulary) -> DataFrame:
    """(left, right, n): how often units stand next to each other, ends included, over all ``texts``."""
    width = UNITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = Vocabulary(*vocabulary.value), [], 0

        def flush() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(n.astype(np.int32))], ["pair", "n"])

        for batch in batches:
            for part in slices(batch, 1 << 22):
                for text in part.column("text").to_pylist():
                    units = own.units_of(own.numbers(text.lower().split()))
                    line = np.concatenate([[END], units, [END]])
                    held.append((line[:-1] * width + line[1:]).astype(np.int32))
                    size += len(line)
                if size >= UNITS_HELD:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    each = texts.select("text").mapInArrow(run, "pair int, n int")
    summed = each.groupBy("pair").agg(F.sum("n").alias("n"))
    left = F.floor(F.col("pair") / width).cast("int")
    return summed.select(left.alias("left"), (F.col("pair") % width).alias("right"), "n")


def contexts(pairs: DataFrame) -> DataFrame:
    """One row for each unit: the units after and before it with their counts, never more than there are units."""
    after = pairs.groupBy(F.col("left").alias("unit")).agg(F.collect_list(F.struct("right", "n")).alias("after"))
    before = pairs.groupBy(F.col("right").alias("unit")).agg(F.collect_list(F.struct("left", "n")).alias("before"))
    both = after.join(before, "unit", "full")
    return both.select(
        "unit",
        F.col("after.right").alias("next_unit"),
        F.col("after.n").alias("next_n"),
        F.col("before.left").alias("last_unit"),
        F.col("before.n").alias("last_n"),
    )


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row in range(batch.num_rows):
            values = [batch.column(c)[row] for c in ("next_unit", "next_n", "last_unit", "last_n")]
            arrays = [v.values.to_numpy() if v.is_valid else np.zeros(0, np.int64) for v in values]
            yield batch.column("unit")[row].as_py(), *arrays


def first_classes(table: DataFrame) -> np.ndarray:
    """A start: each unit joins the frequent unit, one for each class, that follows it most beyond chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, after, n, before, m in _rows(batches):
            weight = np.zeros(CLASSES)
            seen = (after < CLASSES, n), (before < CLASSES, m)
            for (some, counts), units in zip(seen, (after, before)):
                np.add.at(weight, units[some], counts[some])
            columns = [pa.array([unit]), pa.array([int(m.sum())]), pa.array([weight.tolist()])]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "n", "weight"])

    rows = table.mapInArrow(run, "unit long, n long, weight array<double>").collect()
    classes = np.zeros(UNITS + 1, np.int64)
    if rows:
        units = np.array([r["unit"] for r in rows])
        weight = np.array([r["weight"] for r in rows])
        expected = weight.sum(1, keepdims=True) * weight.sum(0) / max(weight.sum(), 1)
        lift = weight * np.log((weight + 1) / (expected + 1))
        classes[units] = np.where(weight.sum(1) > 0, lift.argmax(1), units % CLASSES)
    classes[END] = CLASSES
    return classes


def class_matrix(table: DataFrame, classes) -> np.ndarray:
    """How often one class follows another, summed inside each task first."""
    size = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for unit, after, n, _, _ in _rows(batches):
            total[classes.value[unit]] += np.bincount(classes.value[after], n, size)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["matrix"])

    parts = table.mapInArrow(run, "matrix binary").collect()
    return sum((np.frombuffer(p["matrix"]).reshape(size, size) for p in parts), np.zeros((size, size)))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def gains(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, itself: float) -> np.ndarray:
    """The change of log likelihood when a unit of class ``own`` joins each class, up to a constant.

    ``after`` and ``before`` count the classes of its neighbours without itself, which follows itself
    ``itself`` times.
    """
    rest = matrix.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] -= itself
    plain = xlogx(rest)
    rows, columns = xlogx(rest + after) - plain, xlogx(rest + before[:, None]) - plain
    diagonal = np.diag(rest)
    gain = rows.sum(1) - np.diag(rows) + columns.sum(0) - np.diag(columns)
    gain += xlogx(diagonal + after + before + itself) - np.diag(plain)
    # Wherever the unit goes, the classes before and after it keep its neighbours among their totals.
    lefts, rights = rest.sum(1) + before, rest.sum(0) + after
    gain -= xlogx(lefts + after.sum() + itself) - xlogx(lefts)
    return gain - (xlogx(rights + before.sum() + itself) - xlogx(rights))


def likelihood(matrix: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes."""
    return float(xlogx(matrix).sum() - xlogx(matrix.sum(0)).sum() - xlogx(matrix.sum(1)).sum())


def exchange(table: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class by unit, class matrix) after rounds in which a third of the units, in turn, move to their best class.

    A task moves its units one after the other on a matrix of its own. Tasks do not see each other's
    moves, so a round counts only if the likelihood of all moves together, or else of the half or the
    quarter that gains most, has grown.
    """
    context = table.sparkSession.sparkContext
    classes = first_classes(table)
    matrix = class_matrix(table, context.broadcast(classes))
    for at in range(rounds):
        shared = context.broadcast((classes, matrix))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, total = (x.copy() for x in shared.value)
            units, best, gained = [], [], []
            for unit, after, n, before, m in _rows(batches):
                if unit == END or (unit * 2654435761 >> 7) % 3 != at % 3:
                    continue
                own = of[unit]
                itself = float(n[after == unit].sum())
                right = np.bincount(of[after], n, CLASSES + 1)
                left = np.bincount(of[before], m, CLASSES + 1)
                right[own] -= itself
                left[own] -= itself
                gain = gains(total, own, right, left, itself)[:CLASSES]
                to = int(gain.argmax())
                if gain[to] > gain[own] + 1e-6:
                    for place, sign in ((own, -1), (to, 1)):
                        total[place] += sign * right
                        total[:, place] += sign * left
                        total[place, place] += sign * itself
                    of[unit] = to
                    units.append(unit)
                    best.append(to)
                    gained.append(float(gain[to] - gain[own]))
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((units, best, gained), kinds)], ["unit", "best", "gain"])

        moves = table.mapInArrow(run, "unit long, best long, gain double").collect()
        moves.sort(key=lambda r: (-r["gain"], r["unit"]))
        for part in (1, 2, 4):
            some = moves[: len(moves) // part]
            tried = classes.copy()
            tried[[r["unit"] for r in some]] = [r["best"] for r in some]
            grown = class_matrix(table, context.broadcast(tried)) if some else matrix
            if likelihood(grown) > likelihood(matrix):
                classes, matrix = tried, grown
                break
    return classes, matrix


@dataclass
class Model:
    """What scoring needs: the frequent words, the class of every unit, class terms and totals."""

    hashes: np.ndarray
    forms: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    steps: np.ndarray
    spread: np.ndarray
    tokens: int
    types: int
    ends: int


def train(counts: DataFrame, texts: DataFrame) -> Model:
    """The model of ``texts`` (column text), whose word counts are the written table ``counts``."""
    spark = texts.sparkSession
    context = spark.sparkContext
    words = frequent(counts)
    shared = context.broadcast(words)
    table = stage(contexts(stage(neighbours(texts, shared), "lm-pairs")).repartition(UNIT_TASKS), "lm-contexts")
    classes, matrix = exchange(table)

    vocabulary = Vocabulary(*words)
    tops = np.flatnonzero(vocabulary.units < TOP)
    named = [(int(words[0][i]), int(classes[vocabulary.units[i]])) for i in tops] + [(word_hash(END_WORD), CLASSES)]
    own = F.broadcast(spark.createDataFrame(named, "hash long, own int"))  # TOP + 1 rows
    by_form = F.array(*[F.lit(int(c)) for c in classes[TOP:UNITS]])
    kind = F.coalesce("own", F.get(by_form, F.col("form")))
    sums = counts.join(own, "hash", "left").groupBy(kind.alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    spread = np.zeros(CLASSES + 1)
    for row in sums:
        spread[row["class"]] = row["n"] + HALF * row["types"]
    likely = (matrix.sum(0) + 1) / (matrix.sum() + CLASSES + 1)
    steps = np.log10((matrix + 2 * likely) / (matrix.sum(1, keepdims=True) + 2))
    tokens, types = sum(r["n"] for r in sums), sum(r["types"] for r in sums)
    ends = sum(r["n"] for r in sums if r["class"] == CLASSES)  # the end's class holds nothing else
    return Model(*words, classes, steps, np.log10(spread + HALF), int(tokens), int(types), int(ends))



def _parts(texts: DataFrame, model) -> DataFrame:
    """For each text what its broadcast words and classes give, and the hashes and counts of its other words."""
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "rare array<struct<hash:long,n:int>>"
    )
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        own = Vocabulary(m.hashes, m.forms.copy(), m.counts)
        known_log = np.log10(m.counts + HALF)
        floor = np.log10(m.tokens + HALF * (m.types + 1))
        for batch in batches:
            for part in slices(batch, 1 << 22):
                made: list[list] = [[], [], [], [], []]
                for text in part.column("text").to_pylist():
                    words = text.lower().split()
                    numbers = own.numbers(words)
                    classes = np.concatenate([[CLASSES], m.classes[own.units_of(numbers)], [CLASSES]])
                    some = numbers[numbers >= 0]
                    both = known_log[some].sum() + np.log10(m.ends + HALF)
                    rare = Counter(w for w, at in zip(words, numbers.tolist()) if at < 0) if len(some) < len(words) else {}
                    made[0].append(len(words) + 1)
                    made[1].append(len(some) + (m.ends > 0))
                    made[2].append(both - floor * (len(words) + 1))
                    made[3].append(both + m.steps[classes[:-1], classes[1:]].sum() - m.spread[classes[1:]].sum())
                    made[4].append([{"hash": word_hash(w), "n": n} for w, n in rare.items()])
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), kind)
                arrays = [pa.array(c, k) for c, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), *arrays],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
                )

    return texts.mapInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``, trained on the rows outside the held-out fold."""
    held = F.coalesce(fold("doc_id", FOLDS) == HELD, F.lit(True))
    texts = text_rows(docs).withColumn("held_out", held)
    train_on = texts.where("NOT held_out")
    counts = stage(count_words(train_on), "lm-counts")
    model = train(counts, train_on)
    parts = _parts(texts, docs.sparkSession.sparkContext.broadcast(model))
    parts = stage(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")

    rare = parts.select("row", F.explode("rare").alias("word")).select("row", "word.hash", F.col("word.n").alias("times"))
    rare = rare.join(counts.select("hash", "n"), "hash", "left")
    found = F.coalesce("n", F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(found + HALF)).alias("more"),
        F.sum(F.when(found > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    rows = parts.drop("rare").join(sums, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
