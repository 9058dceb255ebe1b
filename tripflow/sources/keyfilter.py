"""Bloom filters over the keys of each month of the fact: which keys of a load are certainly new.

A filter is a table of 64-bit words. A key has its word by one hash and eight bits in it by another;
a key whose bits are not all set was never loaded. At about 25 bits for each key it is an eighth of
the keys' own size, and some four new keys in a hundred thousand seem known. It is read and built by
joins and aggregations, so it needs no memory that grows with the month.

A load writes the filter of its keys before it appends them: a load that dies in between leaves
keys that seem known, never known keys that seem new. A month that was begun without a filter stays
without one. Only ``insert_fact`` may add rows to a month that has one.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.sources import files

TABLE = "fact_key_filter"
MONTH, LEVEL = "trip_month", "level"
KEYS_PER_WORD = 2.5
BITS = 8
#: Up to so many keys are looked for by equality, which Parquet's own Bloom filters of row groups answer.
FEW = 32
PARQUET_BLOOM = "parquet.bloom.filter.enabled#trip_id"


def digest(key: str = "trip_id") -> Column:
    return F.xxhash64(key)


def _bits() -> Column:
    """Eight bits of a word, six bits of the draw for each."""
    each = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_draw, {6 * i}) & 63 as int))") for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), each)


def _placed(keys: DataFrame, level: Column) -> DataFrame:
    """``keys`` with the word of each key among 2**level words and its bits."""
    drawn = keys.withColumn("_draw", F.xxhash64(F.col("trip_id"), F.lit(BITS))).withColumn(LEVEL, level)
    word = F.expr(f"xxhash64(trip_id) & (shiftleft(1L, {LEVEL}) - 1)")
    return drawn.withColumn("word", word).withColumn("bits", _bits()).drop("_draw")


def level_of(keys: int) -> int:
    """The exponent of the number of words for so many keys."""
    return max(6, ceil(log2(max(1, keys) / KEYS_PER_WORD)))


def _month_path(wh, month: str) -> str:
    return f"{wh.path(TABLE)}/{MONTH}={month}"


def covers(wh, months: list[str]) -> bool:
    """Whether every one of ``months`` that has rows has a filter of all of them."""
    begun = [m for m in months if files.exists(wh.spark, f"{wh.path('fact_trip')}/{MONTH}={m}")]
    return all(files.exists(wh.spark, _month_path(wh, m)) for m in begun)


def add(wh, keys: DataFrame, months: list[str], expected: int) -> None:
    """Add ``keys`` (trip_id, trip_month), about ``expected`` of them, to the filters of ``months``."""
    level = level_of(expected)
    words = _placed(keys.select("trip_id", MONTH), F.lit(level)).groupBy(MONTH, LEVEL, "word").agg(F.bit_or("bits").alias("bits"))
    words.write.mode("append").partitionBy(MONTH, LEVEL).parquet(wh.path(TABLE))


def maybe_known(wh, batch: DataFrame, months: list[str]) -> DataFrame:
    """The digests of the keys of ``batch`` (trip_id, trip_month) that a filter of ``months`` does not rule out."""
    there = [m for m in months if files.exists(wh.spark, _month_path(wh, m))]
    # A few folders for each month: one for every size of load it had.
    levels = sorted({int(name.split("=")[1]) for m in there for name in files.child_names(wh.spark, _month_path(wh, m)) if name.startswith(LEVEL)})
    if not levels:
        return batch.select(digest().alias("digest")).limit(0)
    scan = wh.spark.read.schema(f"word long, bits long, {MONTH} string, {LEVEL} int").option("basePath", wh.path(TABLE))
    words = scan.parquet(*[_month_path(wh, m) for m in there])
    probes = batch.select("trip_id", MONTH).withColumn("_levels", F.array(*[F.lit(v) for v in levels]))
    probes = _placed(probes.select("trip_id", MONTH, F.explode("_levels").alias("_level")), F.col("_level"))
    probes = probes.select(digest().alias("digest"), MONTH, LEVEL, "word", F.col("bits").alias("wanted"))
    seen = probes.join(words, [MONTH, LEVEL, "word"]).where("bits & wanted = wanted")
    return seen.select("digest").distinct()


def stored_among(keys: DataFrame, existing: DataFrame, count: int) -> DataFrame:
    """The ``keys`` (trip_id) that ``existing`` holds. Few are looked for by equality, so that row groups without them are not read."""
    if count <= FEW:
        wanted = [F.col("trip_id") == F.lit(r["trip_id"]) for r in keys.collect()]  # FEW rows at most
        return existing.select("trip_id").where(reduce(lambda a, b: a | b, wanted, F.lit(False))).distinct()
    return existing.select("trip_id").join(F.broadcast(keys), "trip_id", "left_semi").distinct()
