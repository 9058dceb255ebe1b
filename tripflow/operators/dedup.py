"""First and repeated occurrences of a key, safe when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.keys import packed
from tripflow.session import stage
from tripflow.sources.raw import POSITION
from tripflow.sources.warehouse import BROADCAST_KEYS

DUPLICATE = "_is_duplicate"
# A key is hot when it holds more than 1/HOT_SHARE of the repeated rows: at most HOT_SHARE such keys.
HOT_SHARE = 10_000
# The sieve: 16 words of 64 bits to a block, at most 64 digests to a block, five bits of one word for each;
# at most 2**20 blocks (some 200 MB). Beyond 64 million suspects it lets more rows through, never fewer.
SIEVE_WORDS, SIEVE_KEYS, SIEVE_BITS, SIEVE_LEVEL = 16, 64, 5, 20
# The bitmap of rows: 16 words of 64 bits to a chunk of 1,024 places; at most 2**20 chunks (some 200 MB).
CHUNK_BITS, MOST_CHUNKS = 10, 1 << 20


def repeated_keys(df: DataFrame, key: str, position: str = POSITION) -> DataFrame:
    """Keys that occur more than once, with their first position and number of copies.

    Only the key and the position are read, and copies are combined before the shuffle.
    """
    return (
        df.groupBy(key)
        .agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
    )


def suspect_digests(df: DataFrame, digest: Column) -> tuple[DataFrame, int]:
    """The digests that occur more than once, stored, and their number.

    A digest is eight bytes, so this first look shuffles a fraction of what full keys would, and in
    a delivery without repeats it is the only one.
    """
    digests = df.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    suspects = stage(digests.select("_digest", "_n"), "suspect-digests")
    return suspects, suspects.count()


def _placed(df: DataFrame, digest: Column, level: int) -> DataFrame:
    """Add block, word of the block and bits of the word that stand for a digest.

    Each is a column of its own before the join, so that the key fields are hashed once for a row and
    the code of a stage stays short enough for the JVM to compile.
    """
    marked = df.withColumn("_digest", digest.cast("long"))
    marked = marked.withColumn("_draw", F.xxhash64("_digest"))
    each = [F.call_function("shiftleft", F.lit(1).cast("long"), F.expr(f"cast(shiftrightunsigned(_draw, {6 * i}) & 63 as int)")) for i in range(SIEVE_BITS)]
    return (
        marked.withColumn("_block", F.col("_digest").bitwiseAND(F.lit((1 << level) - 1).cast("long")))
        .withColumn("_word", F.shiftrightunsigned("_digest", 60).cast("int"))
        .withColumn("_bits", reduce(lambda x, y: x.bitwiseOR(y), each))
    )


def sieve_level(count: int) -> int:
    """The exponent of the number of blocks for so many digests."""
    return min(SIEVE_LEVEL, max(0, ceil(log2(max(1, count) / SIEVE_KEYS))))


def sieve(digests: DataFrame, level: int) -> DataFrame:
    """A Bloom filter of ``_digest`` as a table of 2**level blocks of 16 words, small enough to broadcast."""
    placed = _placed(digests, F.col("_digest"), level)
    words = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, F.col("_bits"))), F.lit(0).cast("long")) for i in range(SIEVE_WORDS)]
    return placed.groupBy("_block").agg(F.array(*words).alias("_words"))


def split_by_sieve(df: DataFrame, digest: Column, suspects: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose digest is none of ``suspects``, and all others with a few in a thousand of those besides.

    Neither part is shuffled: only the sieve's blocks, about two bytes for each suspect, reach the tasks.
    """
    level = sieve_level(count)
    blocks = stage(sieve(suspects, level), "sieve")
    placed = _placed(df, digest, level).drop("_digest", "_draw").join(F.broadcast(blocks), "_block", "left")
    may = F.coalesce(F.get("_words", F.col("_word")).bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    return placed.filter(~may).select(*df.columns), placed.filter(may).select(*df.columns)


def numbered(df: DataFrame, position: str) -> DataFrame | None:
    """``df`` with ``_place``: its positions as whole numbers in the same order, None where they cannot be.

    A place in a delivery, (file, row, and whole numbers after them), counts from the end of the file
    before. The files, one row for each, are the only thing that is looked up.
    """
    kind = df.schema[position].dataType
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if isinstance(kind, whole):
        return df.withColumn("_place", F.col(position).cast("long"))
    if not isinstance(kind, T.StructType) or len(kind) < 2 or not isinstance(kind[0].dataType, T.StringType):
        return None
    if not all(isinstance(f.dataType, whole) for f in kind[1:]):
        return None
    file, *numbers = [F.col(f"{position}.`{f.name}`") for f in kind]
    largest = [F.max(n).alias(f"_{i}") for i, n in enumerate(numbers)]
    bad = reduce(lambda a, b: a | b, [n.isNull() | (n < 0) for n in numbers], file.isNull())
    # One row for each file of the delivery.
    sizes = df.groupBy(file.alias("_file")).agg(*largest, F.count_if(F.coalesce(bad, F.lit(True))).alias("_bad")).collect()
    if any(r["_bad"] for r in sizes):
        return None
    widths = [max((r[f"_{i}"] for r in sizes), default=0) + 1 for i in range(len(numbers))]
    per_row = 1
    for width in widths[1:]:
        per_row *= width
    starts, start = [], 0
    for r in sorted(sizes, key=lambda r: r["_file"].encode()):
        starts.append((r["_file"], start))
        start += (r["_0"] + 1) * per_row
    if start >= 1 << 62:
        return None
    place = F.lit(0).cast("long")
    for number, width in zip(numbers, [1, *widths[1:]]):
        place = place * F.lit(width).cast("long") + number.cast("long")
    files = df.sparkSession.createDataFrame(starts, "_file string, _start long").coalesce(1)
    return df.join(F.broadcast(files), file == F.col("_file")).withColumn("_place", F.col("_start") + place).drop("_file", "_start")


def _chunk() -> Column:
    return F.shiftright("_place", CHUNK_BITS)


def _bit_word() -> Column:
    return F.shiftright("_place", 6).bitwiseAND(F.lit(SIEVE_WORDS - 1).cast("long")).cast("int")


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_place").bitwiseAND(F.lit(63).cast("long")).cast("int"))


def _bitmap(places: DataFrame) -> DataFrame:
    """One bit for each ``_place``: chunks of 16 words, and the number of rows that fell into each."""
    marked = places.select(_chunk().alias("_chunk"), _bit_word().alias("_word"), _bit().alias("_bits"))
    words = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, F.col("_bits"))), F.lit(0).cast("long")) for i in range(SIEVE_WORDS)]
    return marked.groupBy("_chunk").agg(F.array(*words).alias("_set"), F.count(F.lit(1)).alias("_rows"))


def repeat_bitmap(
    placed: DataFrame, key: str, digest: Column, suspects: DataFrame, count: int, nulls: bool, broadcast_keys: int
) -> tuple[DataFrame | None, bool]:
    """The places of all rows but the first of their key as a bitmap, stored; whether rows of ``placed`` share a place.

    Only bytes of keys and whole numbers are shuffled: of the rows that may repeat, each task's first
    place of a key. Bits of all these rows less those of the first places are the repeats. None if
    there are too many chunks to broadcast. A missing key repeats only if ``nulls``.
    """
    exact = F.coalesce(packed(key), F.lit(b""))
    rows = placed if nulls else placed.filter(F.col(key).isNotNull())
    if count > broadcast_keys:
        may = split_by_sieve(rows, digest, suspects, count)[1]
    else:
        may = rows.withColumn("_digest", digest).join(F.broadcast(suspects.select("_digest")), "_digest", "left_semi")
    every = stage(_bitmap(may), "suspect-places")
    chunks = every.agg(F.count(F.lit(1)), F.sum("_rows"), F.sum(F.expr("aggregate(_set, 0, (n, w) -> n + bit_count(w))"))).first()
    if chunks[0] > MOST_CHUNKS:
        return None, False
    firsts = may.groupBy(exact.alias("_key")).agg(F.min("_place").alias("_place"))
    first = _bitmap(firsts).select("_chunk", F.col("_set").alias("_first"))
    rest = F.zip_with("_set", "_first", lambda a, b: a.bitwiseAND(F.bitwise_not(F.coalesce(b, F.lit(0).cast("long")))))
    others = every.join(first, "_chunk", "left").select("_chunk", F.when(F.col("_first").isNull(), F.col("_set")).otherwise(rest).alias("_words"))
    return stage(others.filter("exists(_words, w -> w <> 0)"), "repeat-places"), chunks[1] != chunks[2]


def _with_flag(placed: DataFrame, bitmap: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``placed`` and ``_is_duplicate`` by the bitmap; no row is shuffled."""
    marked = placed.withColumn("_chunk", _chunk()).join(F.broadcast(bitmap), "_chunk", "left")
    is_set = F.get("_words", _bit_word()).bitwiseAND(_bit()) != 0
    return marked.select(*columns, F.coalesce(is_set, F.lit(False)).alias(DUPLICATE))


def _many(suspects: DataFrame, broadcast_keys: int) -> bool:
    """Whether so many rows may repeat that none of them should be shuffled whole."""
    return suspects.agg(F.sum("_n")).first()[0] > broadcast_keys


def flag_repeats(
    df: DataFrame,
    key: str = "trip_id",
    position: str = POSITION,
    digest: Column | None = None,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Add ``_is_duplicate``: true for every occurrence of a key but the first in file order.

    The wide rows are not ranked in a window, where one hot key would be one task's work. The
    repeated keys are found first, among the rows whose ``digest`` repeats, and counted; then

    * none: nothing to join;
    * up to ``broadcast_keys`` rows that may repeat: their keys are broadcast, and the wide rows are
      not shuffled at all;
    * more: the places of the repeats, a bit for each, are broadcast, see ``repeat_bitmap``;
    * positions that are no places, or too far apart for that: up to ``broadcast_keys`` keys are
      broadcast, beyond that only rows that pass a sieve of the repeated digests are shuffled. The hot keys (at most
      ``HOT_SHARE`` by definition) are broadcast, and rows that matched one get a routing key of
      their own, so the shuffle join that serves the rest has no hot key.
    """
    digest = F.xxhash64(key) if digest is None else digest
    suspects, found = suspect_digests(df, digest)
    if found == 0:
        return df.withColumn(DUPLICATE, F.lit(False))
    if _many(suspects, broadcast_keys) and (placed := numbered(df, position)) is not None:
        bitmap, _ = repeat_bitmap(placed, key, digest, suspects, found, False, broadcast_keys)
        if bitmap is not None:
            return _with_flag(placed, bitmap, df.columns)
    suspects = suspects.select("_digest")
    if found > broadcast_keys:
        single, maybe = split_by_sieve(df, digest, suspects, found)
    else:
        maybe = df.withColumn("_digest", digest).join(F.broadcast(suspects), "_digest", "left_semi").drop("_digest")
    repeats = stage(repeated_keys(maybe, key, position), "repeated-keys")
    size = repeats.agg(F.count(F.lit(1)).alias("keys"), F.sum("_copies").alias("rows")).first()
    if size["keys"] == 0:
        return df.withColumn(DUPLICATE, F.lit(False))
    if size["keys"] <= broadcast_keys:
        return _flagged(df, df.join(F.broadcast(repeats.select(key, "_first")), key, "left"), F.col("_first"), position)
    is_hot = F.col("_copies") > F.lit(size["rows"] // HOT_SHARE)
    hot = repeats.filter(is_hot).select(key, F.col("_first").alias("_hot_first"))
    rest = repeats.filter(~is_hot).select(F.col(key).alias("_route"), "_first")
    own_route = F.concat(F.lit("#"), F.col(position).cast("string"))
    joined = (
        maybe.join(F.broadcast(hot), key, "left")
        .withColumn("_route", F.when(F.col("_hot_first").isNull(), F.col(key)).otherwise(own_route))
        # Unique keys on the right: built as a hash table, so that the wide rows are not sorted.
        .join(rest.hint("shuffle_hash"), "_route", "left")
    )
    flagged = _flagged(df, joined, F.coalesce("_hot_first", "_first"), position)
    return single.withColumn(DUPLICATE, F.lit(False)).unionByName(flagged)


def _flagged(df: DataFrame, joined: DataFrame, first: Column, position: str) -> DataFrame:
    # A repeated key's first copy has its own position; a key without repeats has no first.
    is_repeat = F.coalesce(F.col(position) != first, F.lit(False))
    return joined.select(*df.columns, is_repeat.alias(DUPLICATE))


def first_per_key(df: DataFrame, key: str, position: str = POSITION) -> DataFrame:
    """The whole first row of every key in file order.

    ``min_by`` combines before the shuffle, so a key held by a third of the rows reaches the
    reducer as one row per map task.
    """
    rest = [c for c in df.columns if c not in (key, position)]
    firsts = df.groupBy(key).agg(F.min_by(F.struct(*rest), position).alias("_row"), F.min(position).alias(position))
    return firsts.select(key, position, "_row.*").select(*df.columns)


def first_rows(df: DataFrame, key: str, position: str = POSITION, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``first_per_key``, but only rows whose key may repeat are aggregated; all others pass as they are.

    Where many may, and no two share a place, the repeats are left out by their places, see
    ``repeat_bitmap``, and no row is aggregated.
    """
    digest = F.xxhash64(key)
    suspects, found = suspect_digests(df, digest)
    if found == 0:
        return df
    if _many(suspects, broadcast_keys) and (placed := numbered(df, position)) is not None:
        bitmap, shared = repeat_bitmap(placed, key, digest, suspects, found, True, broadcast_keys)
        if bitmap is not None and not shared:
            return _with_flag(placed, bitmap, df.columns).filter(~F.col(DUPLICATE)).drop(DUPLICATE)
    suspects = suspects.select("_digest")
    if found > broadcast_keys:
        single, maybe = split_by_sieve(df, digest, suspects, found)
    else:
        marked, repeated = df.withColumn("_digest", digest), F.broadcast(suspects)
        single = marked.join(repeated, "_digest", "left_anti").drop("_digest")
        maybe = marked.join(repeated, "_digest", "left_semi").drop("_digest")
    return single.unionByName(first_per_key(maybe, key, position))
