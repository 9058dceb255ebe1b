"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, kept in text order.

A text's k-mers are GRAM neighbouring tokens (words, cut to TOKEN characters so that text without
spaces has k-mers too). Each k-mer with the number of its occurrence is hashed once; six bits of the
hash choose one of 64 bins and the rest ranks it there (one-permutation hashing). The two smallest
of a bin, put back into text order, are hashed to the bin's entry, so an entry survives an edit only
if both k-mers stay minimal and stay in order: that is what makes the likeness follow the edit
distance rather than the set of words.

The hash and the place of a k-mer are packed into one long, which sorts as a primitive; numbering
occurrences and choosing minima are passes over sorted arrays, linear in the text.

Defined results: a null text is empty; an empty text has an empty fingerprint and is like another
empty one (1) and unlike all else (0); equal texts have equal fingerprints; repeated rows follow each
other as documents of their own; a null id stands after every other; no rows give no rows; columns
other than doc_id and text are ignored. Everything here is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRAM = 2
TOKEN = 16
#: Bits of a place; a text may have 134 million tokens.
PLACE = 27
#: Bits of hash that are ranked, after the six that choose a bin.
RANK = 30
#: At most so many ranges of ids, whose bounds and first ids are planned on the driver.
RANGES = 2048
LAST_ID = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _range(size: Column) -> Column:
    return F.sequence(F.lit(0), size - 1)


def _changes(codes: Column, part: Callable[[Column], Column]) -> Column:
    """The places of sorted ``codes`` where ``part`` differs from the one before."""
    return F.filter(_range(F.size(codes)), lambda i: (i == 0) | (part(F.get(codes, i)) != part(F.get(codes, i - 1))))


def _place(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << PLACE) - 1))


def _packed(hashed: Column, place: Column) -> Column:
    """The upper 36 bits of a hash and a place, as a long that is not negative."""
    return F.shiftleft(F.shiftrightunsigned(hashed, 28), PLACE).bitwiseOR(place.cast("long"))


def _numbered(codes: Column) -> Column:
    """Hash and occurrence number of each k-mer, hashed again and packed with its place; ``codes`` are sorted."""

    def run(starts: Column) -> Column:
        def one(start: Column, at: Column) -> Column:
            after = F.coalesce(F.get(starts, at + 1), F.size(codes))

            def number(i: Column) -> Column:
                code = F.get(codes, i)
                return _packed(F.xxhash64(F.shiftrightunsigned(code, PLACE), i - start), _place(code))

            return F.transform(F.sequence(start, after - 1), number)

        return F.flatten(F.transform(starts, one))

    return let(_changes(codes, lambda c: F.shiftrightunsigned(c, PLACE)), run)


def _entries(codes: Column) -> Column:
    """bin * 65536 + hash of the two smallest of the bin in text order; ``codes`` are sorted."""

    def bin_of(code: Column) -> Column:
        return F.shiftrightunsigned(code, PLACE + RANK)

    def entry(i: Column) -> Column:
        a, b = F.get(codes, i), F.get(codes, i + 1)
        one, two = F.shiftrightunsigned(a, PLACE), F.shiftrightunsigned(b, PLACE)
        alone = b.isNull() | (bin_of(a) != bin_of(b))
        ordered = F.when(alone, F.xxhash64(one)).when(_place(a) < _place(b), F.xxhash64(one, two)).otherwise(F.xxhash64(two, one))
        return F.shiftleft(bin_of(a), 16).bitwiseOR(ordered.bitwiseAND(F.lit(0xFFFF)))

    return F.transform(_changes(codes, bin_of), entry)


def signature(text: Column) -> Column:
    """array<long>: one entry for each bin that has a k-mer."""
    tokens = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{TOKEN}}}"), F.lit(0))

    def from_tokens(tokens: Column) -> Column:
        last = F.greatest(F.lit(1), F.size(tokens) - GRAM + 1)
        codes = F.transform(_range(last), lambda i: _packed(F.xxhash64(*[F.get(tokens, i + k) for k in range(GRAM)]), i))
        made = let(F.sort_array(codes), lambda c: let(F.sort_array(_numbered(c)), _entries))
        return F.when(F.size(tokens) > 0, made).otherwise(F.array().cast("array<bigint>"))

    return let(tokens, from_tokens)


def written(signed: Column) -> Column:
    """The fingerprint as text: six hex digits for each bin that has a k-mer."""
    return F.array_join(F.transform(signed, lambda e: F.lower(F.lpad(F.hex(e), 6, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal entries among the bins that either text fills, 0 to 1."""

    def bins(s: Column) -> Column:
        return F.transform(s, lambda e: F.shiftright(e, 16))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, signed, next_text, next_signed): each document and the one after it by descending id.

    The ids are cut into ranges of about equal counts; a window inside each range finds the next
    document, and the first document of a range also stands behind the last of the range above (the
    first of all behind the last of all). The texts are shuffled once.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), place.alias("place"))

    ranges = min(RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("place", shares, 20 * ranges).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda b: b <= F.col("place")))
    heads = rows.groupBy(part.alias("part")).agg(F.max("place").alias("head")).orderBy(F.desc("part")).collect()
    above = {h["head"]: heads[i - 1]["part"] for i, h in enumerate(heads)}

    own = rows.select("*", part.alias("part"), F.lit(False).alias("guest"))
    table = spark.createDataFrame(list(above.items()), "place long, part int")
    first = rows.join(F.broadcast(table), "place")  # at most RANGES ids
    all_rows = own.union(first.select("doc_id", "text", "place", "part", F.lit(True).alias("guest")))
    signed = all_rows.withColumn("signed", signature(F.col("text")))
    down = W.partitionBy("part").orderBy("guest", F.desc("place"), F.xxhash64("text"))
    ahead = signed.withColumn("next_text", F.lead("text").over(down)).withColumn("next_signed", F.lead("signed").over(down))
    return ahead.where("NOT guest").select("doc_id", "text", "signed", "next_text", "next_signed")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row: fingerprints of the text and its edited text, and both likenesses."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third), F.substring(F.col("next_text"), F.lit(1), third)
    )
    rows = rows.select("doc_id", "n_chars", "signed", "next_signed", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "signed", "next_signed", F.sha2("edited", 256).alias("edited_sha256"), signature(F.col("edited")).alias("edited_signed"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("signed")).alias("fingerprint"),
        written(F.col("edited_signed")).alias("edited_fingerprint"),
        likeness(F.col("signed"), F.col("edited_signed")).alias("near_edited"),
        likeness(F.col("signed"), F.col("next_signed")).alias("near_next"),
    )
