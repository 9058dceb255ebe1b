"""The deterministic business key of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of the key, in key order.
KEY_FIELDS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
]
NULL_TEXT = "~"
_EXACT_LONG = float(2**53)


def canonical_text(name: str, dtype: T.DataType) -> Column:
    """Text of one key field, by its declared type; NULL has a text of its own.

    A double is written as a whole number of millionths when that number divides back to the same
    double, and in its own notation otherwise, so two different values never share a text. All of
    it is double and long arithmetic inside codegen.
    """
    value = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = value.cast("double")
        millionths = F.rint(value * 1e6)
        round_trips = (F.abs(millionths) < _EXACT_LONG) & (millionths / 1e6 == value)
        text = F.when(round_trips, millionths.cast("long").cast("string")).otherwise(value.cast("string"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def key_digest() -> Column:
    """Eight-byte hash of the key fields. Equal keys have equal digests; the reverse need not hold."""
    return F.xxhash64(*KEY_FIELDS)


def add_trip_id(df: DataFrame) -> DataFrame:
    """SHA-256 over the nine key fields. NULLs take part in the key and never nullify it."""
    parts = [canonical_text(name, df.schema[name].dataType) for name in KEY_FIELDS]
    return df.withColumn("trip_id", F.sha2(F.concat_ws("|", *parts), 256))


# Longer than any digest, so that a packed text is never taken for one.
_TEXT_MARK = b"\0" * 33


def packed(key: Column | str) -> Column:
    """A text key as bytes: 32 for a digest in 64 small hexadecimal digits, its own bytes and a mark for any other text.

    Different keys have different bytes and a missing key has none. Digests are most of what a shuffle
    of keys or trips writes, and no shuffle codec halves their digits.
    """
    text = F.col(key) if isinstance(key, str) else key
    digest = F.unhex(text)
    is_digest = (F.length(text) == 64) & (F.lower(F.hex(digest)) == text)
    return F.when(is_digest, digest).otherwise(F.concat(F.encode(text, "UTF-8"), F.lit(_TEXT_MARK)))


def unpacked(key: Column | str) -> Column:
    """The text that ``packed`` made bytes of."""
    data = F.col(key) if isinstance(key, str) else key
    text = F.decode(F.substring(data, F.lit(1), F.length(data) - len(_TEXT_MARK)), "UTF-8")
    return F.when(F.length(data) == 32, F.lower(F.hex(data))).otherwise(text)
