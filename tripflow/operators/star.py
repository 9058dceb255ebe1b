"""Dimension rows and fact rows of a judged batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schemas
from tripflow.functions.calendar import date_key
from tripflow.functions.numbers import half_even_int, money

# Raw column -> fact column.
FACT_NAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "Airport_fee": "airport_fee",
}


def date_rows(df: DataFrame) -> DataFrame:
    """One row per distinct pickup date: the calendar is expanded after the distinct, not per trip."""
    days = df.select(F.to_date("tpep_pickup_datetime").alias("full_date")).filter("full_date is not null").distinct()
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def location_ids(df: DataFrame) -> DataFrame:
    """Distinct zone ids over pickups and dropoffs, from one scan."""
    ids = F.array(F.col("PULocationID").cast("int"), F.col("DOLocationID").cast("int"))
    both = df.select(F.explode(ids).alias("location_id"))
    return both.filter("location_id is not null").distinct()


def location_rows(df: DataFrame) -> DataFrame:
    """Zone dimension rows; names stay NULL, since no lookup file comes with the data."""
    return location_ids(df).select(
        F.col("location_id").alias("location_key"),
        "location_id",
        *[F.lit(None).cast(T.StringType()).alias(c) for c in ("borough", "zone", "service_zone")],
    )


def code_map(dimension: DataFrame, code: str, key: str) -> DataFrame:
    """Natural code and key of a seeded dimension. A handful of rows, checked when codes are read."""
    return dimension.select(F.col(code).cast("double").alias(f"_{key}_code"), key)


def map_codes(df: DataFrame, vendor: DataFrame, payment: DataFrame, rate_code: DataFrame) -> DataFrame:
    """Add the three surrogate keys; an unknown or missing code maps to NULL.

    The sides are the seeded code lists (4, 7 and 7 rows), so they are broadcast and the batch is
    not shuffled.
    """
    out = df
    for column, dim, code, key in (
        ("VendorID", vendor, "vendor_id", "vendor_key"),
        ("payment_type", payment, "payment_type_id", "payment_type_key"),
        ("RatecodeID", rate_code, "rate_code_id", "rate_code_key"),
    ):
        codes = F.broadcast(code_map(dim, code, key))
        out = out.join(codes, F.col(column).cast("double") == codes[f"_{key}_code"], "left").drop(f"_{key}_code")
    return out


def fact_rows(
    df: DataFrame, vendor: DataFrame, payment: DataFrame, rate_code: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Accepted raw rows shaped for the fact table, with the load casts applied, and the columns to ``keep``.

    Amounts become DECIMAL(10,2); the passenger count becomes an integer, halves to even.
    """
    mapped = map_codes(df, vendor, payment, rate_code).withColumnsRenamed(FACT_NAMES)
    ready = mapped.select(
        "trip_id",
        date_key(F.col("pickup_datetime")).alias("date_key"),
        F.col("PULocationID").cast("int").alias("pickup_location_key"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_key"),
        "vendor_key",
        "payment_type_key",
        "rate_code_key",
        "pickup_datetime",
        "dropoff_datetime",
        half_even_int(F.col("passenger_count")).alias("passenger_count"),
        *[money(F.col(c)).alias(c) for c in ("trip_distance", *schemas.FACT_AMOUNTS)],
        "is_anomaly",
        *keep,
    )
    return ready.select(*schemas.FACT_COLUMNS, *keep)
