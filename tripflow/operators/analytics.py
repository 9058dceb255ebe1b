"""Reports straight on the fact table or the raw file.

Each sums by dimension key first, then looks names up for the few result groups: no report joins a
dimension to single trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.numbers import exact_average

def _by_keys(fact: DataFrame, keys: list[str], value: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_values"), F.sum(value).alias("_sum")
    )


def _trips() -> Column:
    return F.sum("_n").cast("long").alias("trip_count")


def _total(name: str) -> Column:
    return F.round(F.sum("_sum"), 2).cast("double").alias(name)


def _mean(name: str) -> Column:
    return F.round(exact_average(F.sum("_sum"), F.sum("_values")), 2).alias(name)


def usual_trips(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("is_anomaly"))


def revenue_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    sums = _by_keys(usual_trips(fact), ["date_key"], "total_amount")
    return (
        sums.join(dim_date.select("date_key", "day_name"), "date_key")
        .groupBy("day_name")
        .agg(_trips(), _total("total_revenue"), _mean("avg_total"))
        .orderBy(F.col("total_revenue").desc())
    )


def top_pickup_zones(fact: DataFrame, dim_location: DataFrame, k: int = 10) -> DataFrame:
    sums = _by_keys(usual_trips(fact), ["pickup_location_key"], "total_amount")
    zones = dim_location.select(
        F.col("location_key").alias("pickup_location_key"), F.col("location_id").alias("pickup_location_id")
    )
    return (
        sums.join(zones, "pickup_location_key")
        .groupBy("pickup_location_id")
        .agg(_trips(), _total("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "pickup_location_id")
        .limit(k)
    )


def payment_mix_by_vendor(fact: DataFrame, dim_vendor: DataFrame, dim_payment: DataFrame) -> DataFrame:
    sums = _by_keys(fact, ["vendor_key", "payment_type_key"], "tip_amount")
    return (
        sums.join(dim_vendor.select("vendor_key", "vendor_name"), "vendor_key")
        .join(dim_payment.select("payment_type_key", "payment_description"), "payment_type_key")
        .groupBy("vendor_name", "payment_description")
        .agg(_trips(), _mean("avg_tip"))
        .orderBy("vendor_name", F.col("trip_count").desc())
    )


def fare_by_rate_type(fact: DataFrame, dim_rate_code: DataFrame) -> DataFrame:
    """Inner join: trips without a rate code have no rate type and drop out."""
    sums = _by_keys(fact, ["rate_code_key"], "fare_amount")
    return (
        sums.join(dim_rate_code.select("rate_code_key", "rate_description"), "rate_code_key")
        .groupBy("rate_description")
        .agg(_trips(), _mean("avg_fare_amount"))
        .orderBy(F.col("trip_count").desc(), "rate_description")
    )


def top_raw_zones(raw: DataFrame, k: int = 10) -> DataFrame:
    """Top pickup zones by revenue straight from the raw file; amounts summed as exact cents."""
    return (
        raw.groupBy(F.col("PULocationID").alias("pickup_location_id"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.round(F.sum(F.col("total_amount").cast("decimal(18,2)")), 2).cast("double").alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("pickup_location_id").asc_nulls_last())
        .limit(k)
    )


def mean_amount_by_zone(raw: DataFrame) -> DataFrame:
    """Mean amount per pickup zone, the NULL zone kept."""
    amount = F.col("total_amount").cast("decimal(18,2)")
    return raw.groupBy("PULocationID").agg(exact_average(F.sum(amount), F.count(amount)).alias("avg_val"))
