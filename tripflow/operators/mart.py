"""The published mart and the metrics rolled up from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.functions.calendar import ntz
from tripflow.functions.numbers import ratio

METRICS_VERSION = "1.0"
METRIC_COLUMNS = ["trip_count", "total_revenue", "avg_fare", "avg_trip_distance", "card_tip_rate", "anomaly_share"]
# The distance bound of the average and the payment code of card trips.
LONGEST_AVERAGED_DISTANCE = 100
CARD = 1


def _sum_where(test: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col(value))), F.lit(0)).cast(schemas.MONEY_SUM).alias(value)


def build_mart(
    fact: DataFrame, dim_date: DataFrame, dim_location: DataFrame, dim_payment: DataFrame, refreshed_at: dt.datetime
) -> DataFrame:
    """Additive measures per pickup date and zone.

    Trips are counted and summed by their keys first, with only the card payment's key joined before;
    dates and zones are then looked up for one row per date and zone instead of per trip.
    Keys without a zone row share the NULL zone, so the looked-up rows are summed once more.
    """
    # Payment ids are unique, so this side is a single row.
    card_key = dim_payment.filter(F.col("payment_type_id") == CARD).select("payment_type_key", F.lit(True).alias("_card"))
    paid = F.col("fare_amount") > 0
    on_card = paid & F.coalesce(F.col("_card"), F.lit(False))
    in_range = (F.col("trip_distance") > 0) & (F.col("trip_distance") <= LONGEST_AVERAGED_DISTANCE)
    by_key = (
        fact.join(F.broadcast(card_key), "payment_type_key", "left")
        .groupBy("date_key", "pickup_location_key")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.count_if("is_anomaly").alias("anomaly_trip_count"),
            F.sum("total_amount").alias("total_revenue"),
            F.count_if(paid).alias("paid_trip_count"),
            _sum_where(paid, "fare_amount").alias("paid_fare_sum"),
            F.count_if(in_range).alias("distance_trip_count"),
            _sum_where(in_range, "trip_distance").alias("distance_sum"),
            _sum_where(on_card, "fare_amount").alias("card_fare_sum"),
            _sum_where(on_card, "tip_amount").alias("card_tip_sum"),
            F.max("pickup_datetime").alias("last_pickup_datetime"),
        )
    )
    named = by_key.join(dim_date.select("date_key", "full_date"), "date_key").join(
        dim_location.select(F.col("location_key").alias("pickup_location_key"), "location_id"),
        "pickup_location_key",
        "left",
    )
    types = {f.name: f.dataType for f in schemas.MART}
    return (
        named.groupBy(F.col("full_date").alias("pickup_date"), F.col("location_id").alias("pickup_location_id"))
        .agg(
            *[F.sum(c).cast(types[c]).alias(c) for c in schemas.ADDITIVE_COLUMNS],
            F.max("last_pickup_datetime").alias("last_pickup_datetime"),
        )
        .withColumn("refreshed_at", ntz(refreshed_at))
        .select(*schemas.MART.fieldNames())
    )


def metrics_of_sums() -> list[Column]:
    """Published metrics over columns that already hold rolled-up sums: divided last, never averaged."""
    return [
        F.col("trip_count").cast("long").alias("trip_count"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        ratio(F.col("paid_fare_sum"), F.col("paid_trip_count")).alias("avg_fare"),
        ratio(F.col("distance_sum"), F.col("distance_trip_count")).alias("avg_trip_distance"),
        ratio(F.col("card_tip_sum"), F.col("card_fare_sum")).alias("card_tip_rate"),
        ratio(F.col("anomaly_trip_count"), F.col("trip_count")).alias("anomaly_share"),
    ]


def _additive_sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in schemas.ADDITIVE_COLUMNS]


def summarise(mart: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Metrics at the grain ``by`` (its NULL group kept), or one grand-total row."""
    grouped = mart.groupBy(*by) if by else mart.groupBy()
    return grouped.agg(*_additive_sums()).select(*(by or []), *metrics_of_sums())


def grain_sums(mart: DataFrame, grains: dict[str, list[str]]) -> DataFrame:
    """The additive columns at several grains from one pass: ``grain``, every key column used, and the sums.

    One shuffle of combined rows serves all grains. A key that a grain rolls up is NULL there; the name
    of the grain, from ``grouping_id``, keeps a NULL zone apart from the total.
    """
    keys = list(dict.fromkeys(key for by in grains.values() for key in by))
    # The bit of a key is set where the grain rolls it up; the first key has the highest.
    ids = {sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in by): name for name, by in grains.items()}
    types = {f.name: f.dataType for f in schemas.MART}
    rolled = mart.groupingSets([[F.col(k) for k in by] for by in grains.values()], *keys).agg(
        F.grouping_id().alias("_grain"), *[F.sum(c).cast(types[c]).alias(c) for c in schemas.ADDITIVE_COLUMNS]
    )
    name = F.element_at(F.create_map(*[F.lit(v) for pair in ids.items() for v in pair]), F.col("_grain").cast("int"))
    return rolled.select(name.alias("grain"), *keys, *schemas.ADDITIVE_COLUMNS)


def summarise_grains(mart: DataFrame, grains: dict[str, list[str]]) -> DataFrame:
    """The metrics at several grains from one pass; a mart without rows gives none (``summarise`` gives its total a row)."""
    sums = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in schemas.ADDITIVE_COLUMNS]
    keys = list(dict.fromkeys(key for by in grains.values() for key in by))
    return grain_sums(mart, grains).select("grain", *keys, *sums).select("grain", *keys, *metrics_of_sums())


def load_mart(mart: DataFrame) -> DataFrame:
    """The whole mart in presentation order."""
    return mart.orderBy("pickup_date", F.col("pickup_location_id").asc_nulls_last())


def with_zone(mart: DataFrame) -> DataFrame:
    return mart.dropna(subset=["pickup_location_id"])


def select_scope(mart: DataFrame, start: dt.date, end: dt.date, zone: int | None = None) -> DataFrame:
    """Rows of an inclusive date range, of one zone or of all."""
    return mart.filter(in_scope(start, end, zone))


def in_scope(start: dt.date, end: dt.date, zone: int | None = None) -> Column:
    inside = F.col("pickup_date").between(F.lit(start), F.lit(end))
    return inside if zone is None else inside & (F.col("pickup_location_id") == zone)


def top_zones(mart: DataFrame, k: int = 10, by: str = "total_revenue") -> DataFrame:
    """Top zones by a metric; ties go to the lower zone id."""
    ranked = summarise(with_zone(mart), ["pickup_location_id"])
    return ranked.orderBy(F.col(by).desc(), "pickup_location_id").limit(k)


def zones_by_trips(mart: DataFrame) -> DataFrame:
    """Every zone, busiest first: the picker list."""
    counts = summarise(with_zone(mart), ["pickup_location_id"]).select("pickup_location_id", "trip_count")
    return counts.orderBy(F.col("trip_count").desc(), "pickup_location_id")
