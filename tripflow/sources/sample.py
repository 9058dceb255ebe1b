"""Trip-shaped views of general sales and event tables, for data without trip files.

An order line becomes a trip: the order's date is the pickup day, the line's quantity the time of
day, and the days to its shipment the minutes of the ride. Zones come from the nations of customer
and supplier. A few discount and tax rates stand for damaged fields, and untaxed lines arrive twice,
so every quality rule has hits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.operators.features import FeatureConfig
from tripflow.sources.raw import POSITION, with_position

# The moment the sample is judged at: later pickups count as future ones.
SAMPLE_NOW = dt.datetime(2001, 1, 1)
SAMPLE_MONTH = "1998-05"
# Minutes per unit of quantity (1..50): the latest pickup is at 23:20.
MINUTES_PER_UNIT = 28
ZONE_STEP = 11

EVENT_CONFIG = FeatureConfig(
    grid_start=dt.date(2024, 1, 1),
    grid_end=dt.date(2024, 1, 30),
    train_start=dt.date(2024, 1, 15),
    validate_start=dt.date(2024, 1, 22),
    test_start=dt.date(2024, 1, 26),
    public_holidays=(dt.date(2024, 1, 1), dt.date(2024, 1, 15)),
    leakage_check_days=(dt.date(2024, 1, 17), dt.date(2024, 1, 23), dt.date(2024, 1, 28)),
)


def _damaged(discount: str) -> Column:
    return (F.col("_disc") == F.lit(discount).cast("decimal(4,2)")) & (F.col("_tax") == F.lit("0.08").cast("decimal(4,2)"))


def _unless(damaged: Column, value: Column) -> Column:
    return F.when(~damaged, value)


def line_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines as raw trips, with the position of each row in the delivery."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = with_position(table("lineitem"))
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    # Orders meet their customers first: they are fewer and narrower than lines, which then move once.
    owned = orders.join(table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        lines.join(owned.drop("o_custkey", "c_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("_disc", F.col("l_discount").cast("decimal(4,2)"))
        .withColumn("_tax", F.col("l_tax").cast("decimal(4,2)"))
        .withColumn("_price", F.col("l_extendedprice").cast("decimal(12,2)"))
    )
    copies = F.when(F.col("_tax") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    returned = F.col("l_returnflag") == "R"
    sign = F.when(returned, F.lit(-1)).otherwise(F.lit(1))
    pickup = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("l_quantity") * MINUTES_PER_UNIT).cast("int"))
    ride = F.make_dt_interval(mins=F.date_diff(F.col("l_shipdate"), F.col("o_orderdate")))
    priority = F.substring("o_orderpriority", 1, 1).cast("double")

    def signed(amount: Column) -> Column:
        return (amount.cast("decimal(12,2)") * sign).cast("double")

    return (
        joined.withColumn("_copy", F.explode(copies))
        .withColumn(POSITION, F.struct(f"{POSITION}.*", "_copy"))
        .select(
            _unless(_damaged("0.06"), F.col("l_linenumber").cast("long")).alias("VendorID"),
            _unless(_damaged("0.10"), pickup).alias("tpep_pickup_datetime"),
            _unless(_damaged("0.09"), pickup + ride).alias("tpep_dropoff_datetime"),
            F.when(~returned, F.col("l_quantity") - 1).alias("passenger_count"),
            ((F.col("l_quantity") - 1) * 3).alias("trip_distance"),
            F.when(_damaged("0.04"), F.lit(42.0))
            .otherwise(F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", priority))
            .alias("RatecodeID"),
            F.when(~returned, F.when(F.col("l_linestatus") == "O", "N").otherwise("Y")).alias("store_and_fwd_flag"),
            _unless(_damaged("0.08"), (F.col("c_nationkey") * ZONE_STEP).cast("long")).alias("PULocationID"),
            _unless(_damaged("0.07"), (F.col("s_nationkey") * ZONE_STEP + 2).cast("long")).alias("DOLocationID"),
            F.when(_damaged("0.05"), F.lit(9))
            .otherwise(F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(0))
            .cast("long")
            .alias("payment_type"),
            signed(F.col("_price")).alias("fare_amount"),
            (F.col("_disc") * 10).cast("double").alias("extra"),
            F.lit(0.5).alias("mta_tax"),
            signed(F.col("_price") * F.col("_disc")).alias("tip_amount"),
            (F.col("_tax") * 100).cast("double").alias("tolls_amount"),
            F.lit(1.0).alias("improvement_surcharge"),
            signed(F.col("_price") * (1 - F.col("_disc")) * (1 + F.col("_tax"))).alias("total_amount"),
            F.when(~returned, F.lit(2.5)).alias("congestion_surcharge"),
            F.when(~returned, F.lit(0.0)).alias("Airport_fee"),
            F.lit(0.75).alias("cbd_congestion_fee"),
            POSITION,
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW], POSITION)
    )


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events as pickups: the user is the zone."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(
        F.col("user_id").cast("int").alias("pickup_location_key"),
        F.col("ts").cast("timestamp_ntz").alias("pickup_datetime"),
        (F.col("value") * 100).cast("decimal(12,0)").alias("cents"),
        "event_type",
    )


def event_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zone dimension of the events."""
    users = spark.read.parquet(f"{folder}/events.parquet").select(F.col("user_id").cast("int").alias("location_id"))
    return users.distinct().select(F.col("location_id").alias("location_key"), "location_id")
