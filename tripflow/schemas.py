"""Schemas of the raw file and of every table, and the seeded code dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Column names and types of the raw files and of every table below.
RAW = _struct(
    ("VendorID", T.LongType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.LongType()),
    ("DOLocationID", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("Airport_fee", T.DoubleType()),
    ("cbd_congestion_fee", T.DoubleType()),
)
RAW_COLUMNS = RAW.fieldNames()

DIM_DATE = _struct(
    ("date_key", T.IntegerType()),
    ("full_date", T.DateType()),
    ("day", T.IntegerType()),
    ("month", T.IntegerType()),
    ("quarter", T.IntegerType()),
    ("year", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("day_name", T.StringType()),
)

DIM_LOCATION = _struct(
    ("location_key", T.IntegerType()),
    ("location_id", T.IntegerType()),
    ("borough", T.StringType()),
    ("zone", T.StringType()),
    ("service_zone", T.StringType()),
)

DIM_VENDOR = _struct(
    ("vendor_key", T.IntegerType()),
    ("vendor_id", T.IntegerType()),
    ("vendor_name", T.StringType()),
)

DIM_PAYMENT = _struct(
    ("payment_type_key", T.IntegerType()),
    ("payment_type_id", T.IntegerType()),
    ("payment_description", T.StringType()),
)

DIM_RATE_CODE = _struct(
    ("rate_code_key", T.IntegerType()),
    ("rate_code_id", T.IntegerType()),
    ("rate_description", T.StringType()),
)

# The public trip-record code lists, plus the two codes seen in files but not in them.
VENDORS = [
    (1, 1, "Creative Mobile Technologies, LLC"),
    (2, 2, "Curb Mobility, LLC"),
    (3, 6, "Myle Technologies Inc"),
    (4, 7, "Helix"),
]
PAYMENT_TYPES = [
    (1, 0, "Unknown / not provided"),
    (2, 1, "Credit card"),
    (3, 2, "Cash"),
    (4, 3, "No charge"),
    (5, 4, "Dispute"),
    (6, 5, "Unknown"),
    (7, 6, "Voided trip"),
]
RATE_CODES = [
    (1, 1, "Standard rate"),
    (2, 2, "JFK"),
    (3, 3, "Newark"),
    (4, 4, "Nassau or Westchester"),
    (5, 5, "Negotiated fare"),
    (6, 6, "Group ride"),
    (7, 99, "Unknown / not provided"),
]

FACT_AMOUNTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
    "total_amount",
]
FACT_BATCH = _struct(
    ("trip_id", T.StringType()),
    ("date_key", T.IntegerType()),
    ("pickup_location_key", T.IntegerType()),
    ("dropoff_location_key", T.IntegerType()),
    ("vendor_key", T.IntegerType()),
    ("payment_type_key", T.IntegerType()),
    ("rate_code_key", T.IntegerType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", MONEY),
    *((name, MONEY) for name in FACT_AMOUNTS),
    ("is_anomaly", T.BooleanType()),
)
FACT_COLUMNS = FACT_BATCH.fieldNames()
FACT = T.StructType(
    [T.StructField("trip_key", T.LongType(), True), *FACT_BATCH.fields, T.StructField("trip_month", T.StringType(), True)]
)

QUARANTINE = T.StructType(
    [
        *RAW.fields,
        *_struct(
            ("trip_id", T.StringType()),
            ("reason_codes", T.StringType()),
            ("source_file", T.StringType()),
            ("ingest_month", T.StringType()),
            ("quarantined_at", T.TimestampNTZType()),
        ).fields,
    ]
)

LEDGER = _struct(
    ("run_id", T.LongType()),
    ("seq", T.IntegerType()),
    ("month", T.StringType()),
    ("status", T.StringType()),
    ("at", T.TimestampNTZType()),
    ("error", T.StringType()),
    ("rows_inserted", T.LongType()),
    ("mart_rows", T.LongType()),
)

ADDITIVE_COLUMNS = [
    "trip_count",
    "anomaly_trip_count",
    "total_revenue",
    "paid_trip_count",
    "paid_fare_sum",
    "distance_trip_count",
    "distance_sum",
    "card_fare_sum",
    "card_tip_sum",
]
_COUNTS = {"trip_count", "anomaly_trip_count", "paid_trip_count", "distance_trip_count"}
MART = _struct(
    ("pickup_date", T.DateType()),
    ("pickup_location_id", T.IntegerType()),
    *((name, T.LongType() if name in _COUNTS else MONEY_SUM) for name in ADDITIVE_COLUMNS),
    ("last_pickup_datetime", T.TimestampNTZType()),
    ("refreshed_at", T.TimestampNTZType()),
)


def vendor_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VENDORS, DIM_VENDOR).coalesce(1)


def payment_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_TYPES, DIM_PAYMENT).coalesce(1)


def rate_code_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATE_CODES, DIM_RATE_CODE).coalesce(1)
