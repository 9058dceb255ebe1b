"""The zone x hour feature table, and the proof that no feature sees the future."""

from __future__ import annotations

import datetime as dt
import tomllib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.calendar import hour_of, iso_day_of_week, ntz

KEY_COLUMNS = ["zone_id", "hour_start", "forecast_date", "prediction_made_at"]
FEATURE_COLUMNS = [
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_public_holiday",
    "trips_same_hour_lag_1d",
    "trips_same_hour_lag_7d",
    "trips_same_hour_mean_7d",
    "zone_trips_prev_day",
    "zone_trips_trend_7d",
    "history_complete",
]
TARGET_COLUMN = "target_trips"
SPLIT_COLUMN = "split"
# No feature looks further back than this many days.
LOOKBACK_DAYS = 14
HOURS_PER_DAY = 24
# Grid rows that one task sorts for its windows: their memory is that of these rows, whatever the zones.
ROWS_PER_TASK = 400_000


class LeakageError(AssertionError):
    """Removing later trips altered a value that was known before them, or a day to be checked has no rows."""


@dataclass(frozen=True)
class FeatureConfig:
    """Grid, split boundaries, holidays and check days; the settings copied into a snapshot."""

    grid_start: dt.date
    grid_end: dt.date
    train_start: dt.date
    validate_start: dt.date
    test_start: dt.date
    public_holidays: tuple[dt.date, ...] = ()
    leakage_check_days: tuple[dt.date, ...] = ()
    seed: int = 42

    @classmethod
    def from_dict(cls, settings: dict) -> FeatureConfig:
        grid, split = settings["grid"], settings["split"]
        repro = settings["reproducibility"]
        return cls(
            grid["start"],
            grid["end"],
            split["train_start"],
            split["validate_start"],
            split["test_start"],
            tuple(settings["calendar"]["public_holidays"]),
            tuple(repro["leakage_check_days"]),
            repro["seed"],
        )

    @classmethod
    def from_toml(cls, path: str) -> FeatureConfig:
        with open(path, "rb") as f:
            return cls.from_dict(tomllib.load(f))

    def as_dict(self) -> dict:
        return {
            "grid": {"start": self.grid_start, "end": self.grid_end},
            "split": {
                "train_start": self.train_start,
                "validate_start": self.validate_start,
                "test_start": self.test_start,
            },
            "calendar": {"public_holidays": list(self.public_holidays)},
            "reproducibility": {"seed": self.seed, "leakage_check_days": list(self.leakage_check_days)},
        }


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day)


def hourly_demand(fact: DataFrame, dim_location: DataFrame, cutoff: dt.datetime | None = None) -> DataFrame:
    """Pickups per zone and hour, of trips before ``cutoff``.

    Counted by key before the zone is looked up, so a busy zone is combined on the map side.
    """
    seen = fact if cutoff is None else fact.filter(F.col("pickup_datetime") < ntz(cutoff))
    by_key = seen.groupBy("pickup_location_key", hour_of(F.col("pickup_datetime")).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    zones = dim_location.select(
        F.col("location_key").alias("pickup_location_key"), F.col("location_id").alias("zone_id")
    )
    return by_key.join(zones, "pickup_location_key").select("zone_id", "hour_start", F.col("_n").alias("trips"))


def zone_hours(dim_location: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every zone with every hour of the inclusive date range: the hours are exploded per zone."""
    last = _midnight(end) + dt.timedelta(hours=HOURS_PER_DAY - 1)
    hours = F.sequence(ntz(_midnight(start)), ntz(last), F.expr("INTERVAL 1 HOUR"))
    return dim_location.select(F.col("location_id").alias("zone_id"), F.explode(hours).alias("hour_start"))


def picked_up_between(fact: DataFrame, first: dt.datetime, after: dt.datetime) -> DataFrame:
    """Trips of a time range: a filter the scan can use, and only its months of a partitioned fact."""
    pickup = F.col("pickup_datetime")
    trips = fact.filter((pickup >= ntz(first)) & (pickup < ntz(after)))
    if "trip_month" in fact.columns:
        last = after - dt.timedelta(microseconds=1)
        trips = trips.filter(F.col("trip_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    return trips


def demand_grid(
    fact: DataFrame, dim_location: DataFrame, start: dt.date, end: dt.date, cutoff: dt.datetime | None = None
) -> DataFrame:
    """Dense grid: an hour without pickups is a row with 0.

    The zero rows and the counted hours are summed together instead of joined. Both are placed by
    zone once, which also serves every window after it; a zone is never more than the hours of the
    grid, whatever its traffic.
    """
    first, after = _midnight(start), _midnight(end) + dt.timedelta(days=1)
    # By rows, not by bytes: dense rows are so small in a shuffle that a share of usual size is millions of them.
    rows = dim_location.count() * HOURS_PER_DAY * (after - first).days
    counted = hourly_demand(picked_up_between(fact, first, after), dim_location, cutoff)
    zeros = zone_hours(dim_location, start, end).withColumn("trips", F.lit(0).cast("long"))
    return (
        zeros.unionByName(counted)
        .repartition(max(2, ceil(rows / ROWS_PER_TASK)), "zone_id")
        .groupBy("zone_id", "hour_start")
        .agg(F.sum("trips").alias("trips"))
        .withColumn("forecast_date", F.to_date("hour_start"))
        .withColumn("hour_of_day", F.hour("hour_start"))
    )


def daily_demand(grid: DataFrame) -> DataFrame:
    return grid.groupBy("zone_id", "forecast_date").agg(F.sum("trips").alias("day_trips"))


def same_hour_window() -> Window:
    """Over one zone and hour of day: one row back is the same hour one day earlier."""
    return Window.partitionBy("zone_id", "hour_of_day").orderBy("hour_start")


def day_window(first: int, last: int) -> Window:
    """Over one zone, the rows of the days from ``first`` to ``last`` relative to the row's day."""
    return Window.partitionBy("zone_id").orderBy("_day").rangeBetween(first, last)


def lag_1d() -> Column:
    return F.lag("trips", 1).over(same_hour_window())


def lag_7d() -> Column:
    return F.lag("trips", 7).over(same_hour_window())


def mean_7d() -> Column:
    frame = same_hour_window().rowsBetween(-7, -1)
    return F.when(F.count("trips").over(frame) == 7, F.avg("trips").over(frame))


def previous_day() -> Column:
    return F.sum("trips").over(day_window(-1, -1))


def last_7_days() -> Column:
    return F.sum("trips").over(day_window(-7, -1))


def days_8_to_14() -> Column:
    return F.sum("trips").over(day_window(-14, -8))


def days_of_history() -> Column:
    """Grid days before this one, at most 14: the grid has every hour of a day."""
    return (F.count(F.lit(1)).over(day_window(-LOOKBACK_DAYS, -1)) / HOURS_PER_DAY).cast("long")


def with_history(grid: DataFrame) -> DataFrame:
    """All history columns. Day totals are range frames over the hours, so no second table is joined."""
    return (
        grid.withColumn("_day", F.unix_date("forecast_date"))
        .withColumn("trips_same_hour_lag_1d", lag_1d())
        .withColumn("trips_same_hour_lag_7d", lag_7d())
        .withColumn("trips_same_hour_mean_7d", mean_7d())
        .withColumn("zone_trips_prev_day", previous_day())
        .withColumn("trips_last_7d", last_7_days())
        .withColumn("trips_prev_7d", days_8_to_14())
        .withColumn("days_of_history", days_of_history())
    )


def trend_7d() -> Column:
    """Last seven days over the seven before, one added to both; NULL short of 14 days of history."""
    smoothed = (F.col("trips_last_7d") + F.lit(1.0)) / (F.col("trips_prev_7d") + F.lit(1.0))
    return F.when(F.col("days_of_history") == LOOKBACK_DAYS, smoothed)


def calendar_features(day: Column, holidays: tuple[dt.date, ...]) -> list[Column]:
    weekday = iso_day_of_week(day)
    holiday = day.isin(list(holidays)) if holidays else F.lit(False)
    return [
        weekday.cast("int").alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
        holiday.alias("is_public_holiday"),
    ]


def split_label(day: Column, config: FeatureConfig) -> Column:
    return (
        F.when(day < F.lit(config.train_start), "warmup")
        .when(day < F.lit(config.validate_start), "train")
        .when(day < F.lit(config.test_start), "validate")
        .otherwise("test")
    )


def build_features(
    fact: DataFrame,
    dim_location: DataFrame,
    config: FeatureConfig,
    cutoff: dt.datetime | None = None,
    grid_start: dt.date | None = None,
    grid_end: dt.date | None = None,
) -> DataFrame:
    """The feature table, reading only trips picked up before ``cutoff``.

    ``grid_start`` and ``grid_end`` narrow the grid for the leakage check; normally it is the
    configured one.
    """
    grid = demand_grid(fact, dim_location, grid_start or config.grid_start, grid_end or config.grid_end, cutoff)
    day = F.col("forecast_date")
    return with_history(grid).select(
        "zone_id",
        "hour_start",
        "forecast_date",
        day.cast("timestamp_ntz").alias("prediction_made_at"),
        "hour_of_day",
        *calendar_features(day, config.public_holidays),
        "trips_same_hour_lag_1d",
        "trips_same_hour_lag_7d",
        "trips_same_hour_mean_7d",
        "zone_trips_prev_day",
        trend_7d().alias("zone_trips_trend_7d"),
        (F.col("days_of_history") == LOOKBACK_DAYS).alias("history_complete"),
        F.col("trips").alias(TARGET_COLUMN),
        split_label(day, config).alias(SPLIT_COLUMN),
    )


def in_presentation_order(features: DataFrame) -> DataFrame:
    return features.orderBy("zone_id", "hour_start")


Builder = Callable[..., DataFrame]


def _truncated(fact: DataFrame, dim_location: DataFrame, config: FeatureConfig, day: dt.date, build: Builder) -> DataFrame:
    """Features of ``day`` from trips before its midnight.

    Features reach back 14 days, so the grid, and with it the scan, starts there. A feature reaching
    further would differ and be reported, not missed.
    """
    start = max(config.grid_start, day - dt.timedelta(days=LOOKBACK_DAYS))
    built = build(fact, dim_location, config, cutoff=_midnight(day), grid_start=start, grid_end=day)
    return built.filter(F.col("forecast_date") == F.lit(day))


def leakage_report(
    fact: DataFrame,
    dim_location: DataFrame,
    config: FeatureConfig,
    build: Builder = build_features,
    full: DataFrame | None = None,
) -> DataFrame:
    """Per check day: rows of the full build, and rows whose features change without the future.

    The target is left out: it is meant to be unknown at midnight. Rows are compared exactly, as
    counted values: a row equal on both sides cancels out.
    """
    columns = KEY_COLUMNS + FEATURE_COLUMNS
    days = list(config.leakage_check_days)
    full = build(fact, dim_location, config) if full is None else full
    whole = full.filter(F.col("forecast_date").isin(days)).select(*columns, F.lit(1).alias("_side"))
    cut = [
        _truncated(fact, dim_location, config, day, build).select(*columns, F.lit(-1).alias("_side")) for day in days
    ]
    sides = reduce(DataFrame.unionByName, cut, whole)
    compared = sides.groupBy(*columns).agg(
        F.sum("_side").alias("_balance"), F.count_if(F.col("_side") == 1).alias("_full")
    )
    per_day = compared.groupBy("forecast_date").agg(
        F.sum("_full").cast("long").alias("rows_checked"),
        F.coalesce(F.sum(F.when(F.col("_balance") > 0, F.col("_balance"))), F.lit(0)).alias("differing_rows"),
    )
    asked = fact.sparkSession.createDataFrame([(d,) for d in days], "forecast_date date").coalesce(1)
    return (
        asked.join(per_day, "forecast_date", "left")
        .select(
            F.col("forecast_date").alias("check_day"),
            F.coalesce("rows_checked", F.lit(0)).cast("long").alias("rows_checked"),
            F.coalesce("differing_rows", F.lit(0)).cast("long").alias("differing_rows"),
        )
    )


def check_no_future_leakage(
    fact: DataFrame,
    dim_location: DataFrame,
    config: FeatureConfig,
    build: Builder = build_features,
    full: DataFrame | None = None,
) -> list[dt.date]:
    """The check days, or ``LeakageError`` when a feature reads data from after its prediction moment."""
    outside = [day for day in config.leakage_check_days if not config.grid_start <= day <= config.grid_end]
    if outside:
        raise LeakageError(f"no feature rows to check on {', '.join(map(str, outside))}: before or after the grid's days")
    # One row per configured day.
    for row in leakage_report(fact, dim_location, config, build, full).collect():
        if row["rows_checked"] == 0 and row["differing_rows"] == 0:
            raise LeakageError(f"no feature rows to check on {row['check_day']}")
        if row["differing_rows"]:
            raise LeakageError(f"{row['differing_rows']} rows of {row['check_day']} depend on trips that start on that day or later")
    return list(config.leakage_check_days)


def split_overview(features: DataFrame) -> DataFrame:
    """Rows, zones, first day and zero targets per split."""
    return features.groupBy(SPLIT_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("zone_id").alias("zones"),
        F.min("forecast_date").alias("first_day"),
        F.count_if(F.col(TARGET_COLUMN) == 0).alias("zero_rows"),
    )


def train_correlations(features: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of each column with the target, on the train split only; pairs with a NULL are left out."""
    train = features.filter(F.col(SPLIT_COLUMN) == "train")
    long = train.select(F.col(TARGET_COLUMN).cast("double").alias("_y"), *[F.col(c).cast("double") for c in columns])
    return (
        long.unpivot(["_y"], columns, "column_name", "_x")
        .filter("_x is not null")
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("pairs"), F.corr("_x", "_y").alias("r"))
    )
