"""Naive forecasts scored on the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROFILE_KEYS = ["zone_id", "hour_of_day", "is_weekend"]
# baseline name -> feature that is its prediction
FROM_FEATURES = {
    "same_hour_last_week": "trips_same_hour_lag_7d",
    "same_hour_yesterday": "trips_same_hour_lag_1d",
    "same_hour_mean_7d": "trips_same_hour_mean_7d",
}
BASELINES = [*FROM_FEATURES, "train_profile"]


def of_split(table: DataFrame, split: str) -> DataFrame:
    return table.filter(F.col("split") == split)


def train_profile(table: DataFrame) -> DataFrame:
    """Mean target per zone, hour and weekend flag: the only fitted baseline, on train rows alone."""
    train = of_split(table, "train")
    return train.groupBy(*PROFILE_KEYS).agg(
        (F.sum("target_trips").cast("double") / F.count("target_trips")).alias("train_profile")
    )


def predict(table: DataFrame, split: str) -> DataFrame:
    """One column per baseline for the rows of ``split``; a zone and hour without train rows stays NULL."""
    scored = of_split(table, split)
    for name, feature in FROM_FEATURES.items():
        scored = scored.withColumn(name, F.col(feature).cast("double"))
    return scored.join(train_profile(table), PROFILE_KEYS, "left")


def score(table: DataFrame, split: str) -> DataFrame:
    """Rows scored, MAE and RMSE per baseline, best MAE first. A NULL prediction is not scored."""
    target = F.col("target_trips").cast("double")
    errors = (
        predict(table, split)
        .select(target.alias("_target"), *BASELINES)
        .unpivot(["_target"], BASELINES, "baseline", "_prediction")
        .withColumn("_error", F.col("_prediction") - F.col("_target"))
    )
    return (
        errors.groupBy("baseline")
        .agg(
            F.count("_error").alias("rows"),
            F.avg(F.abs("_error")).alias("mae"),
            F.sqrt(F.avg(F.col("_error") * F.col("_error"))).alias("rmse"),
        )
        .orderBy(F.col("mae").asc_nulls_last(), "baseline")
    )


def score_baselines(table: DataFrame, split: str = "validate", final: bool = False) -> DataFrame:
    """``score``, with the test split refused unless this is the one final evaluation."""
    if split not in ("train", "validate", "test"):
        raise ValueError(f"unknown split: {split}")
    if split == "test" and not final:
        raise ValueError("the test split is scored once, at the very end: pass final=True to confirm")
    return score(table, split)
