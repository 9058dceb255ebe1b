"""Feature table, leakage check and snapshot in one job, and scoring of the stored snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import features, forecast, ledger, snapshots
from tripflow.session import stage, staging_scope
from tripflow.sources.warehouse import Warehouse


def build_and_snapshot(
    wh: Warehouse,
    config: features.FeatureConfig,
    snapshot_root: str,
    version: str | None = None,
    now: dt.datetime | None = None,
) -> dict:
    """Build once, prove that no feature sees the future, then write the snapshot. Returns its manifest."""
    now = now or dt.datetime.now()
    fact, zones = wh.read("fact_trip"), wh.read("dim_location")
    runs = [
        {"run_id": r["run_id"], "month": r["month"], "finished_at": str(r["finished_at"])}
        # One row per ingest run.
        for r in ledger.successful_runs(wh.read(ledger.TABLE)).orderBy("run_id").collect()
    ]
    with staging_scope(wh.spark):
        table = stage(features.build_features(fact, zones, config), "features")
        days = features.check_no_future_leakage(fact, zones, config, full=table)
        return snapshots.write_snapshot(
            table, snapshot_root, version or f"v{now:%Y-%m-%d}", config, days, fact.count(), runs, now
        )


def update_features(
    fact: DataFrame, dim_location: DataFrame, config: features.FeatureConfig, path: str, first: dt.date, last: dt.date
) -> None:
    """Write the features of the days from ``first`` to ``last`` into the table at ``path``, one folder for each day.

    Only those days and the 14 before them are read from the trips; folders of other days are left as
    they are, and days that are there already are replaced, so an update may be repeated. Day by day
    the table becomes that of a full build with the same zones; a zone that is new brings rows for
    the updated days only.
    """
    start = max(config.grid_start, first - dt.timedelta(days=features.LOOKBACK_DAYS))
    until = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    built = features.build_features(fact, dim_location, config, cutoff=until, grid_start=start, grid_end=last)
    days = built.filter(F.col("forecast_date").between(F.lit(first), F.lit(last)))
    # One task for each day's share, so that a day is one file unless it is large.
    spread = days.hint("rebalance", "forecast_date").sortWithinPartitions("forecast_date", "zone_id", "hour_start")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("forecast_date").parquet(path)


def read_features(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def score_snapshot(
    spark: SparkSession, snapshot_root: str, version: str | None = None, split: str = "validate", final: bool = False
) -> DataFrame:
    """Scores from the stored snapshot only, after its fingerprint was verified."""
    if split == "test" and not final:
        raise ValueError("the test split is scored once, at the very end: pass final=True to confirm")
    table, manifest = snapshots.verify_snapshot(spark, snapshot_root, version)
    return forecast.score_baselines(table, split, final).withColumn("version", F.lit(manifest["version"]))


def write_report(result: DataFrame, path: str, title: str, formats: dict[str, str]) -> None:
    """A small result table as a text a reader can open: a heading, then a table of its columns.

    ``formats`` gives a printf pattern for each column shown, in order; only for results of a few rows.
    """
    columns = list(formats)
    shown = [F.coalesce(F.format_string(pattern, F.col(c)), F.lit("-")) for c, pattern in formats.items()]
    names = "| " + " | ".join(columns) + " |"
    rule = "|" + "|".join([" --- "] * len(columns)) + "|"
    head = result.sparkSession.createDataFrame([(i, line) for i, line in enumerate((f"# {title}", "", names, rule))], "at long, line string")
    # Results are ordered by their producer; a few rows, so one task numbers and writes them.
    body = result.coalesce(1).select((F.monotonically_increasing_id() + 4).alias("at"), F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |")).alias("line"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("at").select("line").write.mode("overwrite").text(path)


def write_results(result: DataFrame, path: str) -> None:
    """A small result table as one CSV file; only for results of a few rows, such as scores."""
    result.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
