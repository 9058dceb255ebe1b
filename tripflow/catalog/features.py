"""Queries on the feature table, its windows, the leakage check, snapshots and forecasts."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.catalog.oracle import FEATURE_COLUMNS, with_features, with_grid
from tripflow.catalog.registry import Sample, query
from tripflow.operators import compare, features as ft
from tripflow.operators import forecast, snapshots
from tripflow.plans.feature_build import read_features, update_features, write_report, write_results
from tripflow.sources.sample import EVENT_CONFIG

CUTOFF = dt.datetime(2024, 1, 20, 12, 30)
_NOW = dt.datetime(2024, 2, 1)


@query(
    "calendar_features_o27",
    with_features(
        """SELECT DISTINCT CAST(forecast_date AS VARCHAR) AS forecast_date, prediction_made_at, hour_of_day, day_of_week,
             is_weekend, is_public_holiday FROM features"""
    ),
)
def calendar_features(s: Sample) -> DataFrame:
    day = F.col("forecast_date")
    return s.grid.select(
        day,
        day.cast("timestamp_ntz").alias("prediction_made_at"),
        "hour_of_day",
        *ft.calendar_features(day, EVENT_CONFIG.public_holidays),
    ).distinct()


@query("split_label_o28", with_features("SELECT split, CAST(forecast_date AS VARCHAR) AS day, count(*) AS rows FROM features GROUP BY ALL"))
def split_label(s: Sample) -> DataFrame:
    label = ft.split_label(F.col("forecast_date"), EVENT_CONFIG)
    return s.grid.groupBy(label.alias("split"), F.col("forecast_date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "cutoff_demand_o38",
    """SELECT CAST(user_id AS INTEGER) AS zone_id, date_trunc('hour', ts) AS hour_start, count(*) AS trips
       FROM events WHERE ts < TIMESTAMP '2024-01-20 12:30:00' GROUP BY ALL""",
)
def cutoff_demand(s: Sample) -> DataFrame:
    return ft.hourly_demand(s.pickups, s.zones, CUTOFF)


@query(
    "zone_hours_o46",
    with_grid("SELECT zone_id, hour_start FROM per_hour"),
)
def zone_hours(s: Sample) -> DataFrame:
    return ft.zone_hours(s.zones, EVENT_CONFIG.grid_start, EVENT_CONFIG.grid_end)


@query(
    "dense_grid_o47",
    with_grid(
        """SELECT zone_id, hour_start, CAST(n AS BIGINT) AS trips, CAST(day AS VARCHAR) AS forecast_date, hod AS hour_of_day
           FROM per_hour"""
    ),
)
def dense_grid(s: Sample) -> DataFrame:
    return s.grid


@query(
    "hourly_with_daily_o48",
    with_grid(
        """SELECT h.zone_id, h.hour_start, h.n AS trips, d.n AS day_trips
           FROM per_hour h JOIN per_day d ON h.zone_id = d.zone_id AND h.day = d.day"""
    ),
)
def hourly_with_daily(s: Sample) -> DataFrame:
    grid = s.grid
    joined = grid.join(ft.daily_demand(grid), ["zone_id", "forecast_date"])
    return joined.select("zone_id", "hour_start", "trips", "day_trips")


@query(
    "hourly_demand_o63",
    """SELECT CAST(user_id AS INTEGER) AS zone_id, date_trunc('hour', ts) AS hour_start, count(*) AS trips
       FROM events GROUP BY ALL""",
)
def hourly_demand(s: Sample) -> DataFrame:
    return ft.hourly_demand(s.pickups, s.zones)


@query("daily_demand_o64", with_grid("SELECT zone_id, CAST(day AS VARCHAR) AS forecast_date, n AS day_trips FROM per_day"))
def daily_demand(s: Sample) -> DataFrame:
    return ft.daily_demand(s.grid)


def _register_window(name: str, column: str, expression, sql: str) -> None:
    @query(name, sql)
    def window(s: Sample) -> DataFrame:
        grid = s.grid.withColumn("_day", F.unix_date("forecast_date"))
        return grid.select("zone_id", "hour_start", expression().alias(column))


def _hourly(column: str, source: str) -> str:
    return with_features(f"SELECT zone_id, hour_start, {source} AS {column} FROM hour_history")


def _daily(column: str, source: str) -> str:
    return with_features(
        f"""SELECT g.zone_id, g.hour_start, d.{source} AS {column} FROM per_hour g
            JOIN day_history d ON g.zone_id = d.zone_id AND g.day = d.day"""
    )


_register_window("same_hour_lag_1d_o82", "lag_1d", ft.lag_1d, _hourly("lag_1d", "lag_1d"))
_register_window("same_hour_lag_7d_o83", "lag_7d", ft.lag_7d, _hourly("lag_7d", "lag_7d"))
_register_window("same_hour_mean_7d_o84", "mean_7d", ft.mean_7d, _hourly("mean_7d", "mean_7d"))
_register_window("previous_day_o85", "previous_day", ft.previous_day, _daily("previous_day", "previous_day"))
_register_window("trailing_week_o86", "week_1", ft.last_7_days, _daily("week_1", "week_1"))
_register_window("week_before_o86", "week_2", ft.days_8_to_14, _daily("week_2", "week_2"))
_register_window("days_of_history_o87", "days_known", ft.days_of_history, _daily("days_known", "days_known"))


@query(
    "trend_7d_o88",
    with_features("SELECT zone_id, hour_start, zone_trips_trend_7d, history_complete FROM features"),
)
def trend_7d(s: Sample) -> DataFrame:
    history = ft.with_history(s.grid)
    return history.select(
        "zone_id",
        "hour_start",
        ft.trend_7d().alias("zone_trips_trend_7d"),
        (F.col("days_of_history") == ft.LOOKBACK_DAYS).alias("history_complete"),
    )


@query("build_features_o102", with_features(f"SELECT {FEATURE_COLUMNS} FROM features"))
def build_features(s: Sample) -> DataFrame:
    return ft.build_features(s.pickups, s.zones, EVENT_CONFIG)


@query("incremental_features_o102", with_features(f"SELECT {FEATURE_COLUMNS} FROM features"))
def incremental_features(s: Sample) -> DataFrame:
    """Three weeks at once, then day after day, one of them twice: the full build's table."""
    path, start = s.scratch("features-by-day"), EVENT_CONFIG.grid_start
    steps = [(0, 20), (21, 26), (27, 27), (28, 28), (28, 28), (29, 29)]
    for first, last in steps:
        update_features(s.pickups, s.zones, EVENT_CONFIG, path, start + dt.timedelta(days=first), start + dt.timedelta(days=last))
    return read_features(s.spark, path, s.features)


_CHECKED = """SELECT CAST(forecast_date AS VARCHAR) AS check_day, count(*) AS rows_checked, {differing} AS differing_rows
  FROM features WHERE forecast_date IN (DATE '2024-01-17', DATE '2024-01-23', DATE '2024-01-28') GROUP BY 1"""


@query("leakage_check_o103", with_features(_CHECKED.format(differing="CAST(0 AS BIGINT)")))
def leakage_check(s: Sample) -> DataFrame:
    return ft.leakage_report(s.pickups, s.zones, EVENT_CONFIG)


def leaky_build(*args, **kwargs) -> DataFrame:
    """A build with a planted leak: "same hour yesterday" is the hour itself."""
    return ft.build_features(*args, **kwargs).withColumn("trips_same_hour_lag_1d", F.col(ft.TARGET_COLUMN))


@query(
    "planted_leak_o103",
    with_features(_CHECKED.format(differing="count(*) FILTER (WHERE target_trips > 0)")),
)
def planted_leak(s: Sample) -> DataFrame:
    """Every hour with pickups differs once the day is cut off."""
    return ft.leakage_report(s.pickups, s.zones, EVENT_CONFIG, build=leaky_build)


@query(
    "frame_equality_o96",
    with_features("SELECT split, count(*) AS rows_left, count(*) AS rows_right, CAST(0 AS BIGINT) AS only_in_one FROM features GROUP BY 1"),
)
def frame_equality(s: Sample) -> DataFrame:
    """Two builds of the same features compared row by row, per split."""
    return compare.frame_differences(s.features, ft.build_features(s.pickups, s.zones, EVENT_CONFIG), ["split"])


@query(
    "split_overview_o74",
    with_features(
        """SELECT split, count(*) AS rows, count(DISTINCT zone_id) AS zones, CAST(min(forecast_date) AS VARCHAR) AS first_day,
             count(*) FILTER (WHERE target_trips = 0) AS zero_rows FROM features GROUP BY 1"""
    ),
)
def split_overview(s: Sample) -> DataFrame:
    return ft.split_overview(s.features).orderBy("first_day")


_CORRELATED = ["trips_same_hour_lag_1d", "trips_same_hour_lag_7d", "trips_same_hour_mean_7d", "zone_trips_prev_day", "zone_trips_trend_7d"]
# Candidates that know the answer: value and errors of the same hour, and the day's total.
_CUT = ["same_hour_value", "same_hour_errors", "zone_day_total"]


@query(
    "train_correlation_o79",
    with_features(
        """, candidates AS (
             SELECT f.*, coalesce(e.v, 0) AS same_hour_value, coalesce(e.k, 0) AS same_hour_errors, d.n AS zone_day_total
             FROM features f
             LEFT JOIN (SELECT user_id, date_trunc('hour', ts) AS h, CAST(sum(CAST(value * 100 AS DECIMAL(12,0))) AS DOUBLE) AS v,
                          count(*) FILTER (WHERE event_type = 'error') AS k FROM events GROUP BY ALL) e
               ON e.user_id = f.zone_id AND e.h = f.hour_start
             JOIN per_day d ON d.zone_id = f.zone_id AND d.day = f.forecast_date
             WHERE split = 'train')
           SELECT column_name, count(x) AS pairs, round(corr(x, y), 9) AS r FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x, CAST(target_trips AS DOUBLE) AS y FROM candidates WHERE {c} IS NOT NULL"
            for c in _CORRELATED + _CUT
        )
        + ") GROUP BY 1"
    ),
)
def train_correlation(s: Sample) -> DataFrame:
    """Kept features and cut candidates against the target."""
    same_hour = s.pickups.groupBy(
        F.col("pickup_location_key").alias("zone_id"), ft.hour_of(F.col("pickup_datetime")).alias("hour_start")
    ).agg(
        F.sum("cents").alias("same_hour_value"),
        F.count_if(F.col("event_type") == "error").alias("same_hour_errors"),
    )
    days = ft.daily_demand(s.grid).withColumnRenamed("day_trips", "zone_day_total")
    table = (
        s.features.join(same_hour, ["zone_id", "hour_start"], "left")
        .fillna(0, ["same_hour_errors"])
        .withColumn("same_hour_value", F.coalesce("same_hour_value", F.lit(0)))
        .join(days, ["zone_id", "forecast_date"])
    )
    return ft.train_correlations(table, _CORRELATED + _CUT).withColumn("r", F.round("r", 9))


# -- snapshots ------------------------------------------------------------------------------------


def _snapshot(s: Sample, version: str = "v2024-02-01") -> tuple[str, dict]:
    root = s.scratch("snapshots")
    days = list(EVENT_CONFIG.leakage_check_days)
    return root, snapshots.write_snapshot(s.features, root, version, EVENT_CONFIG, days, created_at=_NOW)


@query("feature_export_o14", with_features(f"SELECT {FEATURE_COLUMNS} FROM features"))
def feature_export(s: Sample) -> DataFrame:
    path = s.scratch("export")
    snapshots.export_features(s.features, path)
    return s.spark.read.parquet(path)


_MANIFEST_SQL = """SELECT 'v2024-02-01' AS version, count(*) AS rows, count(DISTINCT zone_id) AS zones,
    count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'validate') AS validate_rows,
    'target_trips' AS target_column, '2024-01-17,2024-01-23,2024-01-28' AS leakage_check_days
  FROM features"""


@query("manifest_o15", with_features(_MANIFEST_SQL))
def manifest(s: Sample) -> DataFrame:
    root, _ = _snapshot(s)
    stored = s.spark.read.schema(snapshots.MANIFEST).json(f"{root}/v2024-02-01/manifest")
    return stored.select(
        "version",
        "rows",
        "zones",
        F.col("rows_per_split")["train"].alias("train_rows"),
        F.col("rows_per_split")["validate"].alias("validate_rows"),
        "target_column",
        F.concat_ws(",", "leakage_check_days").alias("leakage_check_days"),
    )


@query(
    "write_once_snapshot_o104",
    with_features(
        """SELECT split, count(*) AS rows, TRUE AS same_content_is_noop, TRUE AS other_content_refused
           FROM features GROUP BY 1"""
    ),
)
def write_once_snapshot(s: Sample) -> DataFrame:
    """A rebuild of the same content keeps the first manifest; other holidays are refused."""
    root, first = _snapshot(s)
    rebuilt = ft.build_features(s.pickups, s.zones, EVENT_CONFIG)
    again = snapshots.write_snapshot(rebuilt, root, "v2024-02-01", EVENT_CONFIG)
    other = dataclasses.replace(EVENT_CONFIG, public_holidays=())
    try:
        snapshots.write_snapshot(ft.build_features(s.pickups, s.zones, other), root, "v2024-02-01", other)
        refused = False
    except snapshots.SnapshotExistsError:
        refused = True
    table, _ = snapshots.verify_snapshot(s.spark, root)
    return table.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).select(
        "split",
        "rows",
        F.lit(again["created_at"] == first["created_at"]).alias("same_content_is_noop"),
        F.lit(refused).alias("other_content_refused"),
    )


@query(
    "verify_snapshot_o105",
    with_features(
        """SELECT CAST(zone_id AS INTEGER) AS zone_id, CAST(sum(target_trips) AS BIGINT) AS trips, TRUE AS change_detected
           FROM features GROUP BY 1"""
    ),
)
def verify_snapshot(s: Sample) -> DataFrame:
    """The stored rows pass; a snapshot that got the test rows a second time does not."""
    root, _ = _snapshot(s)
    table, _ = snapshots.verify_snapshot(s.spark, root, "v2024-02-01")
    touched, _ = _snapshot(s)
    table.filter("split = 'test'").write.mode("append").parquet(f"{touched}/v2024-02-01/{snapshots.FEATURE_TABLE}")
    try:
        snapshots.verify_snapshot(s.spark, touched)
        detected = False
    except snapshots.SnapshotModifiedError:
        detected = True
    return table.groupBy("zone_id").agg(F.sum("target_trips").alias("trips")).withColumn("change_detected", F.lit(detected))


@query(
    "changed_days_o105",
    with_features(
        """SELECT CAST(f.forecast_date AS VARCHAR) AS forecast_date, count(*) AS rows_recorded,
             CASE WHEN f.forecast_date = DATE '2024-01-27' THEN 2 * count(*) ELSE count(*) END AS rows_found,
             f.forecast_date IN (DATE '2024-01-27', DATE '2024-01-29') AS changed FROM features f GROUP BY f.forecast_date"""
    ),
)
def changed_days(s: Sample) -> DataFrame:
    """A snapshot with one day twice and one row of another day altered: both days are named."""
    root, _ = _snapshot(s)
    path = f"{root}/v2024-02-01/{snapshots.FEATURE_TABLE}"
    table = s.features
    one = table.where("forecast_date = '2024-01-29'").agg(F.min("zone_id")).first()[0]
    altered = (F.col("forecast_date") == "2024-01-29") & (F.col("zone_id") == one) & (F.col("hour_of_day") == 5)
    target = F.when(altered, F.col("target_trips") + 1).otherwise(F.col("target_trips"))
    table.withColumn("target_trips", target).union(table.where("forecast_date = '2024-01-27'")).write.mode("overwrite").parquet(path)
    return snapshots.compare_days(s.spark, root)


@query("latest_version_o94", with_features("SELECT 'v2024-02-10' AS version, count(*) AS rows FROM features"))
def latest_version(s: Sample) -> DataFrame:
    """The highest version that has a manifest; data without one does not count."""
    root = s.scratch("snapshots")
    for version in ("v2024-02-09", "v2024-02-10"):
        snapshots.write_snapshot(s.features, root, version, EVENT_CONFIG)
    snapshots.export_features(s.features, f"{root}/v2024-02-11/{snapshots.FEATURE_TABLE}")
    table, manifest = snapshots.verify_snapshot(s.spark, root)
    return table.agg(F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(manifest["version"]))


# -- forecasts ------------------------------------------------------------------------------------

_PROFILE = """, profile AS (
    SELECT zone_id, hour_of_day, is_weekend, CAST(sum(target_trips) AS DOUBLE) / count(*) AS train_profile
    FROM features WHERE split = 'train' GROUP BY ALL)"""


@query("train_profile_o72", with_features(_PROFILE + " SELECT * FROM profile"))
def train_profile(s: Sample) -> DataFrame:
    return forecast.train_profile(s.features)


@query(
    "profile_lookup_o51",
    with_features(
        _PROFILE
        + """ SELECT f.zone_id, f.hour_start, f.target_trips, p.train_profile
              FROM features f LEFT JOIN profile p USING (zone_id, hour_of_day, is_weekend) WHERE f.split = 'validate'"""
    ),
)
def profile_lookup(s: Sample) -> DataFrame:
    return forecast.predict(s.features, "validate").select("zone_id", "hour_start", "target_trips", "train_profile")


def _score_sql(split: str) -> str:
    predictions = {
        "same_hour_last_week": "CAST(trips_same_hour_lag_7d AS DOUBLE)",
        "same_hour_yesterday": "CAST(trips_same_hour_lag_1d AS DOUBLE)",
        "same_hour_mean_7d": "trips_same_hour_mean_7d",
        "train_profile": "train_profile",
    }
    errors = " UNION ALL ".join(
        f"SELECT '{name}' AS baseline, {p} - CAST(target_trips AS DOUBLE) AS e FROM scored" for name, p in predictions.items()
    )
    return with_features(
        _PROFILE
        + f""", scored AS (SELECT f.*, p.train_profile FROM features f
                LEFT JOIN profile p USING (zone_id, hour_of_day, is_weekend) WHERE f.split = '{split}')
            SELECT baseline, count(e) AS rows, round(avg(abs(e)), 7) AS mae, round(sqrt(avg(e * e)), 7) AS rmse
            FROM ({errors}) GROUP BY 1"""
    )


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select("baseline", "rows", F.round("mae", 7).alias("mae"), F.round("rmse", 7).alias("rmse"))


@query("forecast_scores_o73", _score_sql("validate"))
def forecast_scores(s: Sample) -> DataFrame:
    return _rounded(forecast.score(s.features, "validate"))


@query("score_baselines_o106", _score_sql("test"))
def score_baselines(s: Sample) -> DataFrame:
    """The one final evaluation, on the verified snapshot's test split."""
    root, _ = _snapshot(s)
    table, _ = snapshots.verify_snapshot(s.spark, root)
    return _rounded(forecast.score_baselines(table, "test", final=True))


@query("results_file_o17", _score_sql("train"))
def results_file(s: Sample) -> DataFrame:
    path = s.scratch("results")
    write_results(_rounded(forecast.score(s.features, "train")), path)
    return s.spark.read.option("header", True).schema("baseline string, rows long, mae double, rmse double").csv(path)




@query(
    "results_report_o17",
    f"""WITH scores AS ({_score_sql("validate")}),
      lines AS (
        SELECT 4 + row_number() OVER (ORDER BY mae, baseline) AS line_no,
          printf('| %s | %d | %.3f | %.3f |', baseline, rows, mae, rmse) AS line FROM scores
        UNION ALL SELECT * FROM (VALUES (1, '# Baselines on the validate split'), (2, ''), (3, '| baseline | rows | mae | rmse |'),
          (4, '| --- | --- | --- | --- |')) head(line_no, line))
      SELECT CAST(line_no AS INTEGER) AS line_no, line FROM lines""",
)
def results_report(s: Sample) -> DataFrame:
    """The scores as a table to read, line by line."""
    path = s.scratch("report")
    formats = {"baseline": "%s", "rows": "%d", "mae": "%.3f", "rmse": "%.3f"}
    write_report(_rounded(forecast.score(s.features, "validate")), path, "Baselines on the validate split", formats)
    lines = s.spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("at", "line"))
    last = F.max("at").over(Window.partitionBy(F.lit(0)))
    numbered = lines.select((F.col("at") + 1).alias("line_no"), "line", last.alias("last"))
    return numbered.where((F.col("line_no") <= F.col("last")) | (F.col("line") != "")).select("line_no", "line")
