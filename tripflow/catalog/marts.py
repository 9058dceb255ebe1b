"""Queries on the mart, its metrics and the dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.catalog.oracle import MART_COLUMNS, METRICS, with_trips
from tripflow.catalog.registry import Sample, query
from tripflow.functions.numbers import ratio
from tripflow.operators import mart as m
from tripflow.operators import reconcile
from tripflow.plans.dashboard import dashboard_views
from tripflow.sources.warehouse import Warehouse

# The dates the dashboard's picker is set to.
SCOPE = (dt.date(1996, 1, 1), dt.date(2000, 6, 30))
_IN_SCOPE = "pickup_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'"


@query("mart_build_o61", with_trips(f"SELECT {MART_COLUMNS} FROM mart"))
def mart_build(s: Sample) -> DataFrame:
    return s.build_mart(s.fact)


@query("mart_of_unjudged_trips_o61", with_trips(f"SELECT {MART_COLUMNS} FROM unjudged_mart", "unjudged_mart"))
def mart_of_unjudged_trips(s: Sample) -> DataFrame:
    """With trips of unknown zones: they share the NULL zone of their day."""
    return s.build_mart(s.unjudged_fact)


@query("mart_scan_o12", with_trips(f"SELECT {MART_COLUMNS} FROM mart"))
def mart_scan(s: Sample) -> DataFrame:
    return m.load_mart(s.mart)


@query("mart_publish_o13", with_trips(f"SELECT {MART_COLUMNS} FROM mart"))
def mart_publish(s: Sample) -> DataFrame:
    """Published twice: the second version replaces the first."""
    wh = Warehouse(s.spark, s.scratch("warehouse"))
    wh.publish_mart(s.mart.withColumn("trip_count", F.lit(0).cast("long")))
    wh.publish_mart(s.mart)
    return wh.read_mart()


_BY = {"pickup_date": "CAST(pickup_date AS VARCHAR)", "pickup_location_id": "CAST(pickup_location_id AS VARCHAR)"}


@query(
    "metric_rollup_o62",
    with_trips(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS grain, {group} AS member, {METRICS} FROM unjudged_mart {tail}"
            for name, group, tail in [
                ("total", "CAST(NULL AS VARCHAR)", ""),
                ("day", _BY["pickup_date"], "GROUP BY pickup_date"),
                ("zone", _BY["pickup_location_id"], "GROUP BY pickup_location_id"),
            ]
        ),
        "unjudged_mart",
    ),
)
def metric_rollup(s: Sample) -> DataFrame:
    """Grand total, per day, per zone (the NULL zone kept), from one pass."""
    mart = s.build_mart(s.unjudged_fact)
    rolled = m.summarise_grains(mart, {"total": [], "day": ["pickup_date"], "zone": ["pickup_location_id"]})
    member = F.coalesce(F.col("pickup_date").cast("string"), F.col("pickup_location_id").cast("string"))
    return rolled.select("grain", member.alias("member"), *m.METRIC_COLUMNS)


@query("summarise_cells_o100", with_trips(
    f"""SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_location_id, {METRICS}
        FROM mart GROUP BY mart.pickup_date, pickup_location_id"""))  # fmt: skip
def summarise_cells(s: Sample) -> DataFrame:
    return m.summarise(s.mart, ["pickup_date", "pickup_location_id"])


@query(
    "guarded_ratio_o29",
    with_trips(
        """SELECT pickup_date, pickup_location_id, CAST(card_tip_sum AS DOUBLE) / nullif(CAST(card_fare_sum AS DOUBLE), 0)
             AS tip_rate
           FROM (SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_location_id, card_tip_sum, card_fare_sum
                 FROM mart)"""
    ),
)
def guarded_ratio(s: Sample) -> DataFrame:
    rate = ratio(F.col("card_tip_sum"), F.col("card_fare_sum")).alias("tip_rate")
    return s.mart.select("pickup_date", "pickup_location_id", rate)


@query(
    "mart_against_fact_o76",
    with_trips(
        """SELECT 'mart' AS source, CAST(sum(trip_count) AS BIGINT) AS trips, CAST(sum(total_revenue) AS DOUBLE) AS revenue
           FROM mart
           UNION ALL SELECT 'fact', count(*), CAST(sum(total_amount) AS DOUBLE) FROM fact"""
    ),
)
def mart_against_fact(s: Sample) -> DataFrame:
    return reconcile.mart_against_fact(s.mart, s.fact)


@query("scope_filter_o37", with_trips(f"SELECT {MART_COLUMNS} FROM mart WHERE {_IN_SCOPE}"))
def scope_filter(s: Sample) -> DataFrame:
    return m.select_scope(s.mart, *SCOPE)


@query(
    "zoned_rows_o39",
    with_trips(
        f"SELECT {MART_COLUMNS} FROM unjudged_mart WHERE pickup_location_id IS NOT NULL", "unjudged_mart"
    ),
)
def zoned_rows(s: Sample) -> DataFrame:
    return m.with_zone(s.build_mart(s.unjudged_fact))


@query(
    "top_zones_o91",
    with_trips(
        f"""SELECT pickup_location_id, {METRICS} FROM mart WHERE pickup_location_id IS NOT NULL GROUP BY 1
            ORDER BY sum(mart.total_revenue) DESC, 1 LIMIT 10"""
    ),
)
def top_zones(s: Sample) -> DataFrame:
    return m.top_zones(s.mart)


@query(
    "presentation_order_o92",
    with_trips(
        """SELECT place, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_location_id, trip_count FROM (
             SELECT *, row_number() OVER (PARTITION BY pickup_date ORDER BY pickup_location_id NULLS LAST) AS place
             FROM unjudged_mart)""",
        "unjudged_mart",
    ),
)
def presentation_order(s: Sample) -> DataFrame:
    """The place of a zone among the rows of its day when the mart is shown: the NULL zone comes last."""
    by_day = Window.partitionBy("pickup_date").orderBy(F.col("pickup_location_id").asc_nulls_last())
    placed = s.build_mart(s.unjudged_fact).withColumn("place", F.row_number().over(by_day).cast("long"))
    return m.load_mart(placed.select("place", "pickup_date", "pickup_location_id", "trip_count"))


@query(
    "zones_by_trips_o93",
    with_trips(
        """SELECT pickup_location_id, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM mart
           WHERE pickup_location_id IS NOT NULL GROUP BY 1"""
    ),
)
def zones_by_trips(s: Sample) -> DataFrame:
    return m.zones_by_trips(s.mart)


def _views(s: Sample, zone: int | None = None):
    return dashboard_views(s.mart, *SCOPE, zone=zone)


@query("dashboard_total_o107", with_trips(f"SELECT {METRICS} FROM mart WHERE {_IN_SCOPE}"))
def dashboard_total(s: Sample) -> DataFrame:
    return _views(s).total


_DAILY = f"""SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, {METRICS} FROM mart WHERE {_IN_SCOPE}
  GROUP BY mart.pickup_date"""


@query("dashboard_daily_o107", with_trips(_DAILY))
def dashboard_daily(s: Sample) -> DataFrame:
    return _views(s).daily


@query("dashboard_detail_o107", with_trips(_DAILY))
def dashboard_detail(s: Sample) -> DataFrame:
    return _views(s).detail


@query(
    "dashboard_top_zones_o107",
    with_trips(
        f"""SELECT pickup_location_id, 'Zone ' || pickup_location_id AS zone, {METRICS} FROM mart WHERE {_IN_SCOPE}
            GROUP BY 1 ORDER BY sum(mart.total_revenue) DESC, 1 LIMIT 10"""
    ),
)
def dashboard_top_zones(s: Sample) -> DataFrame:
    return _views(s).top


@query(
    "dashboard_zone_days_o107",
    with_trips(
        f"""SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, {METRICS} FROM mart
            WHERE {_IN_SCOPE} AND pickup_location_id = 132 GROUP BY mart.pickup_date"""
    ),
)
def dashboard_zone_days(s: Sample) -> DataFrame:
    """The drill-down: daily figures of one zone."""
    return _views(s, zone=132).daily

