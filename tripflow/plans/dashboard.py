"""The views of the dashboard, all from the mart."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators import mart as m
from tripflow.session import stage

SCOPE = "_in_scope"


@dataclass(frozen=True)
class DashboardViews:
    total: DataFrame
    daily: DataFrame
    detail: DataFrame
    top: DataFrame
    zones: DataFrame


def dashboard_views(mart: DataFrame, start: dt.date, end: dt.date, zone: int | None = None) -> DashboardViews:
    """KPI row, daily series, newest-first detail, top-10 zones with labels, and the zone picker.

    The mart is read once: its sums by day and by zone, inside the scope and outside of it, are a small
    table (two rows for each day and zone at most), and every view is taken from that.
    """
    inside = F.coalesce(m.in_scope(start, end, zone), F.lit(False))
    grains = {"days": [SCOPE, "pickup_date"], "zones": [SCOPE, "pickup_location_id"]}
    sums = stage(m.grain_sums(mart.withColumn(SCOPE, inside), grains), "dashboard-sums")
    days, zones = sums.filter(f"grain = 'days' AND {SCOPE}"), sums.filter("grain = 'zones'")
    daily = m.summarise(days, ["pickup_date"])
    top = m.top_zones(zones.filter(SCOPE)).withColumn("zone", F.concat(F.lit("Zone "), F.col("pickup_location_id").cast("string")))
    return DashboardViews(
        total=m.summarise(days),
        daily=daily.orderBy("pickup_date"),
        detail=daily.orderBy(F.col("pickup_date").desc()),
        top=top,
        zones=m.zones_by_trips(zones),
    )
