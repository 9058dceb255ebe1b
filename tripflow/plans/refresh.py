"""Publishing the mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripflow.functions.calendar import month_bounds, ntz
from tripflow.operators.mart import build_mart
from tripflow.sources.warehouse import MART_TABLE, Warehouse


def refresh_mart(wh: Warehouse, refreshed_at: dt.datetime | None = None, months: list[str] | None = None) -> int:
    """Publish the mart anew and return its rows.

    With ``months`` only those months of the fact are read: a date belongs to one month, so the rows
    of all others are taken over from the version before. The result is the same as a full rebuild.
    """
    at = refreshed_at or dt.datetime.now()
    fact = wh.read("fact_trip")
    previous = wh.read_mart() if months and wh.exists(MART_TABLE) else None
    if previous is not None:
        fact = fact.filter(F.col("trip_month").isin(months))
    rows = build_mart(fact, wh.read("dim_date"), wh.read("dim_location"), wh.read("dim_payment"), at)
    if previous is not None:
        day = F.col("pickup_date")
        kept = previous
        for month in months:
            start, end = month_bounds(month)
            kept = kept.filter(~((day >= F.lit(start.date())) & (day < F.lit(end.date()))))
        rows = rows.unionByName(kept.withColumn("refreshed_at", ntz(at)))
    return wh.publish_mart(rows)
