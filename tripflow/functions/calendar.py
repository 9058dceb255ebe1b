"""Date and time expressions on zone-less timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (``F.lit(datetime)`` would be zoned)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_key(ts: Column) -> Column:
    """YYYYMMDD as an integer, by arithmetic: no formatter per row."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("int")


def month_text(ts: Column) -> Column:
    """'YYYY-MM', the partition value of the fact table."""
    return F.concat(F.year(ts).cast("string"), F.lit("-"), F.lpad(F.month(ts).cast("string"), 2, "0"))


def iso_day_of_week(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def hour_of(ts: Column) -> Column:
    """Start of the hour. ``date_trunc`` would go through the session's time zone and its clock changes."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def minute_text(ts: Column) -> Column:
    """'YYYY-MM-DD HH:MM' of a zone-less timestamp, again without a time zone."""
    return F.substring(ts.cast("string"), 1, 16)


def month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    """First instant of 'YYYY-MM' and of the month after it."""
    start = dt.datetime.strptime(f"{month}-01", "%Y-%m-%d")
    end = start.replace(year=start.year + start.month // 12, month=start.month % 12 + 1)
    return start, end
