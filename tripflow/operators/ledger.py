"""Run ledger: append-only events, with the state of a run taken from its last event."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.sources.warehouse import Warehouse

TABLE = "pipeline_run"
STATUSES = ("running", "success", "failed")


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: its start, and status, end and result of its last event."""
    is_end = F.col("status") != "running"
    last = F.struct("status", "error", "rows_inserted", "mart_rows")
    return (
        events.groupBy("run_id")
        .agg(
            F.max("month").alias("month"),
            F.min("at").alias("started_at"),
            F.max(F.when(is_end, F.col("at"))).alias("finished_at"),
            F.max_by(last, "seq").alias("_last"),
        )
        .select("run_id", "month", "started_at", "finished_at", "_last.*")
    )


def latest_run(events: DataFrame) -> DataFrame:
    return run_states(events).orderBy(F.col("run_id").desc()).limit(1)


def successful_runs(events: DataFrame) -> DataFrame:
    return run_states(events).filter("status = 'success'").select("run_id", "month", "finished_at")


def unpublished_months(events: DataFrame) -> DataFrame:
    """Months whose last run did not succeed: the fact may hold rows of them that the mart lacks."""
    return (
        run_states(events)
        .groupBy("month")
        .agg(F.max_by("status", "run_id").alias("status"))
        .filter("status <> 'success'")
        .select("month")
    )


def _record(wh: Warehouse, **event) -> None:
    row = tuple(event.get(name) for name in schemas.LEDGER.fieldNames())
    wh.append(TABLE, wh.spark.createDataFrame([row], schemas.LEDGER).coalesce(1))


def start_run(wh: Warehouse, month: str, at: dt.datetime | None = None) -> int:
    """Record a run as running; run ids increase. One loader at a time owns a warehouse."""
    last = wh.read(TABLE).agg(F.max("run_id")).first()[0]
    run_id = (last or 0) + 1
    _record(wh, run_id=run_id, seq=0, month=month, status="running", at=at or dt.datetime.now())
    return run_id


def finish_run(
    wh: Warehouse,
    run_id: int,
    month: str,
    status: str,
    at: dt.datetime | None = None,
    error: str | None = None,
    rows_inserted: int | None = None,
    mart_rows: int | None = None,
) -> None:
    if status not in STATUSES[1:]:
        raise ValueError(f"a run ends as success or failed, not {status}")
    _record(
        wh,
        run_id=run_id,
        seq=1,
        month=month,
        status=status,
        at=at or dt.datetime.now(),
        error=error,
        rows_inserted=rows_inserted,
        mart_rows=mart_rows,
    )
