"""Is the published mart fresh? Computed from the data and the ledger, never typed by hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.calendar import minute_text, ntz
from tripflow.operators.ledger import TABLE as LEDGER_TABLE
from tripflow.operators.ledger import latest_run
from tripflow.sources.warehouse import MART_TABLE, Warehouse

# A run still running after this long is taken for crashed.
STUCK_AFTER = "INTERVAL 2 HOURS"


def _minute(ts: Column) -> Column:
    return F.coalesce(minute_text(ts), F.lit("unknown"))


def freshness_of(mart: DataFrame, events: DataFrame, now: dt.datetime) -> DataFrame:
    """One row: level, message, data_as_of, refreshed_at and the latest run."""
    published = mart.agg(F.max("last_pickup_datetime").alias("data_as_of"), F.max("refreshed_at").alias("refreshed_at"))
    # Both sides are exactly one row (at most one run), so the constant key joins one row to one.
    state = published.withColumn("_one", F.lit(1)).join(
        latest_run(events).withColumn("_one", F.lit(1)), "_one", "left"
    )
    as_of, refreshed = _minute(F.col("data_as_of")), _minute(F.col("refreshed_at"))
    run, month = F.col("run_id").cast("string"), F.col("month")
    no_run = F.col("run_id").isNull()
    failed = F.col("status") == "failed"
    running = F.col("status") == "running"
    stuck = running & (ntz(now) - F.col("started_at") > F.expr(STUCK_AFTER))
    # The wording of the verdicts.
    message = (
        F.when(
            no_run,
            F.concat(
                F.lit("No pipeline run is recorded for this mart, so its freshness cannot be vouched for. "),
                F.lit("Showing data as of "), as_of, F.lit("."),
            ),
        )
        .when(
            failed,
            F.concat(
                F.lit("The latest refresh failed: ingest run "), run, F.lit(" for "), month, F.lit(" at "),
                _minute(F.col("finished_at")), F.lit(" ("), F.coalesce("error", F.lit("unknown")),
                F.lit("). Showing data as of "), as_of, F.lit(", last refreshed "), refreshed, F.lit("."),
            ),
        )
        .when(
            stuck,
            F.concat(
                F.lit("Ingest run "), run, F.lit(" for "), month, F.lit(" started "), _minute(F.col("started_at")),
                F.lit(" and never finished. Showing data as of "), as_of, F.lit("."),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("Data as of "), as_of, F.lit(". Refreshed by the pipeline at "), refreshed, F.lit("."),
                F.when(running, F.concat(F.lit(" A refresh for "), month, F.lit(" is in progress."))).otherwise(F.lit("")),
            )
        )
    )
    level = F.when(no_run | F.coalesce(failed | stuck, F.lit(False)), "stale").otherwise("fresh")
    return state.select(
        level.alias("level"), message.alias("message"), "data_as_of", "refreshed_at", "run_id", "month", "status", "error"
    )


def freshness(wh: Warehouse, now: dt.datetime | None = None) -> dict:
    """The verdict for a warehouse; ``missing`` before the first publication."""
    if not wh.exists(MART_TABLE):
        message = f"{MART_TABLE} has not been published yet. Run the ingest pipeline."
        return {"level": "missing", "message": message, "data_as_of": None, "refreshed_at": None, "latest_run": None}
    row = freshness_of(wh.read_mart(), wh.read(LEDGER_TABLE), now or dt.datetime.now()).first().asDict()
    run = {k: row.pop(k) for k in ("run_id", "month", "status", "error")}
    row["latest_run"] = run if run["run_id"] is not None else None
    return row
