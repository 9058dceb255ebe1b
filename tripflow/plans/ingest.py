"""The month job: scan, judge, quarantine, load, publish, with the ledger around it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.functions.keys import add_trip_id
from tripflow.operators import ledger, rules, star
from tripflow.plans.refresh import refresh_mart
from tripflow.session import stage, staging_scope
from tripflow.sources import raw, warehouse
from tripflow.sources.warehouse import Warehouse


def judge_batch(batch: DataFrame, ctx: rules.CheckContext) -> DataFrame:
    """Key and judge a raw batch, staged once and split on disk into accepted and rejected rows.

    Every later step reads the staged table, pruned to its half and its columns, so keys are hashed
    and duplicates found once per run, and a lost executor never re-runs them.
    """
    judged = rules.judge(add_trip_id(batch), ctx)
    flagged = judged.withColumn("_accepted", F.col("reason_codes") == "")
    return stage(flagged, "judged", partition_by=["_accepted"])


def count_columns(ctx: rules.CheckContext) -> list[Column]:
    """All row counts of a run as aggregates over a judged batch: totals, reasons, soft rules and missing values."""
    codes = [rule.code for rule in rules.HARD_RULES]
    passed = F.col("_accepted")
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(passed).alias("rows_valid"),
        F.count_if(passed & F.col("is_anomaly")).alias("anomalies"),
        *[F.count_if(F.find_in_set(F.lit(c), F.col("reason_codes")) > 0).alias(f"hard:{c}") for c in codes],
        *[F.count_if(passed & rule.fails(ctx)).alias(f"soft:{rule.code}") for rule in rules.SOFT_RULES],
        *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in schemas.RAW_COLUMNS],
    ]


def batch_counts(judged: DataFrame, ctx: rules.CheckContext) -> dict:
    """The counts of a run, from one pass over the judged and stored batch, which reads no key.

    Observing these aggregates while the table is written took several times as long as this pass:
    an observation is evaluated row by row outside the compiled stage.
    """
    return counts(judged.agg(*count_columns(ctx)).first().asDict())


def counts(row: dict) -> dict:
    """The counts of a run, by name and group, from the values of ``count_columns``."""

    def group(prefix: str) -> dict[str, int]:
        return {k.removeprefix(prefix): n for k, n in row.items() if k.startswith(prefix)}

    read = row["rows_read"]
    return {
        "rows_read": read,
        "rows_valid": row["rows_valid"],
        "rows_rejected": read - row["rows_valid"],
        "anomaly_rows": row["anomalies"],
        "reject_reason_counts": {c: n for c, n in group("hard:").items() if n},
        "soft_anomaly_counts": group("soft:"),
        "null_rates": {c: n / read for c, n in group("null:").items()} if read else {},
    }


def load_month(
    wh: Warehouse,
    batch: DataFrame,
    month: str,
    source_file: str,
    run_id: int,
    now: dt.datetime,
    log_dir: str | None = None,
) -> dict:
    """Everything of a run but its ledger entries.

    The writes commit one by one, in this order; each is insert-if-absent or a full replacement, so
    replaying a run that died in between completes it.
    """
    wh.ensure_seeds()
    vendor, payment, rate_code = (wh.read(t) for t in warehouse.SEEDED)
    ctx = rules.context_from_dims(vendor, payment, rate_code, month, now)

    judged = judge_batch(batch, ctx)
    summary = batch_counts(judged, ctx)
    good = judged.filter("_accepted")
    bad = judged.filter("NOT _accepted")

    if log_dir is not None:
        log = rules.rejected_log(judged)
        log.write.mode("overwrite").option("header", True).csv(f"{log_dir}/rejected_{month}")
    summary["rows_quarantined"] = (
        warehouse.insert_quarantine(wh, rules.quarantine_rows(bad, source_file, month, now), unique=True)
        if summary["rows_rejected"]
        else 0
    )

    warehouse.insert_dimension(wh, "dim_date", star.date_rows(good), "date_key")
    warehouse.insert_dimension(wh, "dim_location", star.location_rows(good), "location_key")

    # Accepted rows lie in the file's month, by rule, and in the judged table, whose places number them.
    placed = raw.with_position(good.drop(raw.POSITION))
    facts = star.fact_rows(placed, vendor, payment, rate_code, keep=(raw.POSITION,))
    summary["rows_inserted"] = warehouse.insert_fact(
        wh, facts, unique=True, stored=placed, months=[month], expected=summary["rows_valid"]
    )
    summary["rows_skipped"] = summary["rows_valid"] - summary["rows_inserted"]
    summary["fact_trip_count"] = wh.read("fact_trip").count()
    summary["quarantine_trip_count"] = wh.read("quarantine_trip").count()
    # This month, and any month an earlier run left unpublished; one row per month in the ledger.
    unpublished = ledger.unpublished_months(wh.read(ledger.TABLE)).collect()
    summary["mart_rows"] = refresh_mart(wh, now, months=sorted({month, *(r["month"] for r in unpublished)}))
    return summary


def ingest_month(
    spark: SparkSession,
    month: str,
    raw_dir: str,
    warehouse_root: str,
    now: dt.datetime | None = None,
    log_dir: str | None = None,
    pattern: str = raw.MONTH_FILE,
) -> dict:
    """Ingest one month. A second run of the same file adds nothing. Returns the run summary.

    The ledger holds the run as running, then as success or failed with the error, so a failed run
    is visible to readers of the mart.
    """
    wh = Warehouse(spark, warehouse_root)
    return ingest_batch(wh, lambda: raw.read_month(spark, raw_dir, month, pattern), month, pattern.format(month=month), now, log_dir)


def ingest_batch(
    wh: Warehouse,
    read: Callable[[], DataFrame],
    month: str,
    source_file: str,
    now: dt.datetime | None = None,
    log_dir: str | None = None,
) -> dict:
    """Load what ``read`` returns as one run of the ledger; a scan that fails is a failed run too."""
    run_id = ledger.start_run(wh, month, now)
    try:
        batch = read()
        with staging_scope(wh.spark):
            summary = load_month(wh, batch, month, source_file, run_id, now or dt.datetime.now(), log_dir)
    except Exception as exc:
        ledger.finish_run(wh, run_id, month, "failed", now, error=f"{type(exc).__name__}: {exc}")
        raise
    ledger.finish_run(
        wh, run_id, month, "success", now, rows_inserted=summary["rows_inserted"], mart_rows=summary["mart_rows"]
    )
    return {**summary, "run_id": run_id}
