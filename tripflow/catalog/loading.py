"""Queries on sinks and jobs: each returns what was written, read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.catalog.oracle import MART_COLUMNS, MONTH_RULE, judged, with_trips
from tripflow.catalog.registry import Sample, query
from tripflow.operators import freshness, layout, ledger, reconcile, rules
from tripflow.plans.ingest import ingest_month
from tripflow.plans.refresh import refresh_mart
from tripflow.sources import warehouse
from tripflow.sources.raw import with_position
from tripflow.sources.sample import SAMPLE_MONTH, SAMPLE_NOW
from tripflow.sources.warehouse import MART_TABLE, Warehouse

_MONTH_JUDGED = judged(MONTH_RULE)


def _rows() -> Column:
    return F.count(F.lit(1))


def _one_month(body: str, upto: str = "mart") -> str:
    return with_trips(body, upto, judged_as=_MONTH_JUDGED)


@query("rejected_log_o06", with_trips("SELECT trip_id, reason_codes AS reason FROM bad", "judged"))
def rejected_log(s: Sample) -> DataFrame:
    """Written twice: the log is overwritten, not appended."""
    path = s.scratch("rejected")
    for _ in range(2):
        rules.rejected_log(s.judged).write.mode("overwrite").option("header", True).csv(path)
    return s.spark.read.option("header", True).schema("trip_id string, reason string").csv(path)


@query(
    "quarantine_insert_o07",
    with_trips(
        """SELECT trip_id, reason_codes, source_file, ingest_month, total_amount, added_again FROM (
             SELECT *, 'sample.parquet' AS source_file, '1998-05' AS ingest_month, CAST(0 AS BIGINT) AS added_again,
               row_number() OVER (PARTITION BY trip_id ORDER BY copy) AS n FROM bad) WHERE n = 1""",
        "judged",
    ),
)
def quarantine_insert(s: Sample) -> DataFrame:
    """Inserted twice: the second time adds nothing."""
    wh = Warehouse(s.spark, s.scratch("warehouse"))
    rows = rules.quarantine_rows(rules.rejected(s.judged), "sample.parquet", SAMPLE_MONTH, SAMPLE_NOW)
    warehouse.insert_quarantine(wh, rows)
    again = warehouse.insert_quarantine(wh, rows, unique=True)
    return wh.read("quarantine_trip").select(
        "trip_id", "reason_codes", "source_file", "ingest_month", "total_amount", F.lit(again).cast("long").alias("added_again")
    )


def _filled(s: Sample) -> Warehouse:
    """A warehouse with the fact table of all months, loaded in one batch."""
    wh, fact = s.new_warehouse(), with_position(s.fact)
    warehouse.insert_dimension(wh, "dim_date", s.dim_date, "date_key")
    warehouse.insert_dimension(wh, "dim_location", s.dim_location, "location_key")
    # The fact lies in a table already, whose places number it.
    warehouse.insert_fact(wh, fact, unique=True, stored=fact)
    return wh


@query(
    "fact_insert_o08",
    with_trips(
        """SELECT strftime(pickup_datetime, '%Y-%m') AS trip_month, count(*) AS rows, count(*) AS keys,
             CAST(sum(total_amount) AS DOUBLE) AS revenue, CAST(0 AS BIGINT) AS added_again
           FROM fact GROUP BY 1""",
        "fact",
    ),
)
def fact_insert(s: Sample) -> DataFrame:
    """Inserted twice; per month the rows, distinct surrogate keys and revenue."""
    wh = _filled(s)
    again = warehouse.insert_fact(wh, s.fact.withColumn("tip_amount", F.lit(0).cast(schemas.MONEY)))
    return (
        wh.read("fact_trip")
        .groupBy("trip_month")
        .agg(_rows().alias("rows"), F.count_distinct("trip_key").alias("keys"), F.sum("total_amount").alias("revenue"))
        .withColumn("added_again", F.lit(again).cast("long"))
    )


@query(
    "filtered_insert_o50",
    with_trips(
        """SELECT strftime(pickup_datetime, '%Y-%m') AS trip_month, count(*) AS rows, count(*) AS keys,
             count(*) FILTER (WHERE is_anomaly AND hour(pickup_datetime) < 12) AS rows_first,
             count(*) FILTER (WHERE is_anomaly AND hour(pickup_datetime) >= 12) AS rows_second
           FROM fact GROUP BY 1""",
        "fact",
    ),
)
def filtered_insert(s: Sample) -> DataFrame:
    """The morning's flagged trips, then the other flagged ones (the months' key filters know none), then all trips (they know some)."""
    wh = s.new_warehouse()
    flagged, morning = s.fact.filter("is_anomaly"), F.hour("pickup_datetime") < 12
    steps = [("first", flagged.filter(morning)), ("second", flagged.filter(~morning)), ("all", s.fact)]
    for name, rows in steps:
        warehouse.insert_fact(wh, rows.withColumn("passenger_count", F.lit(len(name)).cast("int")), check=False, unique=True)
    return (
        wh.read("fact_trip")
        .groupBy("trip_month")
        .agg(
            _rows().alias("rows"),
            F.count_distinct("trip_id").alias("keys"),
            F.count_if(F.col("passenger_count") == 5).alias("rows_first"),
            F.count_if(F.col("passenger_count") == 6).alias("rows_second"),
        )
    )


@query(
    "dim_date_upsert_o09",
    with_trips("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date", "dims"),
)
def dim_date_upsert(s: Sample) -> DataFrame:
    """A later row for a known date never updates it."""
    wh = Warehouse(s.spark, s.scratch("warehouse"))
    warehouse.insert_dimension(wh, "dim_date", s.dim_date.filter("month <= 6"), "date_key")
    changed = s.dim_date.withColumn("day_name", F.when(F.col("month") <= 6, "changed").otherwise(F.col("day_name")))
    warehouse.insert_dimension(wh, "dim_date", changed, "date_key")
    return wh.read("dim_date")


@query(
    "dim_location_upsert_o09", with_trips("SELECT location_key, location_id, 'first' AS borough FROM dim_location", "dims")
)
def dim_location_upsert(s: Sample) -> DataFrame:
    wh = Warehouse(s.spark, s.scratch("warehouse"))
    for name in ("first", "second"):
        rows = s.dim_location.withColumn("borough", F.lit(name))
        warehouse.insert_dimension(wh, "dim_location", rows, "location_key")
    return wh.read("dim_location").select("location_key", "location_id", "borough")


@query(
    "table_probe_o16",
    _one_month(
        """SELECT 'dim_date' AS table_name, TRUE AS present, (SELECT count(*) FROM dim_date) AS rows
           UNION ALL SELECT 'fact_trip', TRUE, (SELECT count(*) FROM fact)
           UNION ALL SELECT 'mart_daily_zone_trips', TRUE, (SELECT count(*) FROM mart)
           UNION ALL SELECT 'features_zone_hour', FALSE, CAST(0 AS BIGINT)"""
    ),
)
def table_probe(s: Sample) -> DataFrame:
    wh, _ = s.loaded
    found = [
        (name, present, wh.read(name).count() if present else 0)
        for name in ("dim_date", "fact_trip", MART_TABLE, "features_zone_hour")
        for present in [wh.exists(name)]
    ]
    return s.spark.createDataFrame(found, "table_name string, present boolean, rows long")


@query(
    "fact_without_key_o26",
    with_trips(
        """SELECT trip_id, date_key, rate_code_key, is_anomaly, strftime(pickup_datetime, '%Y-%m') AS trip_month,
             CAST(22 + 1 AS INTEGER) AS columns FROM fact""",
        "fact",
    ),
)
def fact_without_key(s: Sample) -> DataFrame:
    """The stored table without its surrogate key: the 22 batch columns and the month."""
    rows = _filled(s).read("fact_trip").drop("trip_key")
    return rows.select("trip_id", "date_key", "rate_code_key", "is_anomaly", "trip_month", F.lit(len(rows.columns)).alias("columns"))


_SUMMARY = """SELECT count(*) AS rows_read,
    count(*) FILTER (WHERE reason_codes = '') AS rows_valid,
    count(*) FILTER (WHERE reason_codes <> '') AS rows_rejected,
    count(DISTINCT trip_id) FILTER (WHERE reason_codes <> '') AS rows_quarantined,
    count(*) FILTER (WHERE reason_codes = '') AS rows_inserted,
    CAST(0 AS BIGINT) AS rows_skipped,
    (SELECT count(*) FROM mart) AS mart_rows
  FROM judged"""


@query("ingest_summary_o98", _one_month(_SUMMARY))
def ingest_summary(s: Sample) -> DataFrame:
    """All trips ingested as the file of one month: most fall outside it and are quarantined."""
    _, summary = s.loaded
    names = ["rows_read", "rows_valid", "rows_rejected", "rows_quarantined", "rows_inserted", "rows_skipped", "mart_rows"]
    row = tuple(int(summary[n]) for n in names)
    return s.spark.createDataFrame([row], ", ".join(f"{n} long" for n in names))


@query(
    "ingest_fact_o98",
    _one_month(
        "SELECT trip_id, date_key, vendor_key, CAST(total_amount AS DOUBLE) AS total_amount, is_anomaly FROM fact", "fact"
    ),
)
def ingest_fact(s: Sample) -> DataFrame:
    wh, _ = s.loaded
    return wh.read("fact_trip").select("trip_id", "date_key", "vendor_key", "total_amount", "is_anomaly")


@query(
    "ingest_quarantine_o98",
    _one_month(
        """SELECT trip_id, reason_codes, source_file FROM (
             SELECT *, 'yellow_tripdata_1998-05.parquet' AS source_file,
               row_number() OVER (PARTITION BY trip_id ORDER BY copy) AS n FROM bad) WHERE n = 1""",
        "judged",
    ),
)
def ingest_quarantine(s: Sample) -> DataFrame:
    wh, _ = s.loaded
    return wh.read("quarantine_trip").select("trip_id", "reason_codes", "source_file")


@query("ingest_mart_o98", _one_month(f"SELECT {MART_COLUMNS} FROM mart"))
def ingest_mart(s: Sample) -> DataFrame:
    wh, _ = s.loaded
    return wh.read_mart()


@query("refresh_mart_o99", with_trips(f"SELECT {MART_COLUMNS} FROM mart"))
def refresh(s: Sample) -> DataFrame:
    """A full rebuild, then a refresh of two months only: the result is the full one."""
    wh = _filled(s)
    refresh_mart(wh, dt.datetime(2000, 12, 31))
    refresh_mart(wh, SAMPLE_NOW, months=["1996-02", "1999-12"])
    return wh.read_mart()


@query(
    "partitioned_layout_o108",
    with_trips(
        """SELECT strftime(pickup_datetime, '%Y-%m') AS trip_month, pickup_location_key, count(*) AS trips
           FROM fact GROUP BY ALL""",
        "fact",
    ),
)
def partitioned_layout(s: Sample) -> DataFrame:
    """The stored fact, one folder per month, read back by month and zone."""
    return _filled(s).read("fact_trip").groupBy("trip_month", "pickup_location_key").agg(_rows().alias("trips"))


@query(
    "table_audit_o111",
    with_trips(
        """SELECT 'fact_trip before' AS table_name, count(*) AS rows, CAST(sum(total_amount) AS DOUBLE) AS revenue,
             count(DISTINCT trip_id) AS distinct_keys, FALSE AS key_missing FROM fact
           UNION ALL
           SELECT 'fact_trip after', count(*), CAST(sum(total_amount) AS DOUBLE), count(DISTINCT trip_id), FALSE FROM fact""",
        "fact",
    ),
)
def table_audit(s: Sample) -> DataFrame:
    """The fact before and after a rebuild from its own rows: same rows, revenue and keys."""
    before = _filled(s)
    after = Warehouse(s.spark, s.scratch("warehouse"))
    after.append("fact_trip", before.read("fact_trip"), partition_by="trip_month")
    audits = [
        reconcile.table_audit(f"fact_trip {name}", wh.read("fact_trip"), "total_amount", "trip_key", "trip_id")
        for name, wh in (("before", before), ("after", after))
    ]
    both = audits[0].unionByName(audits[1])
    return both.withColumn("key_missing", F.col("max_key").isNull()).drop("max_key")


def _ledger_after_failure(s: Sample) -> Warehouse:
    """The loaded warehouse's table copied, with one more run that finds no file."""
    loaded, _ = s.loaded
    wh = Warehouse(s.spark, s.scratch("warehouse"))
    wh.append(ledger.TABLE, loaded.read(ledger.TABLE))
    try:
        ingest_month(s.spark, "1998-06", "/nowhere", wh.root, now=SAMPLE_NOW)
    except FileNotFoundError:
        pass
    return wh


_RUN_1 = """SELECT CAST(1 AS BIGINT) AS run_id, '1998-05' AS month, TIMESTAMP '2001-01-01' AS started_at,
    TIMESTAMP '2001-01-01' AS finished_at, 'success' AS status, CAST(NULL AS VARCHAR) AS error,
    (SELECT count(*) FROM fact) AS rows_inserted, (SELECT count(*) FROM mart) AS mart_rows"""
_RUN_2 = """SELECT CAST(2 AS BIGINT) AS run_id, '1998-06' AS month, TIMESTAMP '2001-01-01' AS started_at,
    TIMESTAMP '2001-01-01' AS finished_at, 'failed' AS status,
    'FileNotFoundError: Raw file not found: /nowhere/yellow_tripdata_1998-06.parquet' AS error,
    CAST(NULL AS BIGINT) AS rows_inserted, CAST(NULL AS BIGINT) AS mart_rows"""


@query("run_ledger_o71", _one_month(f"{_RUN_1} UNION ALL {_RUN_2}"))
def run_ledger(s: Sample) -> DataFrame:
    return ledger.run_states(_ledger_after_failure(s).read(ledger.TABLE))


@query("latest_run_o90", _one_month(_RUN_2))
def latest_run(s: Sample) -> DataFrame:
    return ledger.latest_run(_ledger_after_failure(s).read(ledger.TABLE))


_STAMP = "strftime(max(last_pickup_datetime), '%Y-%m-%d %H:%M')"


@query(
    "freshness_o101",
    _one_month(
        f"""SELECT 'after success' AS state, 'fresh' AS level,
              'Data as of ' || {_STAMP} || '. Refreshed by the pipeline at 2001-01-01 00:00.' AS message,
              max(last_pickup_datetime) AS data_as_of FROM mart
            UNION ALL
            SELECT 'after failure', 'stale',
              'The latest refresh failed: ingest run 2 for 1998-06 at 2001-01-01 00:00 '
              || '(FileNotFoundError: Raw file not found: /nowhere/yellow_tripdata_1998-06.parquet). '
              || 'Showing data as of ' || {_STAMP} || ', last refreshed 2001-01-01 00:00.',
              max(last_pickup_datetime) FROM mart"""
    ),
)
def freshness_states(s: Sample) -> DataFrame:
    wh, _ = s.loaded
    fresh = freshness.freshness_of(wh.read_mart(), wh.read(ledger.TABLE), SAMPLE_NOW)
    failed = freshness.freshness_of(wh.read_mart(), _ledger_after_failure(s).read(ledger.TABLE), SAMPLE_NOW)
    both = fresh.withColumn("state", F.lit("after success")).unionByName(failed.withColumn("state", F.lit("after failure")))
    return both.select("state", "level", "message", "data_as_of")



_SHOWN = f"(SELECT max(last_pickup_datetime) AS latest, {_STAMP} AS stamp FROM mart)"


@query(
    "freshness_all_states_o101",
    _one_month(
        f"""SELECT 'missing' AS state, 'missing' AS level, 'mart_daily_zone_trips has not been published yet. Run the ingest pipeline.' AS message,
              CAST(NULL AS TIMESTAMP) AS data_as_of
            UNION ALL SELECT 'no run', 'stale', 'No pipeline run is recorded for this mart, so its freshness cannot be vouched for. '
              || 'Showing data as of ' || stamp || '.', latest FROM {_SHOWN}
            UNION ALL SELECT 'success', 'fresh', 'Data as of ' || stamp || '. Refreshed by the pipeline at 2001-01-01 00:00.', latest FROM {_SHOWN}
            UNION ALL SELECT 'failed', 'stale', 'The latest refresh failed: ingest run 2 for 1998-06 at 2001-01-01 00:00 '
              || '(FileNotFoundError: Raw file not found: /nowhere/yellow_tripdata_1998-06.parquet). '
              || 'Showing data as of ' || stamp || ', last refreshed 2001-01-01 00:00.', latest FROM {_SHOWN}
            UNION ALL SELECT 'in progress', 'fresh', 'Data as of ' || stamp || '. Refreshed by the pipeline at 2001-01-01 00:00. '
              || 'A refresh for 1998-07 is in progress.', latest FROM {_SHOWN}
            UNION ALL SELECT 'stuck', 'stale', 'Ingest run 3 for 1998-07 started 2001-01-01 01:00 and never finished. '
              || 'Showing data as of ' || stamp || '.', latest FROM {_SHOWN}"""
    ),
)
def freshness_all_states(s: Sample) -> DataFrame:
    """Every verdict a reader can get: before the first mart, without a run, and after each kind of run."""
    loaded, _ = s.loaded
    mart = loaded.read_mart()
    started = SAMPLE_NOW + dt.timedelta(hours=1)
    running = _ledger_after_failure(s)
    # A ledger of its own: Spark takes two scans of one folder for the same, though one is older.
    failed = freshness.freshness_of(mart, _ledger_after_failure(s).read(ledger.TABLE), SAMPLE_NOW)
    ledger.start_run(running, "1998-07", started)
    events = running.read(ledger.TABLE)
    verdict = freshness.freshness(Warehouse(s.spark, s.scratch("warehouse")))
    states = {
        "no run": freshness.freshness_of(mart, events.limit(0), SAMPLE_NOW),
        "success": freshness.freshness_of(mart, loaded.read(ledger.TABLE), SAMPLE_NOW),
        "failed": failed,
        "in progress": freshness.freshness_of(mart, events, started + dt.timedelta(hours=2)),
        "stuck": freshness.freshness_of(mart, events, started + dt.timedelta(hours=2, minutes=1)),
    }
    none = s.spark.createDataFrame([("missing", verdict["level"], verdict["message"], None)], "state string, level string, message string, data_as_of timestamp_ntz")
    for name, state in states.items():
        none = none.unionByName(state.select(F.lit(name).alias("state"), "level", "message", "data_as_of"))
    return none


@query(
    "clustered_layout_o108",
    with_trips(
        """SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS pickup_day, pickup_location_key, vendor_key, count(*) AS trips,
             CAST(sum(total_amount) AS DOUBLE) AS revenue, TRUE AS zone_reads_less, TRUE AS vendor_reads_less
           FROM fact GROUP BY 1, 2, 3""",
        "fact",
    ),
)
def clustered_layout(s: Sample) -> DataFrame:
    """The fact rewritten in a curve over zone and vendor: same rows, and fewer blocks to read for one zone or one vendor."""
    before, path = s.scratch("fact-as-it-comes"), s.scratch("fact-clustered")
    # The sample's days are too small to have blocks; its years stand for days.
    layout.write_in_blocks(layout.with_folder(s.fact, "year"), before, 200)
    layout.write_clustered(s.fact, path, block_rows=200, tasks=4, unit="year")
    less = {
        column: layout.blocks_read(s.spark, path, column, 200).select(F.avg("read").alias("after"))
        .crossJoin(layout.blocks_read(s.spark, before, column, 200).select(F.avg("read").alias("before")))
        .select(F.col("after") < F.col("before")).first()[0]
        for column in ("pickup_location_key", "vendor_key")
    }
    table = s.spark.read.parquet(path).groupBy(F.to_date("pickup_datetime").alias("pickup_day"), "pickup_location_key", "vendor_key")
    return table.agg(_rows().alias("trips"), F.sum("total_amount").alias("revenue")).select(
        "pickup_day", "pickup_location_key", "vendor_key", "trips", "revenue",
        F.lit(less["pickup_location_key"]).alias("zone_reads_less"), F.lit(less["vendor_key"]).alias("vendor_reads_less"),
    )
