"""Headline jobs on one JSON line: python bench.py

A month file is made from all order lines of ``$BENCH_SF_DIR`` (most trips valid, as in a real
month) and taken through the whole job; the steps the published baseline times are also timed one
by one, each on stored input.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.catalog.registry import Sample
from tripflow.functions.keys import add_trip_id
from tripflow.operators import analytics, features, forecast, mart, profiling, rules, star
from tripflow.plans.feature_build import build_and_snapshot
from tripflow.plans.ingest import ingest_month, judge_batch
from tripflow.plans.refresh import refresh_mart
from tripflow.session import local_session, stage
from tripflow.sources import raw, sample, warehouse
from tripflow.sources.warehouse import Warehouse

MONTH = "1998-05"
CONFIG = features.FeatureConfig(
    dt.date(1998, 5, 1),
    dt.date(1998, 5, 31),
    dt.date(1998, 5, 15),
    dt.date(1998, 5, 22),
    dt.date(1998, 5, 27),
    (dt.date(1998, 5, 25),),
    (dt.date(1998, 5, 17), dt.date(1998, 5, 24), dt.date(1998, 5, 28)),
)


def month_file(trips: DataFrame) -> DataFrame:
    """All sample trips moved into one month, with valid vendors and rides that end after they start."""
    day = F.dayofyear("tpep_pickup_datetime") % 31
    start = F.lit(f"{MONTH}-01 00:00:00").cast("timestamp_ntz")
    pickup = start + F.make_dt_interval(days=day, hours=F.hour("tpep_pickup_datetime"), mins=F.minute("tpep_pickup_datetime"))
    seconds = F.abs(F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp("tpep_pickup_datetime"))
    ride = F.make_dt_interval(mins=(seconds / 60 % 90).cast("int") + 1)
    vendors = F.array(*[F.lit(v).cast("long") for v in (1, 2, 6, 7)])
    return (
        trips.withColumn("_pickup", pickup)
        .withColumn("tpep_dropoff_datetime", F.col("_pickup") + ride)
        .withColumn("tpep_pickup_datetime", F.col("_pickup"))
        .withColumn("VendorID", F.get(vendors, (F.col("VendorID") % 4).cast("int")))
        .select(*schemas.RAW_COLUMNS)
    )


def enlarged(trips: DataFrame) -> DataFrame:
    """The trips, or with BENCH_ROWS set about that many: copies that differ in fare and so in key."""
    wanted, rows = int(os.environ.get("BENCH_ROWS", "0")), trips.count()
    copies = -(-wanted // rows) if wanted else 1
    if copies == 1:
        return trips
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_again")
    more = trips.select("*", copy).withColumn("fare_amount", F.col("fare_amount") + F.col("_again") / 100)
    return more.drop("_again")


def run(df: DataFrame) -> None:
    """Compute every row and column without writing them anywhere."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="tripflow-bench-")
    now = dt.datetime(2001, 1, 1)
    seconds: dict[str, float] = {}

    def timed(name: str, job, repeat: int = 1):
        times = []
        for _ in range(repeat):
            begin = time.perf_counter()
            result = job()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(sorted(times)[len(times) // 2], 3)
        return result

    # A delivery of several files, one per core; the sample table itself is one row group.
    delivery = month_file(enlarged(sample.line_trips(spark, folder))).repartition(int(cpus))
    delivery.write.parquet(f"{work}/raw/{raw.MONTH_FILE.format(month=MONTH)}")

    def month() -> DataFrame:
        return raw.read_month(spark, f"{work}/raw", MONTH)

    rows = month().count()
    first = timed("ingest_month", lambda: ingest_month(spark, MONTH, f"{work}/raw", f"{work}/wh", now))
    timed("ingest_replay", lambda: ingest_month(spark, MONTH, f"{work}/raw", f"{work}/wh", now))
    wh = Warehouse(spark, f"{work}/wh")

    # The steps of the job, each from stored input.
    ctx = rules.CheckContext(month=MONTH, now=now)
    timed("read_parquet", lambda: run(month()), 3)
    timed("completeness", lambda: run(profiling.null_rates(month())), 3)
    timed("trip_id", lambda: run(add_trip_id(month())), 3)
    timed("hard_checks", lambda: run(rules.judge(add_trip_id(month()), ctx)), 3)
    judged = timed("judge_batch", lambda: judge_batch(month(), ctx))
    good, bad = judged.filter("_accepted"), judged.filter("NOT _accepted")
    timed("soft_checks", lambda: run(rules.soft_counts(good, ctx)), 3)
    quarantine = rules.quarantine_rows(bad, "month.parquet", MONTH, now)
    seeds = [wh.read(t) for t in warehouse.SEEDED]
    fact_batch = raw.with_position(stage(star.fact_rows(good, *seeds), "fact-batch"))
    timed("prepare_fact_rows", lambda: run(star.fact_rows(good, *seeds)), 3)

    fresh = Warehouse(spark, f"{work}/fresh")
    fresh.ensure_seeds()
    timed("quarantine_write", lambda: warehouse.insert_quarantine(fresh, quarantine, unique=True))

    def dims() -> None:
        warehouse.insert_dimension(fresh, "dim_date", star.date_rows(good), "date_key")
        warehouse.insert_dimension(fresh, "dim_location", star.location_rows(good), "location_key")

    timed("dims_upsert", dims)
    timed("fact_insert", lambda: warehouse.insert_fact(fresh, fact_batch, unique=True, stored=fact_batch))
    timed("fact_insert_replay", lambda: warehouse.insert_fact(fresh, fact_batch, unique=True, stored=fact_batch))
    timed("mart_refresh", lambda: refresh_mart(fresh, now), 3)

    fact, days, zones = wh.read("fact_trip"), wh.read("dim_date"), wh.read("dim_location")
    timed("top_zones_raw_file", lambda: run(analytics.top_raw_zones(month())), 3)
    timed("revenue_by_weekday", lambda: run(analytics.revenue_by_weekday(fact, days)), 3)
    timed("payment_mix_by_vendor", lambda: run(analytics.payment_mix_by_vendor(fact, seeds[0], seeds[1])), 3)
    timed("metrics_by_day", lambda: run(mart.summarise(wh.read_mart(), ["pickup_date"])), 3)

    timed("feature_build_check_snapshot", lambda: build_and_snapshot(wh, CONFIG, f"{work}/features", "v1", now))
    table = spark.read.parquet(f"{work}/features/v1/features_zone_hour")
    timed("forecast_scores", lambda: run(forecast.score_baselines(table)), 3)
    events = Sample.of(spark, folder)
    timed(
        "event_features",
        lambda: run(features.build_features(events.pickups, events.zones, sample.EVENT_CONFIG)),
    )

    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rows_read": rows,
                "rows_inserted": first["rows_inserted"],
                "ingest_rows_per_sec": round(rows / seconds["ingest_month"]),
                "fact_insert_rows_per_sec": round(first["rows_inserted"] / seconds["fact_insert"]),
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
