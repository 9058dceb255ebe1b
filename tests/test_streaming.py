from __future__ import annotations

import datetime as dt
import shutil
from pathlib import Path

import pytest
from conftest import MONTH, NOW, Job, hours, raw_frame, trip

from tripflow import schemas
from tripflow.operators import ledger
from tripflow.sources.raw import MONTH_FILE
from tripflow.streaming.arrivals import deliveries, ingest_arrivals
from tripflow.streaming.demand import follow_demand, read_demand


class Stop(RuntimeError):
    pass


def arrive(job: Job, folder: str, rows: list[dict], month: str = MONTH, parts: int = 1) -> None:
    frame = raw_frame(job.spark, rows).select(*schemas.RAW_COLUMNS)
    frame.repartition(parts).write.parquet(f"{job.raw_dir}/{folder}/{MONTH_FILE.format(month=month)}")


def follow(job: Job, on_loaded=None, **options) -> None:
    ingest_arrivals(job.spark, f"{job.raw_dir}/*", job.warehouse, now=NOW, on_loaded=on_loaded, **options).awaitTermination()


def contents(wh) -> dict:
    fact = wh.read("fact_trip").drop("trip_key")
    return {
        "fact": sorted(map(str, fact.collect())),
        "quarantine": sorted(map(str, wh.read("quarantine_trip").collect())),
        "mart": sorted(map(str, wh.read_mart().collect())),
        "dates": sorted(map(str, wh.read("dim_date").collect())),
        "zones": sorted(map(str, wh.read("dim_location").collect())),
    }


def moved(rows: list[dict], months: int) -> list[dict]:
    """The same trips so many months later."""
    shift = lambda at: at.replace(month=at.month + months)
    return [{**r, **{c: shift(r[c]) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}} for r in rows]


def test_a_stopped_stream_ends_like_the_month_jobs(job, spark, tmp_path):
    first = [*hours(9), hours(1)[0], trip(trip_distance=9.0, VendorID=77), trip(trip_distance=8.0, PULocationID=None)]
    second = moved(hours(6), 1)
    again = [{**r, "tip_amount": 99.0} for r in first] + [trip(trip_distance=55.0)]

    arrive(job, "1", first, parts=3)
    arrive(job, "1", second, "2026-02")

    def stop(number, summaries):
        assert number == 0 and [s["rows_read"] for s in summaries] == [12, 6]
        raise Stop

    with pytest.raises(Exception, match="Stop"):
        follow(job, stop)
    assert job.tables.read("fact_trip").count() == 15
    seen = []
    follow(job, lambda number, summaries: seen.append((number, [s["rows_inserted"] for s in summaries])))
    arrive(job, "2", again)
    follow(job, lambda number, summaries: seen.append((number, [s["rows_inserted"] for s in summaries])))
    follow(job)
    assert seen == [(0, [0, 0]), (1, [1])]

    by_month = Job(spark, tmp_path / "batch")
    by_month.deliver(first)
    by_month.run()
    by_month.deliver(second, "2026-02")
    by_month.run("2026-02")
    shutil.rmtree(f"{by_month.raw_dir}/{MONTH_FILE.format(month=MONTH)}")
    by_month.deliver(again)
    by_month.run()
    assert contents(job.tables) == contents(by_month.tables)
    fact = job.tables.read("fact_trip")
    assert fact.select("trip_key").distinct().count() == fact.count() == 16
    states = {r.run_id: (r.month, r.status, r.rows_inserted) for r in ledger.run_states(job.tables.read(ledger.TABLE)).collect()}
    assert states == {
        1: (MONTH, "success", 9), 2: ("2026-02", "success", 6),
        3: (MONTH, "success", 0), 4: ("2026-02", "success", 0),
        5: (MONTH, "success", 1),
    }


def test_a_broken_delivery_stops_the_stream_until_it_is_mended(job):
    arrive(job, "1", hours(3))
    bad = raw_frame(job.spark, hours(2)).drop("fare_amount")
    path = f"{job.raw_dir}/2/{MONTH_FILE.format(month='2026-02')}"
    bad.write.parquet(path)
    with pytest.raises(Exception, match="lacks columns: fare_amount"):
        follow(job)
    assert job.tables.read("fact_trip").count() == 3
    states = ledger.run_states(job.tables.read(ledger.TABLE)).orderBy("run_id").collect()
    assert [(r.month, r.status) for r in states] == [(MONTH, "success"), ("2026-02", "failed")]
    # Mended in place, under the same names: the batch that failed runs again.
    for name, rows in (("good", moved(hours(2), 1)), ("none", [])):
        raw_frame(job.spark, rows).select(*schemas.RAW_COLUMNS).coalesce(1).write.parquet(f"{job.root}/{name}")
    parts = sorted(Path(path).glob("part-*.parquet"))
    for number, part in enumerate(parts):
        (mended,) = Path(f"{job.root}/{'none' if number else 'good'}").glob("part-*.parquet")
        part.write_bytes(mended.read_bytes())
    for crc in Path(path).glob(".*.crc"):
        crc.unlink()
    follow(job)
    assert job.tables.read("fact_trip").count() == 5


def test_files_are_grouped_by_delivery_in_order_of_arrival():
    def at(minute: int) -> dt.datetime:
        return dt.datetime(2026, 3, 1, 0, minute)

    found = deliveries(
        [
            ("file:/in/2/yellow_tripdata_2026-01.parquet/part-1.parquet", at(9)),
            ("file:/in/1/yellow_tripdata_2026-02.parquet", at(3)),
            ("file:/in/1/yellow_tripdata_2026-01.parquet/b.parquet", at(1)),
            ("file:/in/1/yellow_tripdata_2026-01.parquet/a.parquet", at(5)),
        ]
    )
    assert [(month, len(paths)) for month, _, paths in found] == [("2026-02", 1), ("2026-01", 2), ("2026-01", 1)]
    assert found[1][1].endswith("/1/yellow_tripdata_2026-01.parquet") and found[1][2][0].endswith("a.parquet")
    with pytest.raises(ValueError, match="no delivery is named"):
        deliveries([("file:/in/other.parquet", at(1))])


PICKUPS = "pickup_location_key int, pickup_datetime timestamp_ntz"


def pickups(spark, folder, number: int, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, PICKUPS).coalesce(1).write.parquet(f"{folder}/{number:02d}")


def demand(spark, folder, table, delay="2 hours") -> dict:
    stream = spark.readStream.schema(PICKUPS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    follow_demand(stream, str(table), delay).awaitTermination()
    return {(r.zone_id, r.hour_start): (r.trips, r.late_trips) for r in read_demand(spark, str(table)).collect()}


def test_demand_counts_late_pickups_within_the_mark_and_others_apart(spark, tmp_path):
    def at(hour, minute=0):
        return dt.datetime(2026, 3, 29, 0) + dt.timedelta(hours=hour, minutes=minute)

    folder, table = tmp_path / "in", tmp_path / "demand"
    pickups(spark, folder, 0, [(7, at(1, 5)), (7, at(1, 10)), (8, at(1, 59)), (7, at(3)), (None, at(3)), (7, None)])
    # The mark is now 01:00: hour 0 is over, hour 1 is not, whatever the order of files.
    pickups(spark, folder, 1, [(7, at(0, 30)), (8, at(1, 1)), (7, at(5, 30))])
    # The mark is now 03:30: hour 1 and hour 2 are over, hour 3 is not.
    pickups(spark, folder, 2, [(7, at(1, 30)), (7, at(3, 59)), (9, at(2)), (8, at(2, 59)), (8, at(4))])
    expected = {
        (7, at(0)): (0, 1),
        (7, at(1)): (2, 1),
        (8, at(1)): (2, 0),
        (7, at(3)): (2, 0),
        (7, at(5)): (1, 0),
        (9, at(2)): (0, 1),
        (8, at(2)): (0, 1),
        (8, at(4)): (1, 0),
    }
    assert demand(spark, folder, table) == expected
    # Going on from the stored state: the mark stays, counts of open hours grow, the batch table does not count twice.
    assert demand(spark, folder, table) == expected
    pickups(spark, folder, 3, [(7, at(5, 59)), (7, at(3, 1)), (8, at(1))])
    expected |= {(7, at(5)): (2, 0), (7, at(3)): (3, 0), (8, at(1)): (2, 1)}
    assert demand(spark, folder, table) == expected


def test_many_zones_are_counted_by_few_calls(spark, tmp_path):
    """Zones share state: two zones of one share, one with late pickups, keep their own counts."""
    from pyspark.sql import functions as F

    from tripflow.streaming import demand as module

    at = dt.datetime(2026, 3, 29, 6)
    zones = list(range(3000))
    pickups(spark, tmp_path / "in", 0, [(z, at + dt.timedelta(minutes=z % 60)) for z in zones])
    pickups(spark, tmp_path / "in", 1, [(z, at if z % 2 else at - dt.timedelta(hours=5)) for z in zones])
    expected = {(z, at): (2 if z % 2 else 1, 0) for z in zones} | {(z, at - dt.timedelta(hours=5)): (0, 1) for z in zones if not z % 2}
    assert demand(spark, tmp_path / "in", tmp_path / "demand") == expected
    keys = spark.read.format("statestore").load(f"{tmp_path}/demand/_checkpoint").select(F.col("key.*")).count()
    assert 0 < keys <= module.SHARES


def test_no_pickups(spark, tmp_path):
    pickups(spark, tmp_path / "in", 0, [])
    assert demand(spark, tmp_path / "in", tmp_path / "demand") == {}
    assert read_demand(spark, str(tmp_path / "none")).count() == 0
