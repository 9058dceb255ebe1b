from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.sources import keyfilter, warehouse
from tripflow.sources.warehouse import Warehouse


def trips(spark, first: int, last: int, month: int = 3):
    """Fact rows of the numbers from ``first`` to before ``last``, each with a key of its own."""
    rows = spark.range(first, last).select(
        F.sha2(F.col("id").cast("string"), 256).alias("trip_id"),
        F.make_timestamp_ntz(F.lit(2026), F.lit(month), (F.col("id") % 28 + 1).cast("int"), F.lit(7), F.lit(30), F.lit(0.0)).alias("pickup_datetime"),
        (F.col("id") % 5).cast("int").alias("passenger_count"),
    )
    types = {f.name: f.dataType for f in schemas.FACT_BATCH}
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(types[c]).alias(c) for c in schemas.FACT_COLUMNS])


def load(wh: Warehouse, rows) -> int:
    return warehouse.insert_fact(wh, rows, check=False, unique=True)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def test_new_trips_are_loaded_without_a_look_at_the_keys(wh, spark, monkeypatch):
    assert load(wh, trips(spark, 0, 3000)) == 3000
    looked = []
    known = keyfilter.stored_among
    monkeypatch.setattr(warehouse, "_absent", lambda *a: pytest.fail("all keys were compared"))
    monkeypatch.setattr(keyfilter, "stored_among", lambda keys, existing, n: looked.append(n) or known(keys, existing, n))
    assert load(wh, trips(spark, 3000, 5000)) == 2000
    assert sum(looked) <= 5
    # A few known ones among new ones are found by equality, more by a join.
    assert load(wh, trips(spark, 4990, 6000)) == 1000
    assert load(wh, trips(spark, 5900, 7000)) == 1000
    fact = wh.read("fact_trip")
    assert fact.count() == fact.select("trip_id").distinct().count() == fact.select("trip_key").distinct().count() == 7000


def test_a_replay_adds_nothing(wh, spark):
    assert load(wh, trips(spark, 0, 500)) == 500
    assert load(wh, trips(spark, 0, 500)) == 0
    assert load(wh, trips(spark, 0, 700)) == 200


def test_a_load_that_died_after_its_filter_is_completed(wh, spark, monkeypatch):
    load(wh, trips(spark, 0, 400))
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "append", lambda *a, **k: pytest.fail("killed"))
        with pytest.raises(BaseException, match="killed"):
            load(wh, trips(spark, 400, 900))
    assert load(wh, trips(spark, 300, 900)) == 500


def test_a_month_begun_without_a_filter_is_compared_key_by_key(wh, spark):
    old = trips(spark, 0, 300).withColumn("trip_month", F.lit("2026-03")).withColumn("trip_key", F.lit(1).cast("long"))
    wh.append("fact_trip", old, partition_by="trip_month")
    assert load(wh, trips(spark, 200, 600)) == 300
    assert not keyfilter.covers(wh, ["2026-03"]) and keyfilter.covers(wh, ["2026-04"])
    # Another month of the same batch does not make the first one covered.
    assert load(wh, trips(spark, 500, 700).union(trips(spark, 9000, 9100, month=4))) == 200
    assert load(wh, trips(spark, 0, 700)) == 0


def test_keys_are_never_missed_and_rarely_mistaken(wh, spark):
    def keys(first, last):
        return trips(spark, first, last).select("trip_id", F.lit("2026-03").alias("trip_month"))

    for first, last in ((0, 20_000), (20_000, 20_100), (20_100, 30_000)):
        keyfilter.add(wh, keys(first, last), ["2026-03"], last - first)
    assert keyfilter.maybe_known(wh, keys(0, 30_000), ["2026-03"]).count() == 30_000
    assert keyfilter.maybe_known(wh, keys(30_000, 130_000), ["2026-03"]).count() < 200
    assert keyfilter.maybe_known(wh, keys(0, 100), ["2026-05"]).count() == 0


def test_a_filter_is_a_fraction_of_the_keys(wh, spark):
    load(wh, trips(spark, 0, 50_000).coalesce(1))
    sizes = []
    for file in Path(wh.path("fact_trip")).rglob("part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns)}
        sizes.append(columns["trip_id"].total_compressed_size)
    filters = sum(f.stat().st_size for f in Path(wh.path(keyfilter.TABLE)).rglob("part-*.parquet"))
    assert filters < sum(sizes) / 4


def test_dates_are_not_needed_to_be_known(wh, spark):
    assert load(wh, trips(spark, 0, 50).union(trips(spark, 50, 80, month=5))) == 80
    stored = wh.read("fact_trip").groupBy("trip_month").count().collect()
    assert {r.trip_month: r["count"] for r in stored} == {"2026-03": 50, "2026-05": 30}
    assert wh.read("fact_trip").agg(F.min("pickup_datetime")).first()[0] == dt.datetime(2026, 3, 1, 7, 30)
