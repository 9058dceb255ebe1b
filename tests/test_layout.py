from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tripflow.operators import layout


def fact(spark, n: int):
    draw = random.Random(1)
    rows = [
        (dt.datetime(2026, 3, draw.randint(1, 3), draw.randint(0, 23)), draw.choice([None, *range(1, 266)]), draw.choice([None, 1, 2, 3, 4]), Decimal(draw.randint(100, 9000)) / 100)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, pickup_location_key int, vendor_key int, total_amount decimal(10,2)")


def test_curve_takes_bits_in_turn(spark):
    pairs = [(z, v) for z in (0, 1, 2, 3, 16, 255, 256, 300, 511) for v in range(8)]
    made = spark.createDataFrame(pairs, "z int, v int").select("z", "v", layout.curve(F.col("z"), F.col("v")).alias("at")).collect()

    def expected(z: int, v: int) -> int:
        zone, vendor = f"{z:09b}", f"{v:03b}"
        return int("".join(a + b for a, b in zip(zone, vendor)) + zone[3:], 2)

    assert all(r["at"] == expected(r["z"], r["v"]) for r in made)
    assert len({r["at"] for r in made}) == len(pairs)
    none = spark.createDataFrame([(None, None)], "z int, v int").select(layout.curve(F.col("z"), F.col("v"))).first()[0]
    assert none == 0


def test_clustering_keeps_the_rows_and_reads_less(spark, tmp_path):
    rows = fact(spark, 6000)
    path, plain = f"{tmp_path}/clustered", f"{tmp_path}/plain"
    layout.write_clustered(rows, path, block_rows=100, tasks=3)
    layout.write_in_blocks(layout.with_folder(rows), plain, 100)
    stored = spark.read.parquet(path)
    assert sorted(map(str, stored.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert stored.where(F.col(layout.FOLDER) != F.col("pickup_datetime").cast("date")).count() == 0
    for column, part in (("pickup_location_key", 0.5), ("vendor_key", 0.75)):
        after = layout.blocks_read(spark, path, column, 100).agg(F.avg(F.col("read") / F.col("blocks"))).first()[0]
        before = layout.blocks_read(spark, plain, column, 100).agg(F.avg(F.col("read") / F.col("blocks"))).first()[0]
        assert after < part * before
    # The blocks are real: row groups of the files.
    groups = [pq.ParquetFile(f).metadata for f in tmp_path.rglob("clustered/**/*.parquet")]
    assert max(m.row_group(g).num_rows for m in groups for g in range(m.num_row_groups)) <= 100


def test_a_large_fact_is_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "RANGE_ROWS", 500, raising=False)
    rows = fact(spark, 3000).withColumn("trip_id", F.sha2(F.monotonically_increasing_id().cast("string"), 256))
    layout.write_clustered(rows, f"{tmp_path}/few", block_rows=100, tasks=1, unit="year")
    assert len(list(tmp_path.glob("few/*/*.parquet"))) >= 4
    stored = spark.read.parquet(f"{tmp_path}/few").select(rows.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
