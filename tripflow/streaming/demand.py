"""Hourly demand from a stream of pickups, with a bound on how late a pickup may come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tripflow.sources import files

HOUR_MS = 3_600_000
UPDATES = "zone_id int, hour_start timestamp, trips long, late boolean"
#: Zones share state by the hash of their key: a call of Python for each of so many shares, not for each zone.
SHARES = 1024
#: Frames of a share that are held before they are summed.
MOST_PARTS = 64
# Zone, hour in milliseconds and trips, in the state's bytes.
KINDS = ("int32", "int64", "int64")


def _per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pickups of each Arrow batch summed by zone and hour, so that a busy zone sends few rows to its task."""
    for batch in batches:
        if batch.num_rows:
            summed = pa.table(batch).group_by(["zone_id", "hour_start"]).aggregate([("pickup", "max"), ("pickup", "count")])
            summed = summed.rename_columns(["zone_id", "hour_start", "pickup", "trips"])
            yield from summed.select(["zone_id", "hour_start", "pickup", "trips"]).to_batches()


def _summed(zones: np.ndarray, hours: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Zones and hours, each pair once, and the sums of their values."""
    if not len(zones):
        return [zones, hours, *values]
    order = np.lexsort((hours, zones))
    zones, hours = zones[order], hours[order]
    first = np.flatnonzero(np.r_[True, (zones[1:] != zones[:-1]) | (hours[1:] != hours[:-1])])
    return [zones[first], hours[first], *(np.add.reduceat(v[order], first) for v in values)]


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(column) for column in zip(*parts)]


def _count(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Running counts of the open hours of a share of the zones; what comes after the watermark passed its hour is late."""
    mark = state.getCurrentWatermarkMs()
    new = [[np.empty(0, kind) for kind in KINDS]]
    for part in parts:
        hour = part["hour_start"].to_numpy().astype("datetime64[ms]").astype("int64")
        new.append([part["zone_id"].to_numpy().astype("int32"), hour, part["trips"].to_numpy().astype("int64")])
        if len(new) > MOST_PARTS:
            new = [_summed(*_joined(new))]
    zones, hours, trips = _summed(*_joined(new))
    is_open = hours + HOUR_MS > mark
    stored = state.get if state.exists else (b"", b"", b"")
    before = [np.frombuffer(bytes(data), kind) for data, kind in zip(stored, KINDS)]
    kept = before[1] + HOUR_MS > mark
    held = [[*(column[kept] for column in before), np.zeros(kept.sum(), "int64")], [zones[is_open], hours[is_open], trips[is_open], np.ones(is_open.sum(), "int64")]]
    *counts, touched = _summed(*_joined(held))
    state.update(tuple(column.tobytes() for column in counts))
    changed = touched > 0
    zones, hours, trips = _joined([[column[changed] for column in counts], [column[~is_open] for column in (zones, hours, trips)]])
    late = np.arange(len(zones)) >= changed.sum()
    yield pd.DataFrame({"zone_id": zones, "hour_start": hours.astype("datetime64[ms]"), "trips": trips, "late": late})


def hourly_updates(pickups: DataFrame, delay: str) -> DataFrame:
    """zone_id, hour_start, trips, late from a stream with pickup_location_key and pickup_datetime.

    A row that is not late carries the whole count of its hour so far and replaces the one before. A
    late row carries only what came after the watermark (the latest pickup of all earlier batches less
    ``delay``) passed the hour's end. The state of a share of the zones is a count for each zone and hour
    that the watermark had not passed when the share last had a pickup, as arrays of bytes. Rows without
    a zone or pickup time are left out, as in the batch.
    """
    # The pickup's own wall-clock time; event time needs an instant, and UTC has no gaps.
    at = F.col("pickup_datetime").cast("timestamp")
    known = pickups.where("pickup_location_key is not null and pickup_datetime is not null").select(
        F.col("pickup_location_key").cast("int").alias("zone_id"), F.date_trunc("hour", at).alias("hour_start"), at.alias("pickup")
    )
    summed = known.mapInArrow(_per_batch, "zone_id int, hour_start timestamp, pickup timestamp, trips long")
    return (
        summed.withWatermark("pickup", delay)
        .withColumn("share", F.pmod(F.hash("zone_id"), F.lit(SHARES)))
        .groupBy("share")
        .applyInPandasWithState(_count, UPDATES, "zones binary, hours binary, trips binary", "update", GroupStateTimeout.NoTimeout)
    )


def follow_demand(pickups: DataFrame, table: str, delay: str) -> StreamingQuery:
    """Keep the updates of a pickup stream as a table, one folder for each micro-batch; ends when the input does.

    A batch that runs again after a failure overwrites its own folder, so nothing is counted twice.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/updates/batch={number}")

    return (
        hourly_updates(pickups, delay)
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{table}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_demand(spark: SparkSession, table: str) -> DataFrame:
    """zone_id, hour_start, trips and late_trips of every hour seen so far.

    ``trips`` came in time, ``late_trips`` after the hour was closed; together they are what a batch counts.
    """
    path = f"{table}/updates"
    updates = spark.read.schema(f"{UPDATES}, batch long").parquet(path) if files.exists(spark, path) else spark.createDataFrame([], UPDATES)
    late = F.col("late")
    return updates.groupBy("zone_id", F.col("hour_start").cast("timestamp_ntz").alias("hour_start")).agg(
        # Counts only grow, so the largest is the last.
        F.coalesce(F.max(F.when(~late, F.col("trips"))), F.lit(0).cast("long")).alias("trips"),
        F.coalesce(F.sum(F.when(late, F.col("trips"))), F.lit(0).cast("long")).alias("late_trips"),
    )
