from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow import schemas  # noqa: E402
from tripflow.session import local_session, release  # noqa: E402
from tripflow.sources.raw import MONTH_FILE  # noqa: E402

NOW = dt.datetime(2026, 10, 3, 12, 0)
MONTH = "2026-01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", app="tripflow-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)


def trip(**changes) -> dict:
    """A clean trip of January 2026; keyword arguments replace columns, also by their short names."""
    row = {
        "VendorID": 6,
        "pickup": dt.datetime(2026, 1, 10, 8, 0),
        "dropoff": None,
        "passenger_count": 3.0,
        "trip_distance": 3.7,
        "RatecodeID": 5.0,
        "store_and_fwd_flag": "Y",
        "PULocationID": 57,
        "DOLocationID": 190,
        "payment_type": 1,
        "fare_amount": 21.5,
        "extra": 1.25,
        "mta_tax": 0.5,
        "tip_amount": 4.3,
        "tolls_amount": 6.94,
        "improvement_surcharge": 0.3,
        "total_amount": 35.54,
        "congestion_surcharge": 0.75,
        "Airport_fee": 1.75,
        "cbd_congestion_fee": 0.05,
    }
    ride = changes.pop("ride", dt.timedelta(minutes=20))
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    row.update(changes)
    pickup = row.pop("pickup")
    dropoff = row.pop("dropoff")
    row["tpep_pickup_datetime"] = pickup
    row["tpep_dropoff_datetime"] = dropoff if dropoff is not None or pickup is None else pickup + ride
    return row


def hours(n: int, **changes) -> list[dict]:
    """n clean, distinct trips, one per hour."""
    start = dt.datetime(2026, 1, 10, 8, 0)
    return [
        trip(
            pickup=start + dt.timedelta(hours=i),
            trip_distance=3.7 + i,
            fare_amount=21.5 + i,
            total_amount=35.54 + i,
            **changes,
        )
        for i in range(n)
    ]


def raw_frame(spark, rows: list[dict]):
    """Raw rows with a position, in the order given."""
    from tripflow.sources.raw import POSITION

    data = [tuple(r[c] for c in schemas.RAW_COLUMNS) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schemas.RAW.simpleString()[7:-1].replace(":", " ") + f", {POSITION} long")


class Job:
    """Raw folder, warehouse and logs of one test."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.raw_dir, self.warehouse, self.logs = f"{root}/raw", f"{root}/warehouse", f"{root}/logs"

    def deliver(self, rows: list[dict], month: str = MONTH) -> None:
        frame = raw_frame(self.spark, rows).select(*schemas.RAW_COLUMNS)
        frame.coalesce(1).write.parquet(f"{self.raw_dir}/{MONTH_FILE.format(month=month)}")

    def run(self, month: str = MONTH, now: dt.datetime = NOW) -> dict:
        from tripflow.plans.ingest import ingest_month

        return ingest_month(self.spark, month, self.raw_dir, self.warehouse, now=now, log_dir=self.logs)

    @property
    def tables(self):
        from tripflow.sources.warehouse import Warehouse

        return Warehouse(self.spark, self.warehouse)


@pytest.fixture
def job(spark, tmp_path) -> Job:
    return Job(spark, tmp_path)
