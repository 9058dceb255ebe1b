from __future__ import annotations

import datetime as dt

import pytest
from conftest import hours, raw_frame, trip
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.calendar import hour_of, minute_text
from tripflow.functions.keys import KEY_FIELDS, add_trip_id, canonical_text
from tripflow.functions.numbers import half_even_int, ratio


def ids(spark, rows):
    return [r.trip_id for r in add_trip_id(raw_frame(spark, rows)).orderBy("_position").collect()]


def test_key_is_deterministic_and_unique_per_row(spark):
    rows = hours(4)
    first, second = ids(spark, rows), ids(spark, rows)
    assert first == second
    assert len(set(first)) == 4
    assert all(len(i) == 64 for i in first)


def test_key_depends_on_every_key_field_and_on_no_other(spark):
    changes = [
        {"VendorID": 1},
        {"pickup": dt.datetime(2026, 1, 10, 8, 0, 0, 1), "dropoff": dt.datetime(2026, 1, 10, 8, 20)},
        {"dropoff": dt.datetime(2026, 1, 10, 8, 21)},
        {"PULocationID": 1},
        {"DOLocationID": 1},
        {"passenger_count": 2.0},
        {"trip_distance": 2.01},
        {"fare_amount": 999.0},
        {"total_amount": 999.0},
    ]
    assert len(changes) == len(KEY_FIELDS)
    base, *rest = ids(spark, [trip(), *[trip(**c) for c in changes], trip(tip_amount=9.0, payment_type=2)])
    assert base not in rest[:-1]
    assert len(set(rest[:-1])) == len(changes)
    assert rest[-1] == base


def test_nulls_take_part_in_the_key(spark):
    a, b, c = ids(
        spark,
        [
            trip(PULocationID=None, DOLocationID=5),
            trip(PULocationID=5, DOLocationID=None),
            trip(PULocationID=None, DOLocationID=None),
        ],
    )
    assert None not in (a, b, c)
    assert len({a, b, c}) == 3


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=2, max_size=40, unique=True))
def test_different_numbers_have_different_texts(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    texts = frame.select("v", canonical_text("v", T.DoubleType()).alias("t")).collect()
    by_text = {}
    for row in texts:
        assert by_text.setdefault(row.t, row.v) == row.v


def test_number_text_is_plain(spark):
    frame = spark.createDataFrame([(1.0e7,), (0.1,), (1e-5,), (None,)], "v double")
    assert [r[0] for r in frame.select(canonical_text("v", T.DoubleType())).collect()] == [
        "10000000000000",
        "100000",
        "10",
        "~",
    ]


@pytest.mark.parametrize("value, expected", [(1.5, 2), (2.5, 2), (-1.5, -2), (3.0, 3), (None, None)])
def test_passengers_round_half_to_even(spark, value, expected):
    assert spark.createDataFrame([(value,)], "v double").select(half_even_int(F.col("v"))).first()[0] == expected


def test_ratio_of_nothing_is_null(spark):
    row = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int").select(ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in row] == [None, 0.25]


def test_hours_ignore_the_clock_changes_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in that zone on this day, and 01:30 exists twice in November.
        times = [dt.datetime(2026, 3, 8, 2, 30), dt.datetime(2026, 11, 1, 1, 30, 5)]
        frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
        rows = frame.select(hour_of(F.col("t")).alias("h"), minute_text(F.col("t")).alias("m")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.h for r in rows] == [dt.datetime(2026, 3, 8, 2), dt.datetime(2026, 11, 1, 1)]
    assert [r.m for r in rows] == ["2026-03-08 02:30", "2026-11-01 01:30"]


def test_packed_keys_come_back_and_stay_apart(spark):
    import hashlib

    from tripflow.functions.keys import packed, unpacked

    digest = hashlib.sha256(b"x").hexdigest()
    texts = [digest, digest.upper(), digest[:63], digest + "0", "g" * 64, "", "k1", "é", "\0" * 33, None]
    frame = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed("k").alias("b"))
    rows = frame.select("k", "b", unpacked("b").alias("again")).collect()
    assert [r.again for r in rows] == [r.k for r in rows]
    assert len({bytes(r.b) for r in rows if r.b is not None}) == len(texts) - 1
    assert {r.k: len(r.b) for r in rows if r.k}[digest] == 32
