"""Duplicates with one key holding more than a third of the rows, against a plain Python count."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripflow.operators.dedup import DUPLICATE, first_per_key, flag_repeats
from tripflow.operators.reconcile import containment, cross_check, distinctness, overlap
from tripflow.sources.warehouse import absent_rows_staged


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(5)
    keys = ["hot"] * 1500 + [f"k{rng.randrange(900)}" for _ in range(1500)] + [f"u{i}" for i in range(900)]
    rng.shuffle(keys)
    rows = [(k, i, i * 3) for i, k in enumerate(keys)]
    frame = spark.createDataFrame(rows, "trip_id string, _position long, payload long").repartition(6)
    return frame, keys


def repeats(keys):
    seen, flags = set(), []
    for key in keys:
        flags.append(key in seen)
        seen.add(key)
    return flags


@pytest.mark.parametrize("broadcast_keys", [100_000, 0])
def test_repeats_match_a_plain_count(keyed, broadcast_keys):
    frame, keys = keyed
    flagged = flag_repeats(frame, broadcast_keys=broadcast_keys)
    assert flagged.columns == [*frame.columns, DUPLICATE]
    rows = flagged.orderBy("_position").collect()
    assert [r[DUPLICATE] for r in rows] == repeats(keys)
    assert [r.payload for r in rows] == [i * 3 for i in range(len(keys))]


def test_hot_keys_do_not_route_to_one_place(keyed, monkeypatch):
    """Past the broadcast limit every row of a hot key gets a route of its own."""
    from tripflow.operators import dedup

    monkeypatch.setattr(dedup, "HOT_SHARE", 5)
    frame, keys = keyed
    rows = flag_repeats(frame, broadcast_keys=0).orderBy("_position").collect()
    assert [r[DUPLICATE] for r in rows] == repeats(keys)


def test_colliding_digests_are_told_apart(keyed):
    frame, keys = keyed
    rows = flag_repeats(frame, digest=F.length("trip_id")).orderBy("_position").collect()
    assert [r[DUPLICATE] for r in rows] == repeats(keys)
    unique = frame.filter("trip_id like 'u%'")
    assert flag_repeats(unique, digest=F.lit(1)).filter(DUPLICATE).count() == 0


def test_no_repeats_needs_no_join(spark):
    frame = spark.range(50).select(F.col("id").cast("string").alias("trip_id"), F.col("id").alias("_position"))
    flagged = flag_repeats(frame)
    assert flagged.filter(DUPLICATE).count() == 0
    assert "Join" not in flagged._jdf.queryExecution().executedPlan().toString()


def test_first_row_per_key(keyed):
    frame, keys = keyed
    first = {}
    for i, key in enumerate(keys):
        first.setdefault(key, i)
    got = {r.trip_id: (r._position, r.payload) for r in first_per_key(frame, "trip_id").collect()}
    assert got == {k: (i, i * 3) for k, i in first.items()}


@pytest.mark.parametrize("known, limit", [(0, 10), (7, 10), (400, 10), (3900, 10)])
def test_absent_rows_for_any_overlap(keyed, monkeypatch, known, limit):
    from tripflow.sources import warehouse

    monkeypatch.setattr(warehouse, "BROADCAST_KEYS", limit)
    frame, keys = keyed
    existing = frame.filter(F.col("_position") < known).select("trip_id")
    fresh = {r._position for r in absent_rows_staged(frame, existing, "trip_id").collect()}
    held = set(keys[:known])
    assert fresh == {i for i, k in enumerate(keys) if k not in held}


def test_distinctness_and_overlap(keyed):
    frame, keys = keyed
    row = distinctness(frame, "trip_id").first()
    assert (row["rows"], row.distinct_keys, row.surplus_rows) == (len(keys), len(set(keys)), len(keys) - len(set(keys)))
    assert overlap(frame, frame.filter("trip_id = 'hot'"), "trip_id").first()[0] == 1


def test_containment_treats_null_as_equal(spark):
    raw = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "id int, v string")
    sample = spark.createDataFrame([(1, None), (2, "a"), (2, "b"), (2, "b")], "id int, v string")
    row = containment(sample, raw, ["id", "v"]).first()
    assert (row.sample_rows, row.rows_not_in_raw) == (4, 2)


def test_cross_check_needs_all_keys_and_less_than_a_cent(spark):
    def result(*rows):
        return spark.createDataFrame(list(rows), "k int, v double")

    rows = cross_check(
        {"a": result((1, 1.0), (2, 5.0), (3, 1.0)), "b": result((1, 1.009), (2, 5.02))}, "k", "v"
    ).collect()
    assert {r.key: r.agrees for r in rows} == {1: True, 2: False, 3: False}


def test_only_rows_that_may_repeat_are_shuffled(spark):
    """Past the broadcast limit the sieve keeps unique rows out of the join, and loses no repeated one."""
    from tripflow.operators import dedup

    digest = F.xxhash64("trip_id")
    frame = spark.range(60_000).select(F.concat(F.lit("k"), F.least("id", F.col("id") % 50_000)).alias("trip_id"), F.col("id").alias("_position"))
    suspects, found = dedup.suspect_digests(frame, digest)
    assert found == 10_000
    single, maybe = dedup.split_by_sieve(frame, digest, suspects, found)
    assert single.count() + maybe.count() == 60_000
    assert single.join(suspects, F.col("_digest") == digest, "left_semi").isEmpty()
    assert 20_000 <= maybe.count() < 21_000
    assert flag_repeats(frame, broadcast_keys=0).filter(DUPLICATE).count() == 10_000
    kept = dedup.first_rows(frame, "trip_id", "_position", broadcast_keys=0)
    assert kept.agg(F.count("*"), F.max("_position")).first() == (50_000, 49_999)


def test_flagging_does_not_sort_or_shuffle_wide_rows_without_repeats(spark):
    frame = spark.range(9_000).select(F.col("id").cast("string").alias("trip_id"), F.col("id").alias("_position"))
    twice = frame.unionByName(frame.filter("_position < 1000").withColumn("_position", F.col("_position") + 9_000))
    plan = flag_repeats(twice, broadcast_keys=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def delivered(spark, n: int = 4000):
    """Rows of two files, nine tenths of them repeats, with their place as a scan gives it, and one more number after it."""
    rows = [(f"k{i % 400}" if i % 7 else None, (f"file:/in/{'ba'[i % 2]}", i // 2, i % 3), i) for i in range(n)]
    return spark.createDataFrame(rows, "trip_id string, _position struct<file: string, row: long, copy: int>, payload long").repartition(5), rows


def test_no_row_is_shuffled_however_many_repeat(spark):
    frame, rows = delivered(spark)
    flagged = flag_repeats(frame, digest=F.length("trip_id"), broadcast_keys=0)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    first = {}
    for key, place, _ in rows:
        first[key] = min(place, first.get(key, place))
    expected = {n: key is not None and place != first[key] for key, place, n in rows}
    assert {r.payload: r[DUPLICATE] for r in flagged.collect()} == expected


@pytest.mark.parametrize("limit", [0, 5, 1_000_000])
def test_the_first_rows_are_the_same_by_places_and_by_sorting(spark, limit):
    from tripflow.operators import dedup

    frame, rows = delivered(spark)
    wanted = sorted(map(str, first_per_key(frame, "trip_id").collect()))
    assert sorted(map(str, dedup.first_rows(frame, "trip_id", broadcast_keys=limit).collect())) == wanted
    # Rows that share a place, as after a join that doubles rows, leave one row for each key all the same.
    twice = frame.unionByName(frame)
    assert sorted(map(str, dedup.first_rows(twice, "trip_id", broadcast_keys=limit).collect())) == wanted


def test_a_position_that_is_no_place_still_orders_the_rows(keyed):
    frame, keys = keyed
    text = frame.withColumn("_position", F.format_string("%09d", "_position"))
    rows = flag_repeats(text, broadcast_keys=0).orderBy("_position").collect()
    assert [r[DUPLICATE] for r in rows] == repeats(keys)
