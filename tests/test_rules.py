from __future__ import annotations

import datetime as dt

import pytest
from conftest import MONTH, NOW, hours, raw_frame, trip

from tripflow import schemas
from tripflow.functions.keys import add_trip_id
from tripflow.operators import profiling, rules


def reasons(spark, rows, month=MONTH, **codes):
    ctx = rules.CheckContext(month=month, now=NOW, **codes)
    judged = rules.judge(add_trip_id(raw_frame(spark, rows)), ctx)
    return [r.reason_codes for r in judged.orderBy("_position").select("reason_codes").collect()]


def test_clean_rows_pass_and_are_no_anomaly(spark):
    judged = rules.judge(add_trip_id(raw_frame(spark, hours(3))), rules.CheckContext(month=MONTH, now=NOW))
    assert [(r.reason_codes, r.is_anomaly) for r in judged.collect()] == [("", False)] * 3


CASES = [
    (trip(pickup=dt.datetime(2030, 1, 1, 8)), "pickup_in_future,pickup_outside_file_month"),
    (trip(pickup=dt.datetime(2025, 12, 31, 23, 50)), "pickup_outside_file_month"),
    (trip(pickup=dt.datetime(2026, 2, 1)), "pickup_outside_file_month"),
    (trip(pickup=dt.datetime(2026, 1, 31, 23, 59)), ""),
    (trip(VendorID=31), "unknown_vendor"),
    (trip(VendorID=None), "unknown_vendor"),
    (trip(payment_type=17), "unknown_payment_type"),
    (trip(payment_type=0), ""),
    (trip(payment_type=None), ""),
    (trip(RatecodeID=8.0), "unknown_rate_code"),
    (trip(RatecodeID=None), ""),
    (trip(RatecodeID=99.0), ""),
    (trip(PULocationID=0), "location_id_out_of_range"),
    (trip(DOLocationID=266), "location_id_out_of_range"),
    (trip(DOLocationID=265), ""),
    (trip(PULocationID=None), "missing_pickup_location"),
    (trip(DOLocationID=None), "missing_dropoff_location"),
    (trip(pickup=None, dropoff=dt.datetime(2026, 1, 10, 9)), "missing_pickup_datetime"),
    (trip(ride=dt.timedelta(0)), "dropoff_before_or_equal_pickup"),
    (trip(ride=dt.timedelta(minutes=-10)), "dropoff_before_or_equal_pickup"),
    (trip(VendorID=31, PULocationID=999), "unknown_vendor,location_id_out_of_range"),
]


def test_each_hard_rule(spark):
    # Distances keep the rows distinct.
    rows = [{**row, "trip_distance": 1.0 + i} for i, (row, _) in enumerate(CASES)]
    rows.append({**trip(), "trip_distance": 99.0, "tpep_dropoff_datetime": None})
    assert reasons(spark, rows) == [expected for _, expected in CASES] + ["missing_dropoff_datetime"]


def test_month_rule_is_off_without_a_month(spark):
    assert reasons(spark, [trip(pickup=dt.datetime(2025, 12, 31, 23, 50))], month=None) == [""]


def test_codes_come_from_the_context_and_an_empty_set_means_the_default(spark):
    assert reasons(spark, hours(2), vendors={1}) == ["unknown_vendor"] * 2
    assert reasons(spark, hours(2), vendors=set()) == ["", ""]


def test_codes_come_from_the_dimensions(spark):
    vendor = schemas.vendor_seed(spark).unionByName(spark.createDataFrame([(9, 42, "new")], schemas.DIM_VENDOR))
    ctx = rules.context_from_dims(vendor, schemas.payment_seed(spark), schemas.rate_code_seed(spark), MONTH, NOW)
    assert ctx.vendors == {1, 2, 6, 7, 42}
    assert ctx.payment_types == rules.DEFAULT_PAYMENT_TYPES
    assert ctx.rate_codes == rules.DEFAULT_RATE_CODES


def test_duplicates_keep_the_first(spark):
    rows = hours(2)
    assert reasons(spark, [*rows, rows[0], rows[0]]) == ["", "", "duplicate_in_batch", "duplicate_in_batch"]


def test_zero_and_negative_zero_are_one_key(spark):
    assert reasons(spark, [trip(trip_distance=0.0), trip(trip_distance=-0.0)]) == ["", "duplicate_in_batch"]


def test_a_duplicate_counts_even_when_the_first_copy_was_rejected(spark):
    # The payment type is not part of the key.
    assert reasons(spark, [trip(payment_type=17), trip(payment_type=1)]) == ["unknown_payment_type", "duplicate_in_batch"]


def test_reasons_are_counted_once_per_code(spark):
    ctx = rules.CheckContext(month=MONTH, now=NOW)
    rows = [trip(VendorID=31, PULocationID=999), *hours(2)]
    judged = rules.judge(add_trip_id(raw_frame(spark, rows)), ctx)
    assert {r.code: r["rows"] for r in rules.count_reasons(judged).collect()} == {
        "unknown_vendor": 1,
        "location_id_out_of_range": 1,
    }


@pytest.mark.parametrize(
    "change, code",
    [
        ({"passenger_count": None}, "zero_or_missing_passenger_count"),
        ({"passenger_count": 0.0}, "zero_or_missing_passenger_count"),
        ({"trip_distance": 0.0}, "zero_or_negative_trip_distance"),
        ({"fare_amount": -3.0}, "negative_fare_amount"),
        ({"total_amount": -3.0}, "negative_total_amount"),
        ({"ride": dt.timedelta(hours=25)}, "trip_over_24h"),
    ],
)
def test_soft_rules_flag_and_keep(spark, change, code):
    ctx = rules.CheckContext(month=MONTH, now=NOW)
    row = rules.judge(add_trip_id(raw_frame(spark, [trip(**change)])), ctx).first()
    assert (row.reason_codes, row.is_anomaly) == ("", True)
    counts = {r.code: r["rows"] for r in rules.soft_counts(raw_frame(spark, [trip(**change)]), ctx).collect()}
    assert counts == {r.code: int(r.code == code) for r in rules.SOFT_RULES}


def test_a_ride_of_exactly_24_hours_is_usual(spark):
    ctx = rules.CheckContext(month=MONTH, now=NOW)
    assert not rules.judge(add_trip_id(raw_frame(spark, [trip(ride=dt.timedelta(hours=24))])), ctx).first().is_anomaly


def test_every_rule_has_a_dimension(spark):
    rows = rules.rule_dimensions(spark).collect()
    assert len(rows) == 17
    assert {r.dimension for r in rows} == {"completeness", "validity", "uniqueness"}


def test_null_rates_and_their_severity(spark):
    rows = hours(10)
    for row in rows[:3]:
        row["passenger_count"] = None
    rates = {r.column_name: (r.null_rate, r.severity) for r in profiling.null_rates(raw_frame(spark, rows)).collect()}
    assert rates["passenger_count"] == (0.3, "warning")
    assert [c for c, (_, severity) in rates.items() if severity != "none"] == ["passenger_count"]
    assert profiling.null_rates(raw_frame(spark, []).limit(0)).collect() == []


def test_violation_summary_is_strict_about_dropoffs(spark):
    rows = [trip(ride=dt.timedelta(0)), trip(ride=dt.timedelta(minutes=-1), fare_amount=-1.0), trip(trip_distance=3.0)]
    found = {r.check_name: r["rows"] for r in profiling.violation_summary(raw_frame(spark, rows)).collect()}
    assert found["Dropoff Before Pickup"] == 1
    assert found["Any Violation"] == 1
    assert found["Clean"] == 2


def test_quantiles_are_exact(spark):
    import numpy as np

    values = [round(((i * 7919) % 5003) / 4 - 300, 2) for i in range(1200)] + [5.0] * 700
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    row = profiling.describe(frame, ["x"]).first()
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(np.percentile(values, [25, 50, 75])))
    assert row.mean == pytest.approx(np.mean(values))
    assert row.stddev == pytest.approx(np.std(values, ddof=1))
    assert (row.non_null, row.min, row.max) == (len(values), min(values), max(values))
