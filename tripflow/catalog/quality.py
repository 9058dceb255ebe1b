"""Queries on rules, profiles and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.catalog.oracle import HARD, MONTH_RULE, SOFT, hard, judged, with_trips
from tripflow.catalog.registry import Sample, query
from tripflow.functions.calendar import month_text
from tripflow.functions.keys import add_trip_id, key_digest
from tripflow.operators import dedup, profiling, reconcile, rules
from tripflow.plans.ingest import batch_counts
from tripflow.sources.raw import POSITION
from tripflow.sources.sample import SAMPLE_MONTH, SAMPLE_NOW


def _register_rule(code: str, letter: str) -> None:
    """Rows checked and failing per pickup month. The month rule is checked against one month."""
    ctx = rules.CheckContext(month=SAMPLE_MONTH, now=SAMPLE_NOW)
    repeats = code == "duplicate_in_batch"
    test = f"coalesce({SOFT[code]}, FALSE)" if code in SOFT else hard(code, MONTH_RULE)
    rows = "(SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY copy) AS repeat_no FROM keyed)"
    sql = with_trips(
        f"""SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month, count(*) AS rows,
              count(*) FILTER (WHERE {test}) AS failing
            FROM {rows if repeats else "trips"} GROUP BY 1""",
        "keyed" if repeats else "trips",
    )

    @query(f"rule_{code}_o{letter}", sql)
    def rule_hits(s: Sample) -> DataFrame:
        checked = dedup.flag_repeats(add_trip_id(s.stored_trips), digest=key_digest()) if repeats else s.trips
        return checked.groupBy(month_text(F.col("tpep_pickup_datetime")).alias("pickup_month")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(rules.RULES[code].fails(ctx)).alias("failing")
        )


for _i, _rule in enumerate(rules.HARD_RULES):
    _register_rule(_rule.code, f"30{chr(ord('a') + _i)}")
for _i, _rule in enumerate(rules.SOFT_RULES):
    _register_rule(_rule.code, f"31{chr(ord('a') + _i)}")


@query("reject_reasons_o32", with_trips("SELECT trip_id, reason_codes, total_amount FROM judged", "judged"))
def reject_reasons(s: Sample) -> DataFrame:
    """Every row with its reason codes."""
    return rules.judge(add_trip_id(s.stored_trips), s.context).select("trip_id", "reason_codes", "total_amount")


@query(
    "soft_mask_o33",
    with_trips("SELECT payment_type, is_anomaly, count(*) AS rows FROM judged GROUP BY ALL", "judged"),
)
def soft_mask(s: Sample) -> DataFrame:
    flagged = s.raw.select("payment_type", rules.anomaly_mask(s.context).alias("is_anomaly"))
    return flagged.groupBy("payment_type", "is_anomaly").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "check_context_o35",
    with_trips(
        "SELECT reason_codes, count(*) AS rows FROM judged GROUP BY 1",
        "judged",
        judged_as=judged(MONTH_RULE, vendors="1"),
    ),
)
def check_context(s: Sample) -> DataFrame:
    """A run with a month and its own vendor list; empty code lists fall back to the defaults."""
    ctx = rules.CheckContext(month=SAMPLE_MONTH, vendors={1}, payment_types=set(), now=SAMPLE_NOW)
    judged_rows = rules.judge(add_trip_id(s.stored_trips), ctx)
    return judged_rows.groupBy("reason_codes").agg(F.count(F.lit(1)).alias("rows"))


_TAGS = ", ".join(
    f"('{r.code}', '{rules.TIER[r.code]}', '{r.dimension}', "
    + (f"(SELECT count(*) FROM judged WHERE list_contains(string_split(reason_codes, ','), '{r.code}'))"
       if r.code in HARD else f"(SELECT count(*) FROM judged WHERE coalesce({SOFT[r.code]}, FALSE))")
    + ")"
    for r in rules.RULES.values()
)


@query(
    "rule_dimensions_o36",
    with_trips(f"SELECT * FROM (VALUES {_TAGS}) t(code, tier, dimension, rows)", "judged"),
)
def rule_dimensions(s: Sample) -> DataFrame:
    """Every rule with its tier, quality dimension and hits."""
    hits = rules.count_reasons(s.judged).unionByName(rules.soft_counts(s.judged, s.context))
    tagged = rules.rule_dimensions(s.spark).join(hits, "code", "left")
    return tagged.select("code", "tier", "dimension", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


@query(
    "reason_counts_o65",
    with_trips(
        "SELECT unnest(string_split(reason_codes, ',')) AS code, count(*) AS rows FROM bad GROUP BY 1", "judged"
    ),
)
def reason_counts(s: Sample) -> DataFrame:
    return rules.count_reasons(s.judged)


@query(
    "soft_counts_o66",
    with_trips(
        "\nUNION ALL ".join(
            f"SELECT '{code}' AS code, count(*) FILTER (WHERE {test}) AS rows FROM good" for code, test in SOFT.items()
        ),
        "judged",
    ),
)
def soft_counts(s: Sample) -> DataFrame:
    return rules.soft_counts(s.good, s.context)


@query(
    "reason_histogram_o80",
    with_trips("SELECT reason_codes, count(*) AS rows FROM bad GROUP BY 1", "judged"),
)
def reason_histogram(s: Sample) -> DataFrame:
    return rules.reason_histogram(s.judged).orderBy(F.col("rows").desc())


@query(
    "null_rates_o67",
    with_trips(
        """, rates AS ("""
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows, "
            f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_rate FROM trips"
            for c in schemas.RAW_COLUMNS
        )
        + """)
        SELECT *, CASE WHEN null_rate > 0.05 THEN 'warning' WHEN null_rate > 0 THEN 'info' ELSE 'none' END AS severity
        FROM rates""",
        "trips",
    ),
)
def null_rates(s: Sample) -> DataFrame:
    return profiling.null_rates(s.raw)


_CHECKS = {
    "Passenger Count <= 0": "coalesce(passenger_count <= 0, FALSE)",
    "Trip Distance <= 0": "coalesce(trip_distance <= 0, FALSE)",
    "Fare Amount < 0": "coalesce(fare_amount < 0, FALSE)",
    "Total Amount < 0": "coalesce(total_amount < 0, FALSE)",
    "Dropoff Before Pickup": "coalesce(tpep_dropoff_datetime < tpep_pickup_datetime, FALSE)",
}
_ANY = " OR ".join(_CHECKS.values())


@query(
    "violation_summary_o68",
    with_trips(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {test}) AS rows, "
            f"CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count(*) * 100 AS pct FROM trips"
            for name, test in {**_CHECKS, "Any Violation": f"({_ANY})", "Clean": f"NOT ({_ANY})"}.items()
        ),
        "trips",
    ),
)
def violation_summary(s: Sample) -> DataFrame:
    return profiling.violation_summary(s.raw)


_ALL_RAW = ", ".join(schemas.RAW_COLUMNS)


@query(
    "exact_duplicates_o69",
    with_trips(
        f"""SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
            FROM (SELECT count(*) AS n FROM trips GROUP BY {_ALL_RAW})""",
        "trips",
    ),
)
def exact_duplicates(s: Sample) -> DataFrame:
    return profiling.exact_duplicates(s.raw)


_DESCRIBED = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]
_DESCRIBE_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS non_null,
      CAST(sum(v) AS DOUBLE) / count(v) AS mean,
      sqrt((CAST(sum(v * v) AS DOUBLE) - CAST(sum(v) AS DOUBLE) * CAST(sum(v) AS DOUBLE) / count(v)) / (count(v) - 1))
        AS stddev,
      min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
      quantile_cont({c}, 0.75) AS p75
    FROM (SELECT {c}, CAST({c} AS DECIMAL(10,2)) AS v FROM trips WHERE {c} IS NOT NULL)"""
    for c in _DESCRIBED
)


@query(
    "describe_columns_o69",
    with_trips(
        f"""SELECT column_name, non_null, round(mean, 6) AS mean, round(stddev, 4) AS stddev, min, max,
              round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75
            FROM ({_DESCRIBE_SQL})""",
        "trips",
    ),
)
def describe_columns(s: Sample) -> DataFrame:
    described = profiling.describe(s.raw, _DESCRIBED)
    rounded = {"mean": 6, "stddev": 4, "p25": 4, "p50": 4, "p75": 4}
    for name, places in rounded.items():
        described = described.withColumn(name, F.round(name, places))
    return described


@query(
    "value_counts_o69",
    with_trips("SELECT RatecodeID AS value, count(*) AS rows FROM trips GROUP BY 1", "trips"),
)
def value_counts(s: Sample) -> DataFrame:
    return profiling.value_counts(s.raw, "RatecodeID")


@query(
    "time_range_o69",
    with_trips(
        "SELECT min(tpep_pickup_datetime) AS first_value, max(tpep_pickup_datetime) AS last_value FROM trips", "trips"
    ),
)
def time_range(s: Sample) -> DataFrame:
    return profiling.time_range(s.raw, "tpep_pickup_datetime")


@query(
    "run_counts_o70",
    with_trips(
        """SELECT count(*) AS rows_read, count(*) FILTER (WHERE reason_codes = '') AS rows_valid,
             count(*) FILTER (WHERE reason_codes <> '') AS rows_rejected,
             count(*) FILTER (WHERE reason_codes = '' AND is_anomaly) AS anomaly_rows,
             count(*) FILTER (WHERE reason_codes LIKE '%unknown_vendor%') AS unknown_vendor,
             count(*) FILTER (WHERE reason_codes LIKE '%duplicate_in_batch%') AS duplicate_in_batch
           FROM judged""",
        "judged",
    ),
)
def run_counts(s: Sample) -> DataFrame:
    counts = batch_counts(s.judged.withColumn("_accepted", F.col("reason_codes") == ""), s.context)
    reasons = counts["reject_reason_counts"]
    row = [counts[c] for c in ("rows_read", "rows_valid", "rows_rejected", "anomaly_rows")]
    row += [reasons["unknown_vendor"], reasons["duplicate_in_batch"]]
    return s.spark.createDataFrame(
        [tuple(row)],
        "rows_read long, rows_valid long, rows_rejected long, anomaly_rows long, unknown_vendor long, "
        "duplicate_in_batch long",
    )


@query(
    "distinctness_o75",
    with_trips(
        """SELECT count(*) AS rows, count(DISTINCT trip_id) AS distinct_keys,
             count(*) - count(DISTINCT trip_id) AS surplus_rows FROM judged""",
        "judged",
    ),
)
def distinctness(s: Sample) -> DataFrame:
    return reconcile.distinctness(s.judged, "trip_id")


@query(
    "outlier_share_o77",
    with_trips(
        """SELECT 'trip_distance' AS column_name, count(*) FILTER (WHERE trip_distance > 100) AS rows_over,
             CAST(sum(d) FILTER (WHERE d > 100) AS DOUBLE) / CAST(sum(d) AS DOUBLE) AS share_of_total,
             CAST(sum(d) FILTER (WHERE d > 0) AS DOUBLE) / count(*) FILTER (WHERE d > 0) AS mean_with,
             CAST(sum(d) FILTER (WHERE d > 0 AND d <= 100) AS DOUBLE) / count(*) FILTER (WHERE d > 0 AND d <= 100)
               AS mean_without,
             quantile_cont(trip_distance, 0.5) AS median
           FROM (SELECT trip_distance, CAST(trip_distance AS DECIMAL(10,2)) AS d FROM trips)""",
        "trips",
    ),
)
def outlier_share(s: Sample) -> DataFrame:
    return profiling.outlier_share(s.raw, "trip_distance", 100)


_OPTIONAL = ["passenger_count", "RatecodeID", "store_and_fwd_flag", "congestion_surcharge", "Airport_fee"]


@query(
    "null_patterns_o78",
    with_trips(
        "SELECT "
        + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in _OPTIONAL)
        + " AS null_pattern, payment_type, count(*) AS rows FROM trips GROUP BY ALL",
        "trips",
    ),
)
def null_patterns(s: Sample) -> DataFrame:
    return profiling.null_patterns(s.raw, _OPTIONAL, ["payment_type"])


@query(
    "first_occurrence_o89",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1""",
)
def first_occurrence(s: Sample) -> DataFrame:
    """First line per (order, line number), ordered by part, supplier and price."""
    lines = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    place = F.struct("l_partkey", "l_suppkey", "l_extendedprice")
    keyed = lines.withColumn("_line", F.struct("l_orderkey", "l_linenumber")).withColumn(POSITION, place)
    return dedup.first_per_key(keyed, "_line").drop("_line", POSITION)


@query(
    "drop_duplicates_o97",
    with_trips("SELECT trip_id, reason_codes, total_amount FROM judged WHERE repeat_no = 1", "judged"),
)
def drop_duplicates(s: Sample) -> DataFrame:
    """Whole first row of every trip_id in file order."""
    rows = s.judged.select("trip_id", "reason_codes", "total_amount", POSITION)
    return dedup.first_rows(rows, "trip_id").drop(POSITION)


@query(
    "quarantine_rows_o25",
    with_trips(
        f"""SELECT {_ALL_RAW}, trip_id, reason_codes, 'sample.parquet' AS source_file, '{SAMPLE_MONTH}' AS ingest_month,
              TIMESTAMP '2001-01-01' AS quarantined_at
            FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY copy) AS n FROM bad) WHERE n = 1""",
        "judged",
    ),
)
def quarantine_rows(s: Sample) -> DataFrame:
    return rules.quarantine_rows(rules.rejected(s.judged), "sample.parquet", SAMPLE_MONTH, SAMPLE_NOW)

