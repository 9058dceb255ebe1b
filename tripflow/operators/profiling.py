"""Batch profiles: completeness, violations, duplicates, distributions. One pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.functions.numbers import ratio
from tripflow.operators.rules import NULL_RATE_WARNING


def null_rates(df: DataFrame, columns: list[str] | None = None, threshold: float = NULL_RATE_WARNING) -> DataFrame:
    """Null share and severity per column; no rows for an empty batch."""
    columns = columns or schemas.RAW_COLUMNS
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rate = F.col("null_rows") / F.col("_rows")
    severity = F.when(rate > threshold, "warning").when(rate > 0, "info").otherwise("none")
    return (
        totals.filter("_rows > 0")
        .unpivot("_rows", columns, "column_name", "null_rows")
        .select("column_name", "null_rows", rate.alias("null_rate"), severity.alias("severity"))
    )


def violation_checks() -> dict[str, Column]:
    """The five exploration checks under their fixed names. Here a dropoff equal to the pickup is no violation."""
    return {
        "Passenger Count <= 0": F.col("passenger_count") <= 0,
        "Trip Distance <= 0": F.col("trip_distance") <= 0,
        "Fare Amount < 0": F.col("fare_amount") < 0,
        "Total Amount < 0": F.col("total_amount") < 0,
        "Dropoff Before Pickup": F.col("tpep_dropoff_datetime") < F.col("tpep_pickup_datetime"),
    }


def violation_summary(df: DataFrame) -> DataFrame:
    """Count and percentage per check, of rows with any violation, and of clean rows."""
    checks = {name: F.coalesce(test, F.lit(False)) for name, test in violation_checks().items()}
    any_of = None
    for test in checks.values():
        any_of = test if any_of is None else any_of | test
    lines = {**checks, "Any Violation": any_of, "Clean": ~any_of}
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(test).alias(name) for name, test in lines.items()])
    return (
        totals.filter("_rows > 0")
        .unpivot("_rows", list(lines), "check_name", "rows")
        .select("check_name", "rows", (F.col("rows") / F.col("_rows") * 100).alias("pct"))
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows, and rows that repeat an earlier row in every column.

    Sixteen bytes of digests of a row are counted first; only rows whose digests repeat are compared
    as whole rows, so a delivery without repeats never shuffles a wide row.
    """
    digest = F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)
    counts = df.select(*[d.alias(f"_d{i}") for i, d in enumerate(digest)]).groupBy("_d0", "_d1").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"))
    repeated = counts.filter("_n > 1").select("_d0", "_d1")
    suspects = df.select("*", *[d.alias(f"_d{i}") for i, d in enumerate(digest)]).join(repeated, ["_d0", "_d1"], "left_semi")
    groups = suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    repeats = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    both = totals.withColumn("duplicate_rows", F.lit(0)).unionByName(repeats.withColumn("rows", F.lit(0)))
    return both.agg(F.sum("rows").cast("long").alias("rows"), F.sum("duplicate_rows").cast("long").alias("duplicate_rows"))


# Values are held to eight decimals and sixteen digits before the point; larger ones fail the cast.
VALUE = "decimal(24,8)"
TIMES = "decimal(12,0)"
# Steps of a bucket per doubling of the value.
QUANTILE_STEPS = 1024


def _value_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and distinct value."""
    long = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).cast(VALUE).alias(c) for c in columns])
    long = long.unpivot([], columns, "column_name", "value")
    return long.filter("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _bucket(value: Column) -> Column:
    """A bucket number that never falls as the value grows: steps of a 1,024th of a doubling on each side of zero."""
    size = F.floor(QUANTILE_STEPS * (F.log2(F.abs(value).cast("double")) + 32)) + 1
    return F.when(value == 0, 0).otherwise(F.when(value < 0, -size).otherwise(size)).cast("long")


def exact_quantiles(values: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per column from a value table, exact and without one task seeing all values.

    Two bounded steps: the value type has at most some 160,000 buckets, so the running count over
    buckets is small; then only the buckets that hold a wanted rank are opened.
    """
    bucketed = values.withColumn("_bucket", _bucket(F.col("value")))
    by_bucket = Window.partitionBy("column_name").orderBy("_bucket")
    buckets = (
        bucketed.groupBy("column_name", "_bucket")
        .agg(F.sum("n").alias("_rows"))
        .withColumn("_through", F.sum("_rows").over(by_bucket))
        .withColumn("_total", F.sum("_rows").over(Window.partitionBy("column_name")))
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(q).alias("share")) for k, q in shares.items()]))
    place = (F.col("_total") - 1) * F.col("_wanted.share")
    ranks = (
        buckets.groupBy("column_name")
        .agg(F.max("_total").alias("_total"))
        .select("column_name", wanted.alias("_wanted"), "_total")
        .select("column_name", F.col("_wanted.name").alias("name"), place.alias("_place"))
        .select("*", F.explode(F.array(F.floor("_place"), F.ceil("_place"))).alias("_rank"))
        .distinct()
    )
    hit = (
        ranks.join(buckets, "column_name")
        .filter((F.col("_rank") < F.col("_through")) & (F.col("_rank") >= F.col("_through") - F.col("_rows")))
        .select("column_name", "name", "_place", "_rank", "_bucket", (F.col("_through") - F.col("_rows")).alias("_before"))
    )
    in_bucket = Window.partitionBy("column_name", "name", "_rank").orderBy("value")
    found = (
        bucketed.join(hit, ["column_name", "_bucket"])
        .withColumn("_end", F.col("_before") + F.sum("n").over(in_bucket))
        .filter((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("n")))
    )
    low, high = F.min("value").cast("double"), F.max("value").cast("double")
    part = F.max("_place") - F.floor(F.max("_place"))
    return found.groupBy("column_name", "name").agg((low + (high - low) * part).alias("quantile"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, standard deviation, min, exact quartiles and max of numeric columns, one row each."""
    values = _value_table(df, columns)
    n, value = F.col("n").cast(TIMES), F.col("value")
    rows = F.sum("n")
    total = F.sum(value * n).cast("double")
    squares = F.sum(value * value * n).cast("double")
    moments = values.groupBy("column_name").agg(
        rows.cast("long").alias("non_null"),
        (total / rows).alias("mean"),
        F.when(rows > 1, F.sqrt((squares - total * total / rows) / (rows - 1))).alias("stddev"),
        F.min("value").cast("double").alias("min"),
        F.max("value").cast("double").alias("max"),
    )
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = (
        exact_quantiles(values, names).groupBy("column_name").pivot("name", list(names)).agg(F.first("quantile"))
    )
    return moments.join(quartiles, "column_name")


def time_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_value"), F.max(column).alias("last_value"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def null_patterns(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows per combination of missing columns: one row per pattern shows whether they agree."""
    bits = [F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns]
    return df.groupBy(F.concat(*bits).alias("null_pattern"), *by).agg(F.count(F.lit(1)).alias("rows"))


def outlier_share(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows above ``limit``, their share of the column's total, the mean with and without them, the median.

    Means are over positive values. Sums are exact: values are fixed-point.
    """
    values = _value_table(df, [column])
    n, value = F.col("n").cast(TIMES), F.col("value")
    over, positive = value > limit, value > 0
    kept = positive & ~over

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, value * n)).cast("double"), F.lit(0.0))

    shares = values.groupBy("column_name").agg(
        rows(over).alias("rows_over"),
        ratio(total(over), total(F.lit(True))).alias("share_of_total"),
        ratio(total(positive), rows(positive)).alias("mean_with"),
        ratio(total(kept), rows(kept)).alias("mean_without"),
    )
    median = exact_quantiles(values, {"p50": 0.5}).select("column_name", F.col("quantile").alias("median"))
    return shares.join(median, "column_name")
