"""Checks between tables: equal totals, overlap, containment, tracing one figure through the levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CENT = 0.01


def distinctness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and the difference (0 for a key). Counted per key first, so no key is hot."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(key).alias("distinct_keys"),
        (F.coalesce(F.sum("_n"), F.lit(0)).cast("long") - F.count(key)).alias("surplus_rows"),
    )


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys both tables hold."""
    shared = left.select(key).distinct().join(right.select(key), key, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("shared_keys"))


def uncontained(sample: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """Sample rows that match no raw row on ``columns`` (NULL equals NULL).

    Both sides are reduced to counted distinct rows, so a row many copies share is compared once and
    the join is one of unique keys.
    """
    wanted = sample.groupBy(*columns).agg(F.count(F.lit(1)).alias("_sample_rows"))
    known = raw.select(*columns).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns])
    missing = wanted.alias("s").join(known.alias("r"), same, "left_anti")
    return missing.select(*columns, "_sample_rows")


def containment(sample: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """Sample rows, and how many of them the raw file does not hold."""
    total = sample.agg(F.count(F.lit(1)).alias("sample_rows")).withColumn("_one", F.lit(1))
    lost = uncontained(sample, raw, columns).agg(
        F.coalesce(F.sum("_sample_rows"), F.lit(0)).cast("long").alias("rows_not_in_raw")
    )
    return total.join(lost.withColumn("_one", F.lit(1)), "_one").drop("_one")


def cross_check(results: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Do several results hold the same keys, with values closer than a cent? One row per key that any holds."""
    tagged = [
        df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value"), F.lit(name).alias("source"))
        for name, df in results.items()
    ]
    spread = F.max("value") - F.min("value")
    agrees = (F.count_distinct("source") == len(results)) & F.coalesce(spread < CENT, F.lit(False))
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("key")
        .agg(F.count_distinct("source").alias("sources"), spread.alias("spread"), agrees.alias("agrees"))
    )


def mart_against_fact(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Trips and revenue of both tables, one row per table."""
    from_mart = mart.agg(F.sum("trip_count").alias("trips"), F.sum("total_revenue").alias("revenue"))
    from_fact = fact.agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue"))
    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(name).alias("source"),
                F.coalesce("trips", F.lit(0)).cast("long").alias("trips"),
                F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
            )
            for name, df in (("mart", from_mart), ("fact", from_fact))
        ],
    )


def trace_by_zone(levels: dict[str, DataFrame]) -> DataFrame:
    """Trips and revenue per zone at each level.

    Every frame has ``zone`` and either single trips (``amount``) or sums (``trips``, ``revenue``).
    """
    parts = []
    for name, df in levels.items():
        if "amount" in df.columns:
            sums = df.groupBy("zone").agg(
                F.count(F.lit(1)).alias("trips"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("revenue")
            )
        else:
            sums = df.groupBy("zone").agg(F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"))
        parts.append(
            sums.select(
                F.lit(name).alias("level"),
                F.col("zone").cast("long").alias("zone"),
                F.col("trips").cast("long").alias("trips"),
                F.col("revenue").cast("double").alias("revenue"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def table_audit(name: str, df: DataFrame, amount: str | None, top_key: str, distinct_key: str) -> DataFrame:
    """Row count, revenue, highest key and distinct business keys of a table: equal before and after a rebuild."""
    value = F.col(amount) if amount else F.lit(None).cast("decimal(10,2)")
    per_key = df.select(F.col(distinct_key).alias("_key"), F.col(top_key).alias("_top"), value.alias("_amount"))
    grouped = per_key.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_amount").alias("_sum"), F.max("_top").alias("_top")
    )
    return grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.sum("_sum").cast("double").alias("revenue"),
        F.max("_top").alias("max_key"),
        F.count("_key").alias("distinct_keys"),
    ).select(F.lit(name).alias("table_name"), "*")
