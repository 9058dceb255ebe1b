"""Queries on joins of the star and on the fact reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.catalog.oracle import with_trips
from tripflow.catalog.registry import Sample, query
from tripflow.functions.calendar import month_text
from tripflow.operators import analytics, reconcile
from tripflow.sources import warehouse



def _rows() -> Column:
    return F.count(F.lit(1))


@query(
    "fact_join_date_o40",
    with_trips(
        """SELECT year, month, day_name, count(*) AS trips FROM unjudged_fact JOIN dim_date USING (date_key)
           GROUP BY ALL""",
        "dims",
    ),
)
def fact_join_date(s: Sample) -> DataFrame:
    """All trips, also those without a pickup: they match no date."""
    per_day = s.unjudged_fact.groupBy("date_key").agg(_rows().alias("n"))
    return per_day.join(s.dim_date, "date_key").groupBy("year", "month", "day_name").agg(F.sum("n").alias("trips"))


@query(
    "fact_join_location_o41",
    with_trips(
        """SELECT 'inner' AS kind, location_id, count(*) AS trips
           FROM unjudged_fact JOIN dim_location ON pickup_location_key = location_key GROUP BY ALL
           UNION ALL
           SELECT 'left', location_id, count(*)
           FROM unjudged_fact LEFT JOIN dim_location ON pickup_location_key = location_key GROUP BY ALL""",
        "dims",
    ),
)
def fact_join_location(s: Sample) -> DataFrame:
    per_zone = s.unjudged_fact.groupBy(F.col("pickup_location_key").alias("location_key")).agg(_rows().alias("n"))
    zones = s.dim_location.select("location_key", "location_id")

    def joined(kind: str) -> DataFrame:
        rows = per_zone.join(zones, "location_key", kind)
        return rows.groupBy("location_id").agg(F.sum("n").alias("trips")).withColumn("kind", F.lit(kind))

    return joined("inner").unionByName(joined("left"))


@query(
    "fact_join_payment_o42",
    with_trips(
        """SELECT 'inner' AS kind, payment_description, count(*) AS trips
           FROM unjudged_fact JOIN dim_payment USING (payment_type_key) GROUP BY ALL
           UNION ALL
           SELECT 'left', payment_description, count(*)
           FROM unjudged_fact LEFT JOIN dim_payment USING (payment_type_key) GROUP BY ALL""",
        "unjudged_fact",
    ),
)
def fact_join_payment(s: Sample) -> DataFrame:
    per_key = s.unjudged_fact.groupBy("payment_type_key").agg(_rows().alias("n"))

    def joined(kind: str) -> DataFrame:
        rows = per_key.join(s.payment, "payment_type_key", kind)
        return rows.groupBy("payment_description").agg(F.sum("n").alias("trips")).withColumn("kind", F.lit(kind))

    return joined("inner").unionByName(joined("left"))


@query(
    "fact_join_vendor_payment_o43",
    with_trips(
        """SELECT vendor_id, payment_type_id, count(*) AS trips, CAST(sum(total_amount) AS DOUBLE) AS revenue
           FROM fact JOIN dim_vendor USING (vendor_key) JOIN dim_payment USING (payment_type_key) GROUP BY ALL""",
        "fact",
    ),
)
def fact_join_vendor_payment(s: Sample) -> DataFrame:
    per_key = s.fact.groupBy("vendor_key", "payment_type_key").agg(_rows().alias("n"), F.sum("total_amount").alias("sum"))
    named = per_key.join(s.vendor, "vendor_key").join(s.payment, "payment_type_key")
    return named.groupBy("vendor_id", "payment_type_id").agg(
        F.sum("n").alias("trips"), F.sum("sum").cast("double").alias("revenue")
    )


@query(
    "fact_join_rate_code_o44",
    with_trips(
        """SELECT rate_code_id, count(*) AS trips, (SELECT count(*) FROM fact WHERE rate_code_key IS NULL) AS dropped
           FROM fact JOIN dim_rate_code USING (rate_code_key) GROUP BY 1""",
        "fact",
    ),
)
def fact_join_rate_code(s: Sample) -> DataFrame:
    """The inner join drops trips without a rate code; ``dropped`` says how many."""
    per_key = s.fact.groupBy("rate_code_key").agg(_rows().alias("n"))
    dropped = per_key.filter("rate_code_key is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dropped"))
    named = per_key.join(s.rate_code, "rate_code_key").select("rate_code_id", F.col("n").alias("trips"))
    # One row on the right: a constant key attaches it to the few rate codes.
    return named.withColumn("_one", F.lit(1)).join(dropped.withColumn("_one", F.lit(1)), "_one").drop("_one")


_KEYS = {
    "date_key": ("dim_date", "date_key"),
    "pickup_location_key": ("dim_location", "location_key"),
    "dropoff_location_key": ("dim_location", "location_key"),
}


@query(
    "orphan_keys_o49",
    with_trips(
        "SELECT * FROM ("
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS orphan_rows FROM unjudged_fact "
            f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {d})"
            for c, (d, k) in _KEYS.items()
        )
        + ") WHERE orphan_rows > 0",
        "dims",
    ),
)
def orphan_keys(s: Sample) -> DataFrame:
    """Unjudged trips against the dimensions of the accepted ones; code keys are mapped, so never orphans."""
    dims = {
        "dim_date": s.dim_date,
        "dim_location": s.dim_location,
        "dim_vendor": s.vendor,
        "dim_payment": s.payment,
        "dim_rate_code": s.rate_code,
    }
    return warehouse.orphan_counts(s.unjudged_fact, dims)


@query(
    "insert_if_absent_o50",
    with_trips(
        """SELECT strftime(pickup_datetime, '%Y-%m') AS trip_month, count(*) AS rows_new
           FROM fact WHERE trip_id NOT IN (SELECT trip_id FROM fact WHERE is_anomaly) GROUP BY 1""",
        "fact",
    ),
)
def insert_if_absent(s: Sample) -> DataFrame:
    """New rows per month when the table already holds the flagged trips."""
    fresh = warehouse.absent_rows_staged(s.fact, s.fact.filter("is_anomaly"), "trip_id")
    return fresh.groupBy(month_text(F.col("pickup_datetime")).alias("trip_month")).agg(_rows().alias("rows_new"))


@query(
    "fact_quarantine_overlap_o52",
    with_trips(
        "SELECT count(DISTINCT trip_id) AS shared_keys FROM good WHERE trip_id IN (SELECT trip_id FROM bad)", "judged"
    ),
)
def fact_quarantine_overlap(s: Sample) -> DataFrame:
    """Not always 0: an accepted trip's duplicate is quarantined under the same key."""
    return reconcile.overlap(s.fact, s.judged.filter("reason_codes <> ''"), "trip_id")


@query(
    "revenue_by_weekday_o55",
    with_trips(
        """SELECT day_name, count(*) AS trip_count, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
             round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 2) AS avg_total
           FROM fact, dim_date WHERE fact.date_key = dim_date.date_key AND NOT is_anomaly GROUP BY day_name""",
        "dims",
    ),
)
def revenue_by_weekday(s: Sample) -> DataFrame:
    return analytics.revenue_by_weekday(s.fact, s.dim_date)


_TOP_ZONES = """SELECT pickup_location_key AS pickup_location_id, count(*) AS trip_count,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue
  FROM fact WHERE NOT is_anomaly AND pickup_location_key IN (SELECT location_key FROM dim_location)
  GROUP BY 1 ORDER BY sum(total_amount) DESC, 1 LIMIT 10"""


@query("top_pickup_zones_o56", with_trips(_TOP_ZONES, "dims"))
def top_pickup_zones(s: Sample) -> DataFrame:
    return analytics.top_pickup_zones(s.fact, s.dim_location)


@query(
    "payment_mix_by_vendor_o57",
    with_trips(
        """SELECT (SELECT vendor_name FROM dim_vendor v WHERE v.vendor_key = f.vendor_key) AS vendor_name,
             (SELECT payment_description FROM dim_payment p WHERE p.payment_type_key = f.payment_type_key)
               AS payment_description,
             count(*) AS trip_count, round(CAST(sum(tip_amount) AS DOUBLE) / count(tip_amount), 2) AS avg_tip
           FROM fact f GROUP BY ALL""",
        "fact",
    ),
)
def payment_mix_by_vendor(s: Sample) -> DataFrame:
    return analytics.payment_mix_by_vendor(s.fact, s.vendor, s.payment)


@query(
    "fare_by_rate_type_o58",
    with_trips(
        """SELECT (SELECT rate_description FROM dim_rate_code r WHERE r.rate_code_key = f.rate_code_key)
               AS rate_description,
             count(*) AS trip_count,
             round(CAST(sum(fare_amount) AS DOUBLE) / count(fare_amount), 2) AS avg_fare_amount
           FROM fact f WHERE rate_code_key IS NOT NULL GROUP BY ALL""",
        "fact",
    ),
)
def fare_by_rate_type(s: Sample) -> DataFrame:
    return analytics.fare_by_rate_type(s.fact, s.rate_code)
