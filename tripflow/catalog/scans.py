"""Queries on scans, exports, keys and the star's building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.catalog.oracle import with_trips
from tripflow.catalog.registry import Sample, query
from tripflow.functions.calendar import date_key
from tripflow.functions.keys import KEY_FIELDS, add_trip_id
from tripflow.functions.numbers import half_even_int, money
from tripflow.operators import analytics, reconcile, rules, star
from tripflow.sources import raw
from tripflow.sources.sample import SAMPLE_MONTH

_FACT_TEXT = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in schemas.FACT_AMOUNTS or c == "trip_distance" else c
    for c in schemas.FACT_COLUMNS
)


@query(
    "month_scan_o01",
    with_trips(
        """SELECT VendorID, count(*) AS rows, count(*) AS positions,
             CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) AS total_amount
           FROM trips GROUP BY VendorID""",
        "trips",
    ),
)
def month_scan(s: Sample) -> DataFrame:
    raw_dir = s.scratch("raw")
    s.raw.write.parquet(f"{raw_dir}/{raw.MONTH_FILE.format(month=SAMPLE_MONTH)}")
    month = raw.read_month(s.spark, raw_dir, SAMPLE_MONTH)
    return month.groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(raw.POSITION).alias("positions"),
        F.sum(F.col("total_amount").cast("decimal(12,2)")).alias("total_amount"),
    )


@query(
    "adhoc_parquet_o02",
    """SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
       FROM orders GROUP BY o_orderstatus""",
)
def adhoc_parquet(s: Sample) -> DataFrame:
    return (
        raw.read_raw_parquet(s.spark, f"{s.folder}/orders.parquet")
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))
    )


@query(
    "csv_scan_o03",
    with_trips(
        """SELECT payment_type, count(*) AS rows, count(passenger_count) AS with_passengers,
             min(tpep_pickup_datetime) AS first_pickup,
             CAST(sum(CAST(tip_amount AS DECIMAL(12,2))) AS DOUBLE) AS tips
           FROM trips GROUP BY payment_type""",
        "trips",
    ),
)
def csv_scan(s: Sample) -> DataFrame:
    path = s.scratch("csv")
    raw.export_csv(s.raw, path)
    return (
        raw.read_raw_csv(s.spark, path)
        .groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("passenger_count").alias("with_passengers"),
            F.min("tpep_pickup_datetime").alias("first_pickup"),
            F.sum(F.col("tip_amount").cast("decimal(12,2)")).alias("tips"),
        )
    )


@query(
    "csv_export_o04",
    with_trips(
        """SELECT store_and_fwd_flag, count(*) AS rows, count(Airport_fee) AS with_airport_fee
           FROM trips GROUP BY store_and_fwd_flag""",
        "trips",
    ),
)
def csv_export(s: Sample) -> DataFrame:
    """The second export finds the first and leaves it alone."""
    path = s.scratch("csv")
    raw.export_csv(s.raw, path)
    raw.export_csv(s.raw.unionAll(s.raw), path)
    return (
        raw.read_raw_csv(s.spark, path)
        .groupBy("store_and_fwd_flag")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("Airport_fee").alias("with_airport_fee"))
    )


_CONTAINED_BY = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "total_amount",
]


@query(
    "random_sample_o05",
    with_trips("SELECT least(count(*), 1000) AS sample_rows, CAST(0 AS BIGINT) AS rows_not_in_raw FROM trips", "trips"),
)
def random_sample(s: Sample) -> DataFrame:
    """A random extract of 1,000 rows, and how many of them the raw file does not hold."""
    path = s.scratch("extract")
    raw.export_csv(raw.random_sample(s.raw, 1000, seed=42), path)
    return reconcile.containment(raw.read_raw_csv(s.spark, path), s.raw, _CONTAINED_BY)


@query(
    "sample_in_raw_o53",
    with_trips(
        """, extract AS (
             SELECT *, CASE WHEN RatecodeID = 42 THEN total_amount + 1 ELSE total_amount END AS seen_amount FROM trips)
           SELECT count(*) AS sample_rows,
             count(*) FILTER (WHERE NOT EXISTS (
               SELECT 1 FROM trips t
               WHERE t.VendorID IS NOT DISTINCT FROM x.VendorID
                 AND t.tpep_pickup_datetime IS NOT DISTINCT FROM x.tpep_pickup_datetime
                 AND t.tpep_dropoff_datetime IS NOT DISTINCT FROM x.tpep_dropoff_datetime
                 AND t.PULocationID IS NOT DISTINCT FROM x.PULocationID
                 AND t.DOLocationID IS NOT DISTINCT FROM x.DOLocationID
                 AND t.total_amount IS NOT DISTINCT FROM x.seen_amount)) AS rows_not_in_raw
           FROM extract x""",
        "trips",
    ),
)
def sample_in_raw(s: Sample) -> DataFrame:
    """An extract in which the amounts of trips with an unknown rate code were changed."""
    changed = F.when(F.col("RatecodeID") == 42, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    return reconcile.containment(s.raw.withColumn("total_amount", changed), s.raw, _CONTAINED_BY)


@query("trip_id_o18", with_trips("SELECT trip_id, VendorID, total_amount FROM keyed", "keyed"))
def trip_id(s: Sample) -> DataFrame:
    return add_trip_id(s.raw.select(*KEY_FIELDS)).select("trip_id", "VendorID", "total_amount")


@query(
    "fact_names_o19",
    with_trips(
        """SELECT Airport_fee AS airport_fee, count(*) AS rows, min(tpep_pickup_datetime) AS first_pickup,
             max(tpep_dropoff_datetime) AS last_dropoff
           FROM trips GROUP BY Airport_fee""",
        "trips",
    ),
)
def fact_names(s: Sample) -> DataFrame:
    renamed = s.raw.withColumnsRenamed(star.FACT_NAMES)
    return renamed.groupBy("airport_fee").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("dropoff_datetime").alias("last_dropoff"),
    )


@query(
    "date_key_o20",
    with_trips(
        """SELECT CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS rows
           FROM trips GROUP BY 1""",
        "trips",
    ),
)
def date_keys(s: Sample) -> DataFrame:
    return s.raw.groupBy(date_key(F.col("tpep_pickup_datetime")).alias("date_key")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "dim_date_rows_o21",
    with_trips("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date", "dims"),
)
def dim_date_rows(s: Sample) -> DataFrame:
    return s.dim_date


@query(
    "dim_location_rows_o22",
    with_trips(
        """SELECT location_key, location_id, CAST(NULL AS VARCHAR) AS borough, CAST(NULL AS VARCHAR) AS zone,
             CAST(NULL AS VARCHAR) AS service_zone FROM dim_location""",
        "dims",
    ),
)
def dim_location_rows(s: Sample) -> DataFrame:
    return s.dim_location


@query("fact_rows_o23", with_trips(f"SELECT {_FACT_TEXT} FROM fact", "fact"))
def fact_rows(s: Sample) -> DataFrame:
    return star.fact_rows(s.good, s.vendor, s.payment, s.rate_code)


@query(
    "load_casts_o24",
    with_trips(
        """SELECT CAST(passenger_count / 2 AS INTEGER) AS half_passengers,
             CAST(CAST(CAST(trip_distance AS DECIMAL(10,2)) AS VARCHAR) AS VARCHAR) AS distance_text,
             CAST(CAST(extra AS DECIMAL(10,2)) AS VARCHAR) AS extra_text, count(*) AS rows
           FROM trips GROUP BY ALL""",
        "trips",
    ),
)
def load_casts(s: Sample) -> DataFrame:
    """DOUBLE to INTEGER with halves to even, DOUBLE to two decimals."""
    return s.raw.groupBy(
        half_even_int(F.col("passenger_count") / 2).alias("half_passengers"),
        money(F.col("trip_distance")).cast("string").alias("distance_text"),
        money(F.col("extra")).cast("string").alias("extra_text"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "code_dimensions_o10",
    with_trips(
        """SELECT 'vendor' AS dimension, vendor_key AS key, vendor_id AS id, vendor_name AS description,
             count(VendorID) AS trips
           FROM dim_vendor LEFT JOIN trips ON VendorID = vendor_id GROUP BY ALL
           UNION ALL
           SELECT 'payment', payment_type_key, payment_type_id, payment_description, count(payment_type)
           FROM dim_payment LEFT JOIN trips ON payment_type = payment_type_id GROUP BY ALL
           UNION ALL
           SELECT 'rate_code', rate_code_key, rate_code_id, rate_description, count(RatecodeID)
           FROM dim_rate_code LEFT JOIN trips ON RatecodeID = rate_code_id GROUP BY ALL""",
        "seeds",
    ),
)
def code_dimensions(s: Sample) -> DataFrame:
    """Every seeded code with the trips that carry it, 0 included."""

    def used(dim: DataFrame, name: str, column: str) -> DataFrame:
        key, code, text = dim.columns
        counts = s.raw.groupBy(F.col(column).cast("int").alias(code)).agg(F.count(F.lit(1)).alias("trips"))
        return dim.join(counts, code, "left").select(
            F.lit(name).alias("dimension"),
            F.col(key).alias("key"),
            F.col(code).alias("id"),
            F.col(text).alias("description"),
            F.coalesce("trips", F.lit(0)).cast("long").alias("trips"),
        )

    return (
        used(s.vendor, "vendor", "VendorID")
        .unionByName(used(s.payment, "payment", "payment_type"))
        .unionByName(used(s.rate_code, "rate_code", "RatecodeID"))
    )


@query(
    "code_map_o11",
    with_trips(
        """SELECT VendorID, vendor_key, payment_type, payment_type_key, RatecodeID, rate_code_key, count(*) AS rows
           FROM trips LEFT JOIN dim_vendor ON VendorID = vendor_id
           LEFT JOIN dim_payment ON payment_type = payment_type_id
           LEFT JOIN dim_rate_code ON RatecodeID = rate_code_id
           GROUP BY ALL""",
        "seeds",
    ),
)
def code_map(s: Sample) -> DataFrame:
    codes = ["VendorID", "payment_type", "RatecodeID"]
    used = s.raw.groupBy(*codes).agg(F.count(F.lit(1)).alias("rows"))
    return star.map_codes(used, s.vendor, s.payment, s.rate_code).select(
        "VendorID", "vendor_key", "payment_type", "payment_type_key", "RatecodeID", "rate_code_key", "rows"
    )


@query(
    "code_mapping_join_o45",
    with_trips(
        """SELECT vendor_key, payment_type_key, rate_code_key, count(*) AS rows FROM unjudged_fact GROUP BY ALL""",
        "unjudged_fact",
    ),
)
def code_mapping_join(s: Sample) -> DataFrame:
    """Codes of all trips, rejected ones included: an unmatched code maps to NULL."""
    mapped = star.map_codes(s.raw, s.vendor, s.payment, s.rate_code)
    return mapped.groupBy("vendor_key", "payment_type_key", "rate_code_key").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "zone_union_o95",
    with_trips(
        "SELECT CAST(PULocationID AS INTEGER) AS location_id FROM trips WHERE PULocationID IS NOT NULL "
        "UNION SELECT CAST(DOLocationID AS INTEGER) FROM trips WHERE DOLocationID IS NOT NULL",
        "trips",
    ),
)
def zone_union(s: Sample) -> DataFrame:
    return star.location_ids(s.raw)


@query(
    "top_raw_zones_o59",
    with_trips(
        """SELECT PULocationID AS pickup_location_id, count(*) AS trip_count,
             CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
           FROM trips GROUP BY 1 ORDER BY total_revenue DESC, 1 LIMIT 10""",
        "trips",
    ),
)
def top_raw_zones(s: Sample) -> DataFrame:
    return analytics.top_raw_zones(s.raw)


@query(
    "mean_amount_by_zone_o60",
    with_trips(
        """SELECT PULocationID, CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) / count(total_amount) AS avg_val
           FROM trips GROUP BY 1""",
        "trips",
    ),
)
def mean_amount_by_zone(s: Sample) -> DataFrame:
    return analytics.mean_amount_by_zone(s.raw)


@query(
    "result_reconciliation_o54",
    with_trips(
        """, sums AS (SELECT PULocationID AS key, sum(CAST(total_amount AS DECIMAL(12,2))) AS v FROM trips GROUP BY 1)
           SELECT key, CAST(CASE WHEN key > 200 THEN 2 ELSE 3 END AS BIGINT) AS sources,
             key <= 200 AND key <> 110 AS agrees
           FROM sums WHERE key IS NOT NULL""",
        "trips",
    ),
)
def result_reconciliation(s: Sample) -> DataFrame:
    """Three results compared: one lacks the zones above 200, another is off by a cent and more in zone 110."""
    by_zone = s.raw.filter("PULocationID IS NOT NULL").groupBy("PULocationID")
    exact = by_zone.agg(F.sum(F.col("total_amount").cast("decimal(12,2)")).cast("double").alias("v"))
    off = exact.withColumn("v", F.col("v") + F.when(F.col("PULocationID") == 110, 0.02).otherwise(0.0))
    plain_sums = by_zone.agg(F.round(F.sum("total_amount"), 2).alias("v"))
    checked = reconcile.cross_check(
        {"fixed-point": off, "double": plain_sums, "partial": exact.filter("PULocationID <= 200")}, "PULocationID", "v"
    )
    return checked.select("key", "sources", "agrees")


@query(
    "unvalidated_sample_o53_rejects",
    with_trips(
        """SELECT PULocationID, count(*) AS rows, count(*) FILTER (WHERE reason_codes <> '') AS would_be_rejected
           FROM judged GROUP BY 1""",
        "judged",
    ),
)
def unvalidated_sample(s: Sample) -> DataFrame:
    """An extract taken before validation still holds rows the load would quarantine: how many per zone."""
    return s.judged.groupBy("PULocationID").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason_codes") != "").alias("would_be_rejected")
    )


# About a quarter of all keys.
SAMPLE_BELOW = "4"


@query(
    "trace_figure_o110",
    with_trips(
        f"""SELECT 'sample' AS level, PULocationID AS zone, count(*) AS trips,
             CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM judged WHERE trip_id < '{SAMPLE_BELOW}' GROUP BY 2
           UNION ALL
           SELECT 'sample rejected', PULocationID, count(*), CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE)
           FROM judged WHERE trip_id < '{SAMPLE_BELOW}' AND reason_codes <> '' GROUP BY 2
           UNION ALL
           SELECT 'raw', PULocationID, count(*),
             CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) FROM trips GROUP BY 2
           UNION ALL
           SELECT 'accepted', PULocationID, count(*), CAST(sum(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE)
           FROM good GROUP BY 2
           UNION ALL
           SELECT 'fact', pickup_location_key, count(*), CAST(sum(total_amount) AS DOUBLE) FROM fact GROUP BY 2
           UNION ALL
           SELECT 'mart', pickup_location_id, CAST(sum(trip_count) AS BIGINT), CAST(sum(total_revenue) AS DOUBLE)
           FROM mart GROUP BY 2""",
    ),
)
def trace_figure(s: Sample) -> DataFrame:
    """Trips and revenue of every zone at each level, side by side.

    The extract of the keys below a bound is taken before validation, as any extract of the raw file
    is; the rows of it that the load rejects explain what an accepted figure lacks.
    """
    extract = raw.extract_by_key(s.judged, SAMPLE_BELOW)
    amounts = [F.col("PULocationID").alias("zone"), F.col("total_amount").alias("amount")]
    return reconcile.trace_by_zone(
        {
            "sample": extract.select(*amounts),
            "sample rejected": rules.rejected(extract).select(*amounts),
            "raw": s.raw.select(F.col("PULocationID").alias("zone"), F.col("total_amount").alias("amount")),
            "accepted": s.good.select(F.col("PULocationID").alias("zone"), F.col("total_amount").alias("amount")),
            "fact": s.fact.select(F.col("pickup_location_key").alias("zone"), F.col("total_amount").alias("amount")),
            "mart": s.mart.select(
                F.col("pickup_location_id").alias("zone"),
                F.col("trip_count").alias("trips"),
                F.col("total_revenue").alias("revenue"),
            ),
        }
    )


@query(
    "accept_reject_split_o34",
    with_trips(
        """SELECT VendorID, count(*) FILTER (WHERE reason_codes = '') AS accepted,
             count(*) FILTER (WHERE reason_codes <> '') AS rejected FROM judged GROUP BY 1""",
        "judged",
    ),
)
def accept_reject_split(s: Sample) -> DataFrame:
    good = rules.accepted(s.judged).groupBy("VendorID").agg(F.count(F.lit(1)).alias("accepted"))
    bad = rules.rejected(s.judged).groupBy("VendorID").agg(F.count(F.lit(1)).alias("rejected"))
    both = good.withColumn("rejected", F.lit(0).cast("long")).unionByName(
        bad.withColumn("accepted", F.lit(0).cast("long"))
    )
    return both.groupBy("VendorID").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
