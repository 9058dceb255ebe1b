"""Common table expressions of the oracle SQL: the same derivations, written for a SQL engine."""

from __future__ import annotations

from tripflow import schemas

_DAMAGE = {
    "vendor": "disc = 0.06",
    "pickup": "disc = 0.10",
    "dropoff": "disc = 0.09",
    "pu": "disc = 0.08",
    "do": "disc = 0.07",
    "payment": "disc = 0.05",
    "rate": "disc = 0.04",
}


def _unless(field: str, value: str) -> str:
    return f"CASE WHEN NOT ({_DAMAGE[field]} AND tax = 0.08) THEN {value} END"


TRIPS = f"""
lines AS (
  SELECT *, CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sign,
         o_orderdate + to_minutes(CAST(l_quantity * 28 AS BIGINT)) AS pickup,
         unnest(CASE WHEN CAST(l_tax AS DECIMAL(4,2)) = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
trips AS (
  SELECT
    {_unless("vendor", "CAST(l_linenumber AS BIGINT)")} AS VendorID,
    {_unless("pickup", "pickup")} AS tpep_pickup_datetime,
    {_unless("dropoff", "pickup + to_minutes(date_diff('day', o_orderdate, l_shipdate))")} AS tpep_dropoff_datetime,
    CASE WHEN l_returnflag <> 'R' THEN l_quantity - 1 END AS passenger_count,
    (l_quantity - 1) * 3 AS trip_distance,
    CASE WHEN {_DAMAGE["rate"]} AND tax = 0.08 THEN 42.0
         WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS RatecodeID,
    CASE WHEN l_returnflag <> 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'Y' END END AS store_and_fwd_flag,
    {_unless("pu", "CAST(c_nationkey * 11 AS BIGINT)")} AS PULocationID,
    {_unless("do", "CAST(s_nationkey * 11 + 2 AS BIGINT)")} AS DOLocationID,
    CAST(CASE WHEN {_DAMAGE["payment"]} AND tax = 0.08 THEN 9
              WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS BIGINT) AS payment_type,
    CAST(CAST(price AS DECIMAL(12,2)) * sign AS DOUBLE) AS fare_amount,
    CAST(disc * 10 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(CAST(price * disc AS DECIMAL(12,2)) * sign AS DOUBLE) AS tip_amount,
    CAST(tax * 100 AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CAST(CAST(price * CAST(1 - disc AS DECIMAL(4,2)) * CAST(1 + tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) * sign AS DOUBLE)
      AS total_amount,
    CASE WHEN l_returnflag <> 'R' THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_returnflag <> 'R' THEN CAST(0.0 AS DOUBLE) END AS Airport_fee,
    CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
    copy
  FROM lines
)"""


def _text(column: str, number: bool = False) -> str:
    value = f"CAST(round({column} * 1e6) AS BIGINT)" if number else column
    return f"coalesce(CAST({value} AS VARCHAR), '~')"


KEYED = f"""
keyed AS (
  SELECT *, sha256(concat_ws('|', {_text("VendorID")}, {_text("tpep_pickup_datetime")},
    {_text("tpep_dropoff_datetime")}, {_text("PULocationID")}, {_text("DOLocationID")},
    {_text("passenger_count", True)}, {_text("trip_distance", True)},
    {_text("fare_amount", True)}, {_text("total_amount", True)})) AS trip_id
  FROM trips
)"""

HARD = {
    "missing_pickup_datetime": "tpep_pickup_datetime IS NULL",
    "missing_dropoff_datetime": "tpep_dropoff_datetime IS NULL",
    "missing_pickup_location": "PULocationID IS NULL",
    "missing_dropoff_location": "DOLocationID IS NULL",
    "dropoff_before_or_equal_pickup": "tpep_dropoff_datetime <= tpep_pickup_datetime",
    "pickup_in_future": "tpep_pickup_datetime > TIMESTAMP '2001-01-01'",
    "pickup_outside_file_month": "{month_rule}",
    "unknown_vendor": "VendorID IS NULL OR VendorID NOT IN ({vendors})",
    "unknown_payment_type": "payment_type NOT BETWEEN 0 AND 6",
    "unknown_rate_code": "RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)",
    "location_id_out_of_range": "PULocationID NOT BETWEEN 1 AND 265 OR DOLocationID NOT BETWEEN 1 AND 265",
    "duplicate_in_batch": "repeat_no > 1",
}
SOFT = {
    "zero_or_missing_passenger_count": "coalesce(passenger_count, 0) <= 0",
    "zero_or_negative_trip_distance": "trip_distance <= 0",
    "negative_fare_amount": "fare_amount < 0",
    "negative_total_amount": "total_amount < 0",
    "trip_over_24h": "tpep_dropoff_datetime - tpep_pickup_datetime > INTERVAL 24 HOUR",
}
MONTH_RULE = (
    "tpep_pickup_datetime < TIMESTAMP '1998-05-01' OR tpep_pickup_datetime >= TIMESTAMP '1998-06-01'"
)


def hard(code: str, month_rule: str = "FALSE", vendors: str = "1, 2, 6, 7") -> str:
    return f"coalesce({HARD[code].format(month_rule=month_rule, vendors=vendors)}, FALSE)"


def judged(month_rule: str = "FALSE", vendors: str = "1, 2, 6, 7") -> str:
    codes = ",\n      ".join(f"CASE WHEN {hard(c, month_rule, vendors)} THEN '{c}' END" for c in HARD)
    soft = " OR ".join(f"coalesce({test}, FALSE)" for test in SOFT.values())
    return f"""
judged AS (
  SELECT *, concat_ws(',', {codes}) AS reason_codes, ({soft}) AS is_anomaly
  FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY copy) AS repeat_no FROM keyed)
),
good AS (SELECT * FROM judged WHERE reason_codes = ''),
bad AS (SELECT * FROM judged WHERE reason_codes <> '')"""


# The code lists of the three seeded dimensions.
SEEDS = """
dim_vendor(vendor_key, vendor_id, vendor_name) AS (VALUES
  (1, 1, 'Creative Mobile Technologies, LLC'), (2, 2, 'Curb Mobility, LLC'), (3, 6, 'Myle Technologies Inc'),
  (4, 7, 'Helix')),
dim_payment(payment_type_key, payment_type_id, payment_description) AS (VALUES
  (1, 0, 'Unknown / not provided'), (2, 1, 'Credit card'), (3, 2, 'Cash'), (4, 3, 'No charge'), (5, 4, 'Dispute'),
  (6, 5, 'Unknown'), (7, 6, 'Voided trip')),
dim_rate_code(rate_code_key, rate_code_id, rate_description) AS (VALUES
  (1, 1, 'Standard rate'), (2, 2, 'JFK'), (3, 3, 'Newark'), (4, 4, 'Nassau or Westchester'), (5, 5, 'Negotiated fare'),
  (6, 6, 'Group ride'), (7, 99, 'Unknown / not provided'))"""

def _fact(name: str, source: str) -> str:
    money = ", ".join(f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in ["trip_distance", *schemas.FACT_AMOUNTS])
    return f"""
{name} AS (
  SELECT trip_id, CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(PULocationID AS INTEGER) AS pickup_location_key, CAST(DOLocationID AS INTEGER) AS dropoff_location_key,
    vendor_key, payment_type_key, rate_code_key,
    tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    CAST(passenger_count AS INTEGER) AS passenger_count, {money}, is_anomaly
  FROM {source}
  LEFT JOIN dim_vendor ON VendorID = vendor_id
  LEFT JOIN dim_payment ON payment_type = payment_type_id
  LEFT JOIN dim_rate_code ON RatecodeID = rate_code_id
)"""


DIMS = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(day(d) AS INTEGER) AS day,
    CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
    CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name
  FROM (SELECT DISTINCT CAST(tpep_pickup_datetime AS DATE) AS d FROM good)
),
dim_location AS (
  SELECT CAST(id AS INTEGER) AS location_key, CAST(id AS INTEGER) AS location_id
  FROM (SELECT PULocationID AS id FROM good UNION SELECT DOLocationID FROM good)
)"""


def _mart(name: str, fact: str) -> str:
    return f"""
{name}_trips AS (
  SELECT t.*,
    CASE WHEN fare_amount > 0 THEN 1 ELSE 0 END AS paid,
    CASE WHEN trip_distance > 0 AND trip_distance <= 100 THEN 1 ELSE 0 END AS measured,
    CASE WHEN payment_type_key = 2 AND fare_amount > 0 THEN 1 ELSE 0 END AS carded,
    (SELECT max(location_id) FROM dim_location z WHERE z.location_key = t.pickup_location_key) AS zone
  FROM {fact} t
  WHERE date_key IN (SELECT date_key FROM dim_date)
),
{name} AS (
  SELECT CAST(pickup_datetime AS DATE) AS pickup_date, zone AS pickup_location_id,
    count(*) AS trip_count,
    CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_trip_count,
    sum(total_amount) AS total_revenue,
    CAST(sum(paid) AS BIGINT) AS paid_trip_count,
    sum(fare_amount * paid) AS paid_fare_sum,
    CAST(sum(measured) AS BIGINT) AS distance_trip_count,
    sum(trip_distance * measured) AS distance_sum,
    sum(fare_amount * carded) AS card_fare_sum,
    sum(tip_amount * carded) AS card_tip_sum,
    max(pickup_datetime) AS last_pickup_datetime,
    TIMESTAMP '2001-01-01' AS refreshed_at
  FROM {name}_trips
  GROUP BY 1, 2
)"""


_ORDER = {
    "trips": TRIPS,
    "keyed": KEYED,
    "judged": judged(),
    "seeds": SEEDS,
    "fact": _fact("fact", "good"),
    "unjudged_fact": _fact("unjudged_fact", "judged"),
    "dims": DIMS,
    "mart": _mart("mart", "fact"),
    "unjudged_mart": _mart("unjudged_mart", "unjudged_fact"),
}


def with_trips(body: str, upto: str = "mart", judged_as: str | None = None) -> str:
    """``body`` after the expressions it may use, in order, up to ``upto``."""
    parts = []
    for name, text in _ORDER.items():
        parts.append(judged_as if name == "judged" and judged_as else text)
        if name == upto:
            break
    return f"WITH {','.join(parts)}\n{body}"


METRICS = """
  CAST(sum(trip_count) AS BIGINT) AS trip_count,
  CAST(coalesce(sum(total_revenue), 0) AS DOUBLE) AS total_revenue,
  CAST(sum(paid_fare_sum) AS DOUBLE) / nullif(CAST(sum(paid_trip_count) AS DOUBLE), 0) AS avg_fare,
  CAST(sum(distance_sum) AS DOUBLE) / nullif(CAST(sum(distance_trip_count) AS DOUBLE), 0) AS avg_trip_distance,
  CAST(sum(card_tip_sum) AS DOUBLE) / nullif(CAST(sum(card_fare_sum) AS DOUBLE), 0) AS card_tip_rate,
  CAST(sum(anomaly_trip_count) AS DOUBLE) / nullif(CAST(sum(trip_count) AS DOUBLE), 0) AS anomaly_share"""

MART_COLUMNS = """CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_location_id, trip_count, anomaly_trip_count,
  CAST(total_revenue AS DOUBLE) AS total_revenue, paid_trip_count, CAST(paid_fare_sum AS DOUBLE) AS paid_fare_sum,
  distance_trip_count, CAST(distance_sum AS DOUBLE) AS distance_sum, CAST(card_fare_sum AS DOUBLE) AS card_fare_sum,
  CAST(card_tip_sum AS DOUBLE) AS card_tip_sum, last_pickup_datetime, refreshed_at"""

# The feature grid over events, with the user as zone. History is looked up by joins on earlier days.
GRID = """
per_hour AS (
  SELECT u.zone_id, d.day + to_hours(CAST(t.hod AS BIGINT)) AS hour_start, d.day, CAST(t.hod AS INTEGER) AS hod,
    (SELECT count(*) FROM events e
     WHERE e.user_id = u.zone_id AND CAST(e.ts AS DATE) = d.day AND hour(e.ts) = t.hod) AS n
  FROM (SELECT DISTINCT CAST(user_id AS INTEGER) AS zone_id FROM events) u,
       (SELECT CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(30) r(i)) d,
       (SELECT i AS hod FROM range(24) r(i)) t
),
per_day AS (
  SELECT zone_id, day, CAST(sum(n) AS BIGINT) AS n FROM per_hour GROUP BY zone_id, day
)"""

FEATURES = (
    GRID
    + """,
day_history AS (
  SELECT a.zone_id, a.day,
    max(CASE WHEN a.day - b.day = 1 THEN b.n END) AS previous_day,
    CAST(sum(CASE WHEN a.day - b.day BETWEEN 1 AND 7 THEN b.n END) AS BIGINT) AS week_1,
    CAST(sum(CASE WHEN a.day - b.day BETWEEN 8 AND 14 THEN b.n END) AS BIGINT) AS week_2,
    count(b.day) AS days_known
  FROM per_day a LEFT JOIN per_day b ON a.zone_id = b.zone_id AND b.day < a.day AND b.day >= a.day - 14
  GROUP BY a.zone_id, a.day
),
hour_history AS (
  SELECT a.zone_id, a.hour_start,
    max(CASE WHEN a.day - b.day = 1 THEN b.n END) AS lag_1d,
    max(CASE WHEN a.day - b.day = 7 THEN b.n END) AS lag_7d,
    CASE WHEN count(b.day) = 7 THEN CAST(sum(b.n) AS DOUBLE) / 7 END AS mean_7d
  FROM per_hour a
  LEFT JOIN per_hour b ON a.zone_id = b.zone_id AND a.hod = b.hod AND b.day < a.day AND b.day >= a.day - 7
  GROUP BY a.zone_id, a.hour_start
),
features AS (
  SELECT g.zone_id, g.hour_start, g.day AS forecast_date, CAST(g.day AS TIMESTAMP) AS prediction_made_at,
    g.hod AS hour_of_day, CAST(dayofweek(g.day) + CASE WHEN dayofweek(g.day) = 0 THEN 7 ELSE 0 END AS INTEGER) AS day_of_week,
    dayofweek(g.day) IN (0, 6) AS is_weekend,
    g.day IN (DATE '2024-01-01', DATE '2024-01-15') AS is_public_holiday,
    hh.lag_1d AS trips_same_hour_lag_1d, hh.lag_7d AS trips_same_hour_lag_7d, hh.mean_7d AS trips_same_hour_mean_7d,
    dh.previous_day AS zone_trips_prev_day,
    CASE WHEN dh.days_known = 14 THEN CAST(dh.week_1 + 1 AS DOUBLE) / CAST(dh.week_2 + 1 AS DOUBLE) END
      AS zone_trips_trend_7d,
    dh.days_known = 14 AS history_complete,
    g.n AS target_trips,
    CASE WHEN g.day >= DATE '2024-01-26' THEN 'test' WHEN g.day >= DATE '2024-01-22' THEN 'validate'
         WHEN g.day >= DATE '2024-01-15' THEN 'train' ELSE 'warmup' END AS split
  FROM per_hour g
  JOIN hour_history hh USING (zone_id, hour_start)
  JOIN day_history dh ON dh.zone_id = g.zone_id AND dh.day = g.day
)"""
)

FEATURE_COLUMNS = """zone_id, hour_start, CAST(forecast_date AS VARCHAR) AS forecast_date, prediction_made_at, hour_of_day,
  day_of_week, is_weekend, is_public_holiday, trips_same_hour_lag_1d, trips_same_hour_lag_7d, trips_same_hour_mean_7d,
  zone_trips_prev_day, zone_trips_trend_7d, history_complete, target_trips, split"""


def with_grid(body: str) -> str:
    return f"WITH {GRID}\n{body}"


def with_features(body: str) -> str:
    return f"WITH {FEATURES}\n{body}"
