"""Quality rules as column expressions: hard rules reject a trip, soft rules only flag it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.functions.calendar import month_bounds, ntz
from tripflow.functions.keys import key_digest
from tripflow.operators.dedup import DUPLICATE, first_rows, flag_repeats
from tripflow.sources.raw import POSITION

# The default code sets, the zone id range, and the limits of the rules.
DEFAULT_VENDORS = frozenset({1, 2, 6, 7})
DEFAULT_PAYMENT_TYPES = frozenset({0, 1, 2, 3, 4, 5, 6})
DEFAULT_RATE_CODES = frozenset({1, 2, 3, 4, 5, 6, 99})
LOCATION_RANGE = (1, 265)
LONGEST_TRIP = "INTERVAL 24 HOURS"
NULL_RATE_WARNING = 0.05
@dataclass(frozen=True)
class CheckContext:
    """Inputs of one run that rules need. An empty code set means the default one."""

    month: str | None = None
    vendors: Iterable[int] = field(default_factory=frozenset)
    payment_types: Iterable[int] = field(default_factory=frozenset)
    rate_codes: Iterable[int] = field(default_factory=frozenset)
    now: dt.datetime | None = None

    def __post_init__(self):
        object.__setattr__(self, "vendors", frozenset(self.vendors) or DEFAULT_VENDORS)
        object.__setattr__(self, "payment_types", frozenset(self.payment_types) or DEFAULT_PAYMENT_TYPES)
        object.__setattr__(self, "rate_codes", frozenset(self.rate_codes) or DEFAULT_RATE_CODES)
        object.__setattr__(self, "now", self.now or dt.datetime.now())


def codes_of(dimension: DataFrame, column: str) -> frozenset[int]:
    """The natural codes of a code dimension, a table that is edited by hand."""
    return frozenset(r[0] for r in dimension.select(column).distinct().collect())


def context_from_dims(
    vendor: DataFrame, payment: DataFrame, rate_code: DataFrame, month: str | None = None, now: dt.datetime | None = None
) -> CheckContext:
    """Valid codes come from the stored dimensions, so a code added there is accepted here."""
    return CheckContext(
        month,
        codes_of(vendor, "vendor_id"),
        codes_of(payment, "payment_type_id"),
        codes_of(rate_code, "rate_code_id"),
        now,
    )


@dataclass(frozen=True)
class Rule:
    code: str
    dimension: str
    test: Callable[[CheckContext], Column]

    def fails(self, ctx: CheckContext) -> Column:
        """Never NULL: a comparison with a missing value does not fail the rule."""
        return F.coalesce(self.test(ctx), F.lit(False))


def _pickup() -> Column:
    return F.col("tpep_pickup_datetime")


def _dropoff() -> Column:
    return F.col("tpep_dropoff_datetime")


def _outside_month(ctx: CheckContext) -> Column:
    if not ctx.month:
        return F.lit(False)
    start, end = month_bounds(ctx.month)
    return (_pickup() < ntz(start)) | (_pickup() >= ntz(end))


def _known(column: str, codes: frozenset[int]) -> Column:
    return F.col(column).isin(sorted(codes))


def _out_of_range(column: str) -> Column:
    return F.coalesce(~F.col(column).between(*LOCATION_RANGE), F.lit(False))


# The codes and quality dimensions, here and below. Order matters: a row lists its
# codes in it.
HARD_RULES = [
    Rule("missing_pickup_datetime", "completeness", lambda ctx: _pickup().isNull()),
    Rule("missing_dropoff_datetime", "completeness", lambda ctx: _dropoff().isNull()),
    Rule("missing_pickup_location", "completeness", lambda ctx: F.col("PULocationID").isNull()),
    Rule("missing_dropoff_location", "completeness", lambda ctx: F.col("DOLocationID").isNull()),
    Rule("dropoff_before_or_equal_pickup", "validity", lambda ctx: _dropoff() <= _pickup()),
    Rule("pickup_in_future", "validity", lambda ctx: _pickup() > ntz(ctx.now)),
    Rule("pickup_outside_file_month", "validity", _outside_month),
    # A missing vendor is not a known one, so it fails; missing payment and rate codes are allowed.
    Rule("unknown_vendor", "validity", lambda ctx: ~F.coalesce(_known("VendorID", ctx.vendors), F.lit(False))),
    Rule("unknown_payment_type", "validity", lambda ctx: ~_known("payment_type", ctx.payment_types)),
    Rule("unknown_rate_code", "validity", lambda ctx: ~_known("RatecodeID", ctx.rate_codes)),
    Rule(
        "location_id_out_of_range",
        "validity",
        lambda ctx: _out_of_range("PULocationID") | _out_of_range("DOLocationID"),
    ),
    Rule("duplicate_in_batch", "uniqueness", lambda ctx: F.col(DUPLICATE)),
]

SOFT_RULES = [
    Rule(
        "zero_or_missing_passenger_count",
        "validity",
        lambda ctx: F.coalesce(F.col("passenger_count"), F.lit(0.0)) <= 0,
    ),
    Rule("zero_or_negative_trip_distance", "validity", lambda ctx: F.col("trip_distance") <= 0),
    Rule("negative_fare_amount", "validity", lambda ctx: F.col("fare_amount") < 0),
    Rule("negative_total_amount", "validity", lambda ctx: F.col("total_amount") < 0),
    Rule("trip_over_24h", "validity", lambda ctx: _dropoff() - _pickup() > F.expr(LONGEST_TRIP)),
]
RULES = {rule.code: rule for rule in HARD_RULES + SOFT_RULES}
TIER = {rule.code: "hard" for rule in HARD_RULES} | {rule.code: "soft" for rule in SOFT_RULES}


# Hard rules that copies of one key need not share: they look at the place of a row or at fields outside the key.
NOT_BY_KEY = frozenset({"unknown_payment_type", "unknown_rate_code", "duplicate_in_batch"})


def reject_reasons(ctx: CheckContext) -> Column:
    """Codes of the failed hard rules in rule order, comma-joined; '' for a row that passes."""
    return F.concat_ws(",", *[F.when(rule.fails(ctx), F.lit(rule.code)) for rule in HARD_RULES])


def anomaly_mask(ctx: CheckContext) -> Column:
    return reduce(lambda a, b: a | b, [rule.fails(ctx) for rule in SOFT_RULES])


def judge(keyed: DataFrame, ctx: CheckContext, position: str = POSITION) -> DataFrame:
    """Add ``reason_codes`` and ``is_anomaly`` to keyed raw rows.

    Repeats are flagged over all rows, including those another rule rejects. All other rules are
    one projection over the scan.
    """
    flagged = flag_repeats(keyed, "trip_id", position, key_digest())
    return flagged.withColumn("reason_codes", reject_reasons(ctx)).withColumn("is_anomaly", anomaly_mask(ctx))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason_codes") == "")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason_codes") != "")


def rule_dimensions(spark) -> DataFrame:
    """code, tier and quality dimension of every rule: 17 rows."""
    rows = [(rule.code, TIER[rule.code], rule.dimension) for rule in RULES.values()]
    return spark.createDataFrame(rows, "code string, tier string, dimension string").coalesce(1)


def count_reasons(judged: DataFrame) -> DataFrame:
    """Rows per reason code; a row with several codes counts for each of them."""
    return (
        rejected(judged)
        .select(F.explode(F.split("reason_codes", ",")).alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def reason_histogram(judged: DataFrame) -> DataFrame:
    """Rows per full reason text."""
    return rejected(judged).groupBy("reason_codes").agg(F.count(F.lit(1)).alias("rows"))


def soft_counts(df: DataFrame, ctx: CheckContext | None = None) -> DataFrame:
    """Rows per soft rule, from one aggregation; a rule without hits reports 0."""
    ctx = ctx or CheckContext()
    codes = [rule.code for rule in SOFT_RULES]
    counts = df.agg(*[F.count_if(rule.fails(ctx)).alias(rule.code) for rule in SOFT_RULES])
    return counts.unpivot([], codes, "code", "rows")


def rejected_log(judged: DataFrame) -> DataFrame:
    return rejected(judged).select("trip_id", F.col("reason_codes").alias("reason"))


def quarantine_rows(rejected_rows: DataFrame, source_file: str, month: str, at: dt.datetime) -> DataFrame:
    """Raw columns, key, reasons and provenance of all rejected rows of a batch; of several copies of a trip_id the first is kept.

    A row that fails a rule over key fields shares that with all copies of its key, so all are rejected
    and the first is the one that is no duplicate: a filter. Only keys that fail no such rule, whose first
    copy may have been accepted, are looked for.
    """
    rows = rejected_rows.select(*schemas.RAW_COLUMNS, "trip_id", "reason_codes", POSITION)
    others = [rule.code for rule in HARD_RULES if rule.code in NOT_BY_KEY]
    texts = [",".join(codes) for n in range(1, len(others) + 1) for codes in combinations(others, n)]
    not_by_key, repeat = F.col("reason_codes").isin(texts), F.find_in_set(F.lit("duplicate_in_batch"), F.col("reason_codes")) > 0
    kept = rows.filter(~not_by_key & ~repeat).unionByName(first_rows(rows.filter(not_by_key), "trip_id"))
    return kept.select(
        *schemas.RAW_COLUMNS,
        "trip_id",
        "reason_codes",
        F.lit(source_file).alias("source_file"),
        F.lit(month).alias("ingest_month"),
        ntz(at).alias("quarantined_at"),
    )
