"""Registration, and the intermediate tables queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schemas
from tripflow.functions.keys import add_trip_id
from tripflow.operators import features, mart, rules, star
from tripflow.session import scratch_path, stage
from tripflow.sources import sample
from tripflow.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    """Register a function of a ``Sample`` under ``name`` with its oracle SQL."""

    def register(build: Callable[[Sample], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Sample.of(spark, folder)))

        REGISTRY[name] = Query(name, run, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so both engines return the same plain types."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


class Sample:
    """The sample tables of one folder, and tables derived from them, each staged at most once per session."""

    _open: dict[tuple[str, str], Sample] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.context = rules.CheckContext(now=sample.SAMPLE_NOW)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Sample:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def new_warehouse(self) -> Warehouse:
        wh = Warehouse(self.spark, self.scratch("warehouse"))
        wh.ensure_seeds()
        return wh

    # -- order lines as trips ---------------------------------------------------------------------

    @cached_property
    def trips(self) -> DataFrame:
        return sample.line_trips(self.spark, self.folder)

    @property
    def raw(self) -> DataFrame:
        return self.trips.select(*schemas.RAW_COLUMNS)

    @cached_property
    def stored_trips(self) -> DataFrame:
        """The trips as a table: what looks at them several times joins order lines to orders only once."""
        return stage(self.trips, "trips")

    @cached_property
    def _judging(self) -> DataFrame:
        return rules.judge(add_trip_id(self.stored_trips), self.context)

    @cached_property
    def judged(self) -> DataFrame:
        return stage(self._judging, "judged")

    @property
    def good(self) -> DataFrame:
        return rules.accepted(self.judged)

    @cached_property
    def vendor(self) -> DataFrame:
        return schemas.vendor_seed(self.spark)

    @cached_property
    def payment(self) -> DataFrame:
        return schemas.payment_seed(self.spark)

    @cached_property
    def rate_code(self) -> DataFrame:
        return schemas.rate_code_seed(self.spark)

    @cached_property
    def fact(self) -> DataFrame:
        # Read once: judged on the way, unless the judged table is there already.
        good = rules.accepted(self.__dict__.get("judged", self._judging))
        return stage(star.fact_rows(good, self.vendor, self.payment, self.rate_code), "fact")

    @property
    def unjudged_fact(self) -> DataFrame:
        """Every trip in fact shape, also those the rules reject: NULL and unknown keys included."""
        return star.fact_rows(self.judged, self.vendor, self.payment, self.rate_code)

    @property
    def dim_date(self) -> DataFrame:
        return star.date_rows(self._dimension_values)

    @property
    def dim_location(self) -> DataFrame:
        return star.location_rows(self._dimension_values)

    @property
    def _dimension_values(self) -> DataFrame:
        """Pickups and zones of the accepted trips; the fact, where it is stored, has the same ones."""
        if "fact" not in self.__dict__:
            return self.good
        names = {"pickup_datetime": "tpep_pickup_datetime", "pickup_location_key": "PULocationID", "dropoff_location_key": "DOLocationID"}
        return self.fact.withColumnsRenamed(names)

    @cached_property
    def mart(self) -> DataFrame:
        return stage(self.build_mart(self.fact), "mart")

    def build_mart(self, fact: DataFrame) -> DataFrame:
        return mart.build_mart(fact, self.dim_date, self.dim_location, self.payment, sample.SAMPLE_NOW)

    @cached_property
    def loaded(self) -> tuple[Warehouse, dict]:
        """A warehouse after ingesting all trips as the file of one month, and the run's summary."""
        from tripflow.plans.ingest import ingest_month

        raw_dir, root = self.scratch("raw"), self.scratch("warehouse")
        self.raw.write.parquet(f"{raw_dir}/yellow_tripdata_{sample.SAMPLE_MONTH}.parquet")
        summary = ingest_month(self.spark, sample.SAMPLE_MONTH, raw_dir, root, now=sample.SAMPLE_NOW)
        return Warehouse(self.spark, root), summary

    # -- events as pickups ------------------------------------------------------------------------

    @property
    def pickups(self) -> DataFrame:
        return sample.event_trips(self.spark, self.folder)

    @property
    def zones(self) -> DataFrame:
        return sample.event_zones(self.spark, self.folder)

    @property
    def grid(self) -> DataFrame:
        config = sample.EVENT_CONFIG
        return features.demand_grid(self.pickups, self.zones, config.grid_start, config.grid_end)

    @cached_property
    def features(self) -> DataFrame:
        return stage(features.build_features(self.pickups, self.zones, sample.EVENT_CONFIG), "features")
