"""Where the tables live, and the two ways of writing them: append what is absent, or publish anew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schemas
from tripflow.functions.keys import packed, unpacked
from tripflow.session import shuffles_dropped, stage
from tripflow.sources import files, keyfilter

SEEDED = {
    "dim_vendor": schemas.vendor_seed,
    "dim_payment": schemas.payment_seed,
    "dim_rate_code": schemas.rate_code_seed,
}
TABLES = {
    "dim_date": schemas.DIM_DATE,
    "dim_location": schemas.DIM_LOCATION,
    "dim_vendor": schemas.DIM_VENDOR,
    "dim_payment": schemas.DIM_PAYMENT,
    "dim_rate_code": schemas.DIM_RATE_CODE,
    "fact_trip": schemas.FACT,
    "quarantine_trip": schemas.QUARANTINE,
    "pipeline_run": schemas.LEDGER,
}
MART_TABLE = "mart_daily_zone_trips"
# A key set up to this many rows (well under 100 MB of hex keys) may be broadcast.
BROADCAST_KEYS = 500_000
KEY_RANGES = "trip_key_range"
# Fixed value: the folder name Spark gives to a missing partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PICKUP_MONTH = "pickup_month"
_MONOTONIC_BITS = 33


class ReferentialIntegrityError(ValueError):
    """A fact batch carries a dimension key that no dimension row has."""


class Warehouse:
    """Parquet tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        if table == MART_TABLE:
            return self.mart_version() is not None
        return files.exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        """The table, or an empty frame of its schema before the first write."""
        if table == MART_TABLE:
            return self.read_mart()
        if not self.exists(table):
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(self.path(table)).select(*TABLES[table].fieldNames())

    def parts(self, table: str, column: str, values: list[str | None]) -> list[str]:
        """The partition folders of ``values`` that exist."""
        folders = [f"{self.path(table)}/{column}={NO_VALUE if v is None else v}" for v in values]
        return [f for f in folders if files.exists(self.spark, f)]

    def read_parts(self, table: str, column: str, values: list[str | None]) -> DataFrame:
        """The rows in the partition folders of ``values``; no other folder is listed."""
        there = self.parts(table, column, values)
        if not there:
            return self.spark.createDataFrame([], TABLES[table])
        scan = self.spark.read.schema(TABLES[table]).option("basePath", self.path(table))
        return scan.parquet(*there).select(*TABLES[table].fieldNames())

    def append(self, table: str, rows: DataFrame, partition_by: str | None = None) -> int:
        """Append and return the rows written, as the write itself counts them."""
        names = TABLES[table].fieldNames()
        extra = [partition_by] if partition_by and partition_by not in names else []
        written = Observation()
        writer = rows.select(*names, *extra).observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if table == "fact_trip":
            writer = writer.option(keyfilter.PARQUET_BLOOM, True)
        if table == "quarantine_trip":
            # Written once and seldom read: hex keys are most of its bytes, and zstd halves them.
            writer = writer.option("compression", "zstd")
        with shuffles_dropped(self.spark):
            writer.parquet(self.path(table))
        return written.get.get("rows", 0)

    def ensure_seeds(self) -> None:
        """Create the three code dimensions once; a loaded warehouse keeps its own rows."""
        for table, seed in SEEDED.items():
            if not self.exists(table):
                self.append(table, seed(self.spark))

    # -- mart: a full replacement that readers never see half done --------------------------------

    def _mart_versions(self) -> list[str]:
        names = files.child_names(self.spark, self.path(MART_TABLE))
        return [n for n in names if n.startswith("version=") and files.is_complete(self.spark, f"{self.path(MART_TABLE)}/{n}")]

    def mart_version(self) -> str | None:
        versions = self._mart_versions()
        return versions[-1] if versions else None

    def read_mart(self) -> DataFrame:
        version = self.mart_version()
        if version is None:
            return self.spark.createDataFrame([], schemas.MART)
        return self.spark.read.schema(schemas.MART).parquet(f"{self.path(MART_TABLE)}/{version}")

    def publish_mart(self, rows: DataFrame) -> int:
        """Write the next version beside the current one; it becomes current when it is marked complete.

        The version before it stays for readers that opened it; older ones are removed.
        """
        old = self._mart_versions()
        number = int(old[-1].split("=")[1]) + 1 if old else 1
        path = f"{self.path(MART_TABLE)}/version={number:09d}"
        with shuffles_dropped(self.spark):
            rows.select(*schemas.MART.fieldNames()).write.mode("overwrite").parquet(path)
        files.mark_complete(self.spark, path)
        for name in old[:-1]:
            files.remove(self.spark, f"{self.path(MART_TABLE)}/{name}")
        return self.read_mart().count()


def absent_rows(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table does not hold yet: the anti join behind every insert."""
    return rows.join(existing.select(key), key, "left_anti")


def absent_rows_staged(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """``absent_rows`` for a wide batch: only keys are shuffled unless many of them overlap.

    First the keys both sides hold are found from two one-column scans. A first load has none (the
    batch goes through untouched), a small overlap is broadcast after its size is known, and only a
    large overlap pays for a shuffle of the wide rows.
    """
    found = _absent(rows, existing, key)
    return rows.filter(F.lit(False)) if found is None else found


def _absent(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame | None:
    """The rows to add; None where nothing is new, so that a replay writes nothing at all.

    Keys are compared as bytes and counted first; those that both sides hold are stored only if they
    are few enough to be broadcast.
    """
    new, known = rows.select(packed(key).alias("_key")), existing.select(packed(key).alias("_key"))
    shared = new.join(known, "_key", "left_semi")
    with shuffles_dropped(rows.sparkSession):
        overlap = shared.count()
    if overlap == 0:
        return rows
    if overlap == rows.count():
        return None
    if overlap <= BROADCAST_KEYS:
        found = stage(shared.select(unpacked("_key").alias(key)), "shared-keys")
        return rows.join(F.broadcast(found), key, "left_anti")
    narrow = rows.withColumn("_key", packed(key)).drop(key).join(known, "_key", "left_anti")
    return narrow.withColumn(key, unpacked("_key")).select(*rows.columns)


def one_per_key(rows: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """The first row of every key by ``position``. Costs a count of eight-byte digests when no key repeats.

    Which of several copies is first cannot be told without a position (by default the scan's own, if
    the rows carry it), so repeats without one are refused.
    """
    from tripflow.operators.dedup import first_rows, suspect_digests
    from tripflow.sources.raw import POSITION

    position = position or POSITION
    if position in rows.columns:
        return first_rows(rows, key, position).drop(position)
    digest = F.xxhash64(key)
    suspects, found = suspect_digests(rows, digest)
    if found == 0:
        return rows
    may = rows.select(key, digest.alias("_digest")).join(suspects.select("_digest"), "_digest", "left_semi")
    if may.groupBy(key).count().filter("count > 1").isEmpty():
        return rows
    raise ValueError(f"{key} repeats within the rows and no column {position} says which row is first")


def insert_dimension(wh: Warehouse, table: str, rows: DataFrame, key: str, position: str | None = None) -> None:
    """First write wins: rows with a known key are ignored, never updated; of new rows the first of a key is kept."""
    wh.append(table, absent_rows(one_per_key(rows, key, position), wh.read(table), key))


def insert_quarantine(wh: Warehouse, rows: DataFrame, unique: bool = False) -> int:
    """Insert-if-absent on trip_id; returns the rows added.

    trip_id covers the pickup time, so an equal trip_id has an equal pickup or none: the table is
    kept by pickup month, rows without a pickup apart, and only the months of the batch are read.
    ``unique`` says that no trip_id repeats within the rows.
    """
    from tripflow.functions.calendar import month_text

    rows = rows if unique else one_per_key(rows, "trip_id")
    rows = rows.withColumn(PICKUP_MONTH, month_text(F.col("tpep_pickup_datetime")))
    if wh.exists("quarantine_trip"):
        # Read again for the keys and for the rows that are new, rather than stored a second time: a batch may be
        # rejected as a whole, and its rows are filtered from a stored table.
        # One value per calendar month of the batch.
        months = [r[0] for r in rows.select(PICKUP_MONTH).distinct().collect()]
        if wh.parts("quarantine_trip", PICKUP_MONTH, months):
            rows = _absent(rows, wh.read_parts("quarantine_trip", PICKUP_MONTH, months), "trip_id")
            if rows is None:
                return 0
    return wh.append("quarantine_trip", rows, partition_by=PICKUP_MONTH)


def _fact_keys() -> dict[str, tuple[str, str]]:
    """Fact column -> (dimension table, its key), by name: a fact key ends with the key of its dimension."""
    dims = {schema.fieldNames()[0]: table for table, schema in TABLES.items() if table.startswith("dim_")}
    return {
        name: (table, key)
        for name in schemas.FACT.fieldNames()
        for key, table in dims.items()
        if name == key or name.endswith(f"_{key}")
    }


FACT_KEYS = _fact_keys()


def orphan_counts(batch: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows per fact key column whose key has no dimension row; NULL keys are allowed.

    One pass: the six keys of a row become six (column, key) pairs, pairs are counted (combined
    before the shuffle, so a hot zone stays small) and only the distinct pairs meet the dimensions.
    """
    pairs = ", ".join(f"'{c}', cast({c} as bigint)" for c in FACT_KEYS)
    used = (
        batch.select(F.expr(f"stack({len(FACT_KEYS)}, {pairs}) as (column_name, key_value)"))
        .filter("key_value is not null")
        .groupBy("column_name", "key_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dims[table].select(F.lit(column).alias("column_name"), F.col(key).cast("long").alias("key_value"))
            for column, (table, key) in FACT_KEYS.items()
        ],
    )
    return (
        used.join(known, ["column_name", "key_value"], "left_anti")
        .groupBy("column_name")
        .agg(F.sum("n").cast("long").alias("orphan_rows"))
    )


def check_fact_keys(batch: DataFrame, dims: dict[str, DataFrame]) -> None:
    """Refuse the whole batch before anything is written if any key is unknown."""
    # At most one row per key column.
    orphans = {r["column_name"]: r["orphan_rows"] for r in orphan_counts(batch, dims).collect()}
    if orphans:
        raise ReferentialIntegrityError(f"nothing was loaded, rows per column whose key is in no dimension: {orphans}")


def with_surrogate_keys(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """``rows``, written, with trip_key: consecutive numbers above every number given out before.

    The rows of each task are counted first, so a task's numbers begin where those of the tasks
    before it end, however many rows or tasks there are. Rows that lie in a stored table already are
    numbered without this write, see ``numbered_by_place``.
    """
    mono = F.monotonically_increasing_id()
    row = mono.bitwiseAND(F.lit((1 << _MONOTONIC_BITS) - 1).cast("long"))
    placed = stage(rows.select("*", F.spark_partition_id().alias("_task"), row.alias("_row")), "fact-batch")
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))  # one row for each task
    return _numbered(wh, placed, sizes, "_task", F.col("_row")).drop("_task", "_row")


def numbered_by_place(wh: Warehouse, rows: DataFrame, stored: DataFrame, place: str) -> DataFrame:
    """``rows`` with trip_key from their place (file, row) in the ``stored`` table they were made of.

    A file's numbers begin where those of the files before it end. The scan gives the places and the
    files' sizes, so nothing is written, shuffled or counted for a number; rows of the table that are
    not among ``rows`` leave gaps.
    """
    file = F.col(f"{place}.file")
    sizes = stored.groupBy(file.alias("_file")).agg((F.max(f"{place}.row") + 1).alias("_n"))  # one row for each file
    return _numbered(wh, rows.withColumn("_file", file), sizes, "_file", F.col(f"{place}.row")).drop("_file", place)


def _numbered(wh: Warehouse, rows: DataFrame, sizes: DataFrame, part: str, row: Column) -> DataFrame:
    """trip_key = the next free number + the sizes of the parts before the row's own + ``row`` within it.

    The range is recorded before any row is loaded: a load that dies leaves a gap, never a number that
    is given twice.
    """
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(sizes.select(part, "_n", F.coalesce(before, F.lit(0)).alias("_before")), "key-offsets")
    base, n = next_base(wh), offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if n:
        taken = wh.spark.createDataFrame([(base + n - 1,)], "last_key long").coalesce(1)
        taken.write.mode("append").parquet(wh.path(KEY_RANGES))
    key = F.lit(base).cast("long") + F.col("_before") + row
    # As many offsets as the load had tasks, or the stored table files.
    return rows.join(F.broadcast(offsets.drop("_n")), part).withColumn("trip_key", key).drop("_before")


def next_base(wh: Warehouse) -> int:
    """The first trip_key that no load was given."""
    if files.exists(wh.spark, wh.path(KEY_RANGES)):
        top = wh.spark.read.schema("last_key long").parquet(wh.path(KEY_RANGES)).agg(F.max("last_key")).first()[0]
    else:
        top = wh.read("fact_trip").agg(F.max("trip_key")).first()[0]
    return 1 if top is None else top + 1


def insert_fact(
    wh: Warehouse,
    batch: DataFrame,
    check: bool = True,
    unique: bool = False,
    stored: DataFrame | None = None,
    months: list[str] | None = None,
    expected: int | None = None,
) -> int:
    """Insert-if-absent on trip_id; returns the rows added.

    trip_id covers the pickup time, so an equal trip_id lies in the same month: only the months of
    the batch are listed and read. The first version of a trip wins; a re-delivered one is skipped.
    ``unique`` says that no trip_id repeats within the batch, as after the rules. ``stored`` is the
    stored table the batch was made of, row by row; both carry the rows' places in it, which then
    number them. ``months`` are the batch's months and ``expected`` is about its number of rows, where
    they are known.
    """
    from tripflow.functions.calendar import month_text
    from tripflow.sources.raw import POSITION

    if check:
        check_fact_keys(batch, {t: wh.read(t) for t in TABLES if t.startswith("dim_")})
    if not unique:
        batch, stored = one_per_key(batch, "trip_id"), None
    batch = batch.withColumn("trip_month", month_text(F.col("pickup_datetime")))
    if months is None:
        # One value per calendar month of the batch.
        months = [r[0] for r in batch.select("trip_month").distinct().collect()]
    if not months:
        return 0
    fresh, filtered = _unknown_trips(wh, batch, months)
    if fresh is None:
        return 0
    if filtered:
        # Before the rows: see there.
        keyfilter.add(wh, fresh, months, fresh.count() if expected is None else expected)
    if stored is None:
        keyed = with_surrogate_keys(wh, fresh.drop(POSITION))
    else:
        keyed = numbered_by_place(wh, fresh, stored, POSITION)
    # Zone order inside each file lets row-group statistics skip by zone.
    order = ["trip_month", "pickup_location_key"]
    if len(months) > 1:
        # A batch of many months: one task per month's share instead of every task writing every month.
        dealt = keyed.withColumn("trip_id", packed("trip_id")).hint("rebalance", "trip_month")
        ordered = dealt.sortWithinPartitions(*order).withColumn("trip_id", unpacked("trip_id"))
    else:
        ordered = keyed.sortWithinPartitions(*order)
    return wh.append("fact_trip", ordered, partition_by="trip_month")


def _unknown_trips(wh: Warehouse, batch: DataFrame, months: list[str]) -> tuple[DataFrame | None, bool]:
    """The rows of ``batch`` (with trip_month) that the fact lacks, None if there are none; whether its months have key filters.

    A month without rows is not looked at. Otherwise the months' key filters are asked first. A load
    of new trips is done then, without reading a key of the fact; keys that may be known are looked
    for, as long as they are few. A batch that is mostly known, as a replay, is compared key by key.
    """
    if not wh.parts("fact_trip", "trip_month", months):
        return batch, True
    existing = wh.read_parts("fact_trip", "trip_month", months)
    if not keyfilter.covers(wh, months):
        return _absent(batch, existing, "trip_id"), False
    maybe = stage(keyfilter.maybe_known(wh, batch, months), "maybe-known")
    count = maybe.count()
    if count == 0:
        return batch, True
    if count > BROADCAST_KEYS or count * 2 > batch.count():
        return _absent(batch, existing, "trip_id"), True
    suspects = batch.select("trip_id", keyfilter.digest().alias("digest")).join(F.broadcast(maybe), "digest", "left_semi")
    suspects = stage(suspects.select("trip_id"), "suspects")
    known = stage(keyfilter.stored_among(suspects, existing, count), "known-trips")
    return (batch if known.isEmpty() else batch.join(F.broadcast(known), "trip_id", "left_anti")), True


def schema_of(table: str) -> T.StructType:
    return TABLES[table]
