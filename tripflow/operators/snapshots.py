"""Write-once feature snapshots with a content fingerprint."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import features as ft
from tripflow.session import stage
from tripflow.sources import files

FEATURE_TABLE = "features_zone_hour"
DAY = "forecast_date"
MANIFEST = T.StructType(
    [
        T.StructField(name, dtype, True)
        for name, dtype in (
            ("version", T.StringType()),
            ("table", T.StringType()),
            ("fingerprint", T.StringType()),
            ("rows", T.LongType()),
            ("rows_per_split", T.MapType(T.StringType(), T.LongType())),
            ("zones", T.LongType()),
            ("key_columns", T.ArrayType(T.StringType())),
            ("feature_columns", T.ArrayType(T.StringType())),
            ("target_column", T.StringType()),
            ("split_column", T.StringType()),
            ("config", T.StringType()),
            ("fact_trip_rows", T.LongType()),
            (
                "successful_pipeline_runs",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("run_id", T.LongType()),
                            T.StructField("month", T.StringType()),
                            T.StructField("finished_at", T.StringType()),
                        ]
                    )
                ),
            ),
            ("leakage_check_days", T.ArrayType(T.StringType())),
            ("created_at", T.StringType()),
        )
    ]
)


class SnapshotExistsError(FileExistsError):
    """The version exists with other contents; snapshots are immutable."""


class SnapshotModifiedError(ValueError):
    """The stored rows do not match the manifest."""


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, and two order-independent digests over all columns.

    A multi-file Parquet table has no stable bytes, so its content is digested instead. Two
    combinations of differently seeded hashes are kept, so rows that cancel in one show in the other.
    """
    return df.agg(*_digests_of_rows(df))


def _digests_of_rows(df: DataFrame) -> list[Column]:
    columns = sorted(df.columns)
    row = F.xxhash64(*columns)
    salted = F.xxhash64(F.lit("tripflow"), *columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor_digest"),
        F.coalesce(F.sum(salted.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("sum_digest"),
    ]


def day_fingerprints(df: DataFrame) -> DataFrame:
    """The fingerprint of every day of a feature table: forecast_date and the digests."""
    return df.groupBy(DAY).agg(*_digests_of_rows(df))


def folded(days: DataFrame) -> DataFrame:
    """The fingerprint of a whole table from those of its days; both digests combine in any order."""
    return days.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.bit_xor("xor_digest"), F.lit(0)).alias("xor_digest"),
        F.coalesce(F.sum("sum_digest"), F.lit(0)).cast("decimal(38,0)").alias("sum_digest"),
    )


def _text(digests: DataFrame) -> str:
    r = digests.first()
    return f"{r['rows']}:{r['xor_digest']}:{r['sum_digest']}"


def fingerprint_text(df: DataFrame) -> str:
    return _text(fingerprint(df))


def _data(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{version}/{FEATURE_TABLE}"


def _manifest(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{version}/manifest"


def _days(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{version}/day_fingerprints"


def read_manifest(spark: SparkSession, root: str, version: str) -> dict:
    return spark.read.schema(MANIFEST).json(_manifest(root, version)).first().asDict(recursive=True)


def snapshot_versions(spark: SparkSession, root: str) -> list[str]:
    """Versions whose manifest was committed, in order."""
    names = [n for n in files.child_names(spark, root) if n.startswith("v")]
    return [n for n in names if files.is_complete(spark, _manifest(root, n))]


def latest_version(spark: SparkSession, root: str) -> str:
    versions = snapshot_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"No feature snapshot under {root}")
    return versions[-1]


def export_features(features: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Ordered Parquet export."""
    ft.in_presentation_order(features).write.mode(mode).parquet(path)


def write_snapshot(
    features: DataFrame,
    root: str,
    version: str,
    config: ft.FeatureConfig,
    leakage_days: list[dt.date] | None = None,
    fact_rows: int | None = None,
    runs: list[dict] | None = None,
    created_at: dt.datetime | None = None,
) -> dict:
    """Write data, then manifest. The same content again is a no-op; other content is refused.

    A version is complete once its manifest is: data without one is the remains of a failed write
    and is replaced.
    """
    spark = features.sparkSession
    if files.is_complete(spark, _manifest(root, version)):
        stored = read_manifest(spark, root, version)
        if fingerprint_text(features) != stored["fingerprint"]:
            raise SnapshotExistsError(
                f"version {version} holds other features; what was published is immutable, so publish the new ones as another version"
            )
        return stored

    export_features(features, _data(root, version), mode="overwrite")
    written = spark.read.parquet(_data(root, version))
    # One row per day.
    day_fingerprints(written).coalesce(1).write.mode("overwrite").parquet(_days(root, version))
    # One row per split.
    splits = ft.split_overview(written).orderBy("first_day").collect()
    manifest = {
        "version": version,
        "table": FEATURE_TABLE,
        "fingerprint": _text(folded(spark.read.parquet(_days(root, version)))),
        "rows": sum(r["rows"] for r in splits),
        "rows_per_split": {r["split"]: r["rows"] for r in splits},
        "zones": written.agg(F.count_distinct("zone_id")).first()[0],
        "key_columns": ft.KEY_COLUMNS,
        "feature_columns": ft.FEATURE_COLUMNS,
        "target_column": ft.TARGET_COLUMN,
        "split_column": ft.SPLIT_COLUMN,
        "config": json.dumps(config.as_dict(), default=str),
        "fact_trip_rows": fact_rows,
        "successful_pipeline_runs": runs or [],
        "leakage_check_days": [str(d) for d in leakage_days or []],
        "created_at": (created_at or dt.datetime.now()).isoformat(timespec="seconds"),
    }
    one_row = spark.createDataFrame([manifest], MANIFEST).coalesce(1)
    one_row.write.mode("overwrite").json(_manifest(root, version))
    files.mark_complete(spark, _manifest(root, version))
    return manifest


def verify_snapshot(spark: SparkSession, root: str, version: str | None = None) -> tuple[DataFrame, dict]:
    """The stored table and its manifest, after recomputing the fingerprint."""
    version = version or latest_version(spark, root)
    manifest = read_manifest(spark, root, version)
    table = spark.read.parquet(_data(root, version))
    days = stage(day_fingerprints(table), "day-fingerprints")
    if _text(folded(days)) != manifest["fingerprint"]:
        raise SnapshotModifiedError(
            f"the features stored in {root}/{version} are not those its manifest fingerprinted{_named(spark, root, version, days, manifest)}"
        )
    return table, manifest


def _named(spark: SparkSession, root: str, version: str, days: DataFrame, manifest: dict) -> str:
    """The days that differ, for a message; nothing where the days' own record is missing or altered too."""
    if not files.exists(spark, _days(root, version)):
        return ""
    recorded = spark.read.parquet(_days(root, version))
    if _text(folded(recorded)) != manifest["fingerprint"]:
        return ", and neither is the record of its days"
    # One row per day that differs; a few are named.
    found = [str(r[DAY]) for r in _compared(recorded, days).where("changed").orderBy(DAY).limit(10).collect()]
    return f"; days that differ: {', '.join(found)}"


def _compared(recorded: DataFrame, found: DataFrame) -> DataFrame:
    digests = F.struct("rows", "xor_digest", "sum_digest")
    left = recorded.select(DAY, digests.alias("recorded"))
    right = found.select(F.col(DAY).alias("_day"), digests.alias("found"))
    both = left.join(right, F.col(DAY).eqNullSafe(F.col("_day")), "full")
    return both.select(
        F.coalesce(DAY, "_day").alias(DAY),
        F.coalesce("recorded.rows", F.lit(0)).cast("long").alias("rows_recorded"),
        F.coalesce("found.rows", F.lit(0)).cast("long").alias("rows_found"),
        (~F.col("recorded").eqNullSafe(F.col("found"))).alias("changed"),
    )


def compare_days(spark: SparkSession, root: str, version: str | None = None, days: list[dt.date] | None = None) -> DataFrame:
    """Per day of a snapshot: rows recorded and found, and whether the stored rows changed since.

    With ``days`` only those are read again, by a filter the scan can use.
    """
    version = version or latest_version(spark, root)
    recorded, table = spark.read.parquet(_days(root, version)), spark.read.parquet(_data(root, version))
    if days is not None:
        recorded, table = (t.where(F.col(DAY).isin(days)) for t in (recorded, table))
    return _compared(recorded, day_fingerprints(table))
