"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Writing a staged batch in two halves needs no sort when both files may be open at once.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # The JVM does not compile methods above 8,000 bytecodes; a fused stage that long runs faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "tripflow") -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    shuffle = os.cpu_count() if cpus == "*" else cpus
    return (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .getOrCreate()
    )


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster session without
    it is refused, because a machine-local folder would lose the table with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for intermediate tables")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tripflow-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# The scope of the running job; threads and tasks of a driver program each see their own.
_scope: ContextVar[list[str] | None] = ContextVar("staging scope", default=None)
_unscoped: dict[str, list[str]] = {}


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends; a job keeps none of its intermediates."""
    from tripflow.sources import files

    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in paths:
            files.remove(spark, path)


def release(spark: SparkSession) -> None:
    """Remove every table staged outside a scope; results that still read one are void then."""
    from tripflow.sources import files

    for path in _unscoped.pop(spark.sparkContext.applicationId, []):
        files.remove(spark, path)


#: Fixed value: Spark's setting by which a job's shuffle files go when the job ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs inside the block remove their shuffle files when they end, not when the driver next collects garbage.

    For writes and counts, whose plans nothing runs again: the files of a large job would lie beside
    its result, and beside those of all jobs after it.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage (a lost executor costs a re-read, not a re-run of the job before it) and
    later readers get column and partition pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    paths = _scope.get()
    if paths is None:
        paths = _unscoped.setdefault(spark.sparkContext.applicationId, [])
    paths.append(path)
    # Hex keys are most of a wide row's bytes; zstd halves them.
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(spark):
        writer.parquet(path)
    schema = df.schema
    names = [f.name for f in schema if f.name not in (partition_by or [])] + (partition_by or [])
    read_schema = type(schema)([schema[n] for n in names])
    return spark.read.schema(read_schema).parquet(path).select(*df.columns)
