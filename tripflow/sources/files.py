"""File-system calls on the driver: existence, listing and removal. Metadata only, never data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


#: Written last beside the files of a publication; readers of the folder skip names with an underscore.
COMMITTED = "_COMMITTED"


def mark_complete(spark: SparkSession, path: str) -> None:
    """Declare what was written below ``path`` published."""
    fs, jvm_path = _hadoop_path(spark, f"{path}/{COMMITTED}")
    fs.create(jvm_path, True).close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` was declared published; it does not matter which markers Spark's own jobs leave."""
    return exists(spark, f"{path}/{COMMITTED}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, jvm_path = _hadoop_path(spark, path)
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))


def remove(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)
