"""Equality of two tables as counted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_differences(left: DataFrame, right: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of each side and rows in only one of them, by the values of ``by`` or in all.

    Rows are compared over all columns of ``left`` as counted values, NULL equal to NULL: a row on
    both sides cancels out, whatever the order. Columns that differ by name are an error.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted({*left.columns} ^ {*right.columns})}")
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    rows = sides.groupBy(*left.columns).agg(
        F.sum("_side").alias("_balance"),
        F.count_if(F.col("_side") == 1).alias("_left"),
        F.count_if(F.col("_side") == -1).alias("_right"),
    )
    return rows.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("rows_left"),
        F.coalesce(F.sum("_right"), F.lit(0)).alias("rows_right"),
        F.coalesce(F.sum(F.abs("_balance")), F.lit(0)).cast("long").alias("only_in_one"),
    )


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    return frame_differences(left, right).first()["only_in_one"] == 0
