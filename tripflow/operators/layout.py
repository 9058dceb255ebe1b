"""Physical layout of the fact: a folder for each day (or longer unit), and rows along a curve over zone and vendor."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.keys import packed, unpacked
from tripflow.session import shuffles_dropped

FOLDER = "pickup_from"
#: Bits of a zone and of a vendor key on the curve; higher bits of larger keys are cut off and cost order, not rows.
ZONE_BITS, VENDOR_BITS = 9, 3
BLOCK_ROWS = 1 << 20
#: Rows that a task orders along the curve, about; more would be spilled.
RANGE_ROWS = 1 << 20


def bit_order() -> list[tuple[str, int]]:
    """The bits of both keys from the curve's highest to its lowest: in turn, each key's own highest first."""
    turns = [[(name, bits - 1 - i)] for i in range(max(ZONE_BITS, VENDOR_BITS)) for name, bits in (("zone", ZONE_BITS), ("vendor", VENDOR_BITS)) if i < bits]
    return [bit for turn in turns for bit in turn]


def curve(zone: Column, vendor: Column) -> Column:
    """The place of (zone, vendor) on a Z-order curve. A missing key counts as 0.

    Neighbours on the curve agree in the high bits of both, so a block of rows covers a part of the
    zones and of the vendors, and statistics of either column let a reader skip it.
    """
    values = {"zone": F.coalesce(zone.cast("long"), F.lit(0)), "vendor": F.coalesce(vendor.cast("long"), F.lit(0))}
    place = F.lit(0).cast("long")
    for name, i in bit_order():
        place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(values[name], i).bitwiseAND(F.lit(1)))
    return place


def with_folder(fact: DataFrame, unit: str = "day") -> DataFrame:
    """The fact with the first day of each pickup's ``unit``, which names its folder."""
    return fact.withColumn(FOLDER, F.date_trunc(unit, "pickup_datetime").cast("date"))


def write_in_blocks(placed: DataFrame, path: str, block_rows: int) -> None:
    """Write rows in their folders and in row groups of ``block_rows`` rows, in the order in which they come."""
    writer = placed.write.option("parquet.block.row.count.limit", block_rows).option("compression", "zstd")
    # Keys differ from row to row: a dictionary of a block's keys would only add their numbers.
    writer = writer.option("parquet.enable.dictionary#trip_id", False)
    with shuffles_dropped(placed.sparkSession):
        writer.partitionBy(FOLDER).parquet(path)


def write_clustered(fact: DataFrame, path: str, block_rows: int = BLOCK_ROWS, tasks: int | None = None, unit: str = "day") -> None:
    """Write the fact with a folder for each ``unit`` of pickup time and its rows along the curve.

    Ranges of (folder, curve) are dealt to tasks by a sample of the rows, so a busy day is split over
    tasks and quiet days share one. ``tasks`` is how many to aim for; a large fact has more, so that
    none sorts much more than ``RANGE_ROWS`` rows.
    """
    place = curve(F.col("pickup_location_key"), F.col("vendor_key"))
    placed = with_folder(fact, unit).withColumn("_place", place)
    order = [FOLDER, "_place", "pickup_location_key", "vendor_key"]
    keyed = "trip_id" in fact.columns
    if keyed:
        placed = placed.withColumn("trip_id", packed("trip_id"))
    if tasks:
        tasks = max(tasks, ceil(fact.count() / RANGE_ROWS))
    dealt = placed.repartitionByRange(tasks, *order) if tasks else placed.repartitionByRange(*order)
    ordered = dealt.sortWithinPartitions(*order).drop("_place")
    write_in_blocks(ordered.withColumn("trip_id", unpacked("trip_id")) if keyed else ordered, path, block_rows)


def blocks_read(spark: SparkSession, path: str, column: str, block_rows: int) -> DataFrame:
    """For every value of ``column``: the blocks whose range holds it (read), and all blocks.

    A block is ``block_rows`` rows of a file in stored order; its smallest and largest value are what
    a reader decides by.
    """
    stored = spark.read.parquet(path).select(
        column, F.col("_metadata.file_path").alias("file"), F.floor(F.col("_metadata.row_index") / block_rows).alias("block")
    )
    blocks = stored.groupBy("file", "block").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    values = stored.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    held = blocks.where("low is not null").select(F.explode(F.sequence("low", "high")).alias("value"))
    read = held.groupBy("value").agg(F.count(F.lit(1)).alias("read"))
    return values.join(read, "value").crossJoin(F.broadcast(blocks.agg(F.count(F.lit(1)).alias("blocks")))).select("value", "rows", "read", "blocks")
