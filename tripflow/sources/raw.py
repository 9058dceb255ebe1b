"""Scans of the raw files and the plain exports of them."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schemas
from tripflow.functions.numbers import no_nan
from tripflow.session import stage
from tripflow.sources import files

# Fixed value: the public naming of the monthly files.
MONTH_FILE = "yellow_tripdata_{month}.parquet"
POSITION = "_position"
# What a code becomes that is no whole number of its type: known to no code list and in no range.
NOT_A_CODE = -(1 << 63)


def with_position(scan: DataFrame) -> DataFrame:
    """Add the place of each row in the delivery: its file's full path, then its row in the file.

    Both come from the scan itself, so neither a listing nor the names of the files matter; places
    compare as file order and are looked at only where keys may repeat.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return scan.select("*", place.alias(POSITION))


def _whole(value: Column, kind: T.DataType) -> Column:
    """A floating value as a whole number; NaN is missing, a fraction or a value out of range no code."""
    value = no_nan(value.cast("double"))
    fits = (value == F.floor(value)) & value.between(-(2.0**53), 2.0**53)
    return F.when(value.isNotNull(), F.when(fits, value.cast("long")).otherwise(F.lit(NOT_A_CODE))).cast(kind)


def conform(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The twenty raw columns with their declared types; a missing column fails here.

    Files written by other tools store nullable codes as doubles, so codes are cast rather than
    read with a forced schema. NaN becomes NULL; a fraction becomes NOT_A_CODE, which the rules reject.
    """
    present = {name.lower(): field for name, field in zip(df.columns, df.schema.fields)}
    missing = [name for name in schemas.RAW_COLUMNS if name.lower() not in present]
    if missing:
        raise KeyError(f"raw file lacks columns: {', '.join(missing)}")
    columns = []
    for field in schemas.RAW:
        value = F.col(field.name)
        if isinstance(present[field.name.lower()].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = _whole(value, field.dataType) if isinstance(field.dataType, T.LongType) else no_nan(value.cast("double"))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *keep)


def read_month(spark: SparkSession, raw_dir: str, month: str, pattern: str = MONTH_FILE) -> DataFrame:
    """One month as delivered, with the position of every row."""
    path = f"{raw_dir}/{pattern.format(month=month)}"
    if not files.exists(spark, path):
        raise FileNotFoundError(f"Raw file not found: {path}")
    return read_files(spark, [path])


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The raw rows of files or folders as delivered, with the position of every row."""
    return reduce(DataFrame.unionByName, [conform(with_position(scan), keep=(POSITION,)) for scan in _same_types(spark, paths)])


def _same_types(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Scans of the files at ``paths``, together all of them, each over files that store the same types.

    Footers are merged by a Spark job; only a delivery of mixed types looks at its files one by one.
    """
    try:
        return [spark.read.option("mergeSchema", True).parquet(*paths)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for file in sorted(spark.read.parquet(*paths).inputFiles()):
        groups.setdefault(spark.read.parquet(unquote(file)).schema.json(), []).append(unquote(file))
    return [spark.read.parquet(*group) for group in groups.values()]


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Ad-hoc query input: the file itself, nothing loaded. Catalyst prunes columns and filters."""
    return spark.read.parquet(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw columns, taken by their names in the header, from a CSV, with the declared types.

    Files whose headers differ are refused by the scan. Text that is no value of its column's type
    is counted first, and the file is refused with the counts, rather than read as missing.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    scan = spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(path)
    present = {name.lower(): name for name in names}
    missing = [name for name in schemas.RAW_COLUMNS if name.lower() not in present]
    if missing:
        raise KeyError(f"CSV lacks columns: {', '.join(missing)}")
    texts = scan.select(*[F.col(f"`{present[name.lower()]}`").alias(name) for name in schemas.RAW_COLUMNS])
    typed = [F.col(f.name).try_cast(f.dataType) for f in schemas.RAW]
    bad = texts.agg(*[F.count_if(F.col(f.name).isNotNull() & v.isNull()).alias(f.name) for f, v in zip(schemas.RAW, typed)])
    found = {name: n for name, n in bad.first().asDict().items() if n}
    if found:
        raise ValueError(f"CSV values that do not fit their columns: {found}")
    return texts.select(*[value.alias(f.name) for f, value in zip(schemas.RAW, typed)])


def export_csv(df: DataFrame, path: str) -> None:
    """Whole month to CSV; an existing export is left alone."""
    df.select(*schemas.RAW_COLUMNS).write.mode("ignore").option("header", True).csv(path)


def extract_by_key(keyed: DataFrame, below: str) -> DataFrame:
    """The rows whose trip_id sorts below a hexadecimal bound: keys are hashes, so this is a random extract that anyone can repeat."""
    return keyed.filter(F.col("trip_id") < below)


def random_sample(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """Exactly ``rows`` random rows (all of them when there are fewer).

    Every row draws a number, written with its row so that later looks agree. The draws are counted
    in equal bins; rows of bins below the one that holds the last wanted draw are taken as they are,
    and only that bin is ordered, so no task ever holds the sample.
    """
    total = df.count()
    if rows >= total:
        return df
    bins = min(100_000, max(1, total // 1000))
    drawn = stage(df.withColumn("_draw", F.rand(seed)).withColumn("_bin", F.floor(F.col("_draw") * bins)), "draws")
    order = Window.partitionBy(F.lit(0)).orderBy("_bin")
    counts = drawn.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn("_through", F.sum("_n").over(order))
    last = counts.filter(F.col("_through") >= rows).orderBy("_bin").first()
    wanted = rows - (last["_through"] - last["_n"])
    edge = drawn.filter(F.col("_bin") == last["_bin"]).orderBy("_draw").limit(wanted)
    return drawn.filter(F.col("_bin") < last["_bin"]).unionByName(edge).drop("_draw", "_bin")
