"""What the corpus operators share: reading tables, row keys, folds, word splitting and Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of words, as a Java character class.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_rows(docs: DataFrame, *carried: str) -> DataFrame:
    """``doc_id``, the ``carried`` columns and the UTF-8 bytes of ``text`` (null: empty); other columns, whatever their names, go."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in carried], body.alias("text"))


def fold(doc_id: str | Column, of: int) -> Column:
    """The remainder of the CRC-32 of the id's text; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % of


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column) -> DataFrame:
    """At most about ``rows`` labelled texts for fitting, one per id, drawn by a hash of the id.

    ``allowed`` keeps the rows that may be learned from, by ``doc_id``. The labels are reduced to one
    per id (the smallest of the values 0 and 1 that are given) before the join; ids with a null in
    either table are left out. ``rows`` bounds the fit, nothing else.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & allowed)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    drawn = marks.withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id").limit(rows)
    texts = text_rows(docs).where(F.col("doc_id").isNotNull() & allowed)
    return texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id", "text"])  # drawn has at most `rows` rows


def by_batch(rows: DataFrame, work: Callable[..., dict], schema: str, *shared, size: int = 1 << 23) -> DataFrame:
    """``work(columns as lists, *shared)`` for every Arrow batch; it returns columns of ``schema``.

    ``shared`` are broadcast variables whose values ``work`` gets. Nothing is kept between batches
    but what ``work`` caches itself.
    """
    target = rows.sparkSession.createDataFrame([], schema).schema
    names = [field.name for field in target]

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        values = [s.value for s in shared]
        for batch in batches:
            for part in slices(batch, size):
                made = work({n: part.column(n).to_pylist() for n in part.schema.names}, *values)
                yield pa.RecordBatch.from_arrays([pa.array(made[n], arrow.field(n).type) for n in names], schema=arrow)

    return rows.mapInArrow(run, target)


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes, so that a worker never holds many texts as objects."""
    step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


class Cache(dict):
    """A bounded memo of two generations: when the young one is half of ``limit``, the old one goes."""

    def __init__(self, compute: Callable, limit: int = 300_000):
        super().__init__()
        self.compute, self.half, self.old = compute, limit // 2, {}

    def __missing__(self, key):
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value
