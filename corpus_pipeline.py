"""From raw documents to token ids: classify, deduplicate, redact, mix, encode.

Each stage is (name, function of spark, docs, folder) and calls one operator of ``tripflow.llm`` on
all rows its predecessor kept. All stages but the last return the columns of documents. Rows of a
stage that has no rows to work on are none; an empty table gives an empty result of the last stage's
columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import bpe, mixing, quality, secrets, simhash
from tripflow.llm.common import table
from tripflow.session import scratch_path

#: The rank file of the last stage.
RANKS = "byte_bpe_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep(docs, quality.fit(docs, table(spark, folder, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one row of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace every secret by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Bring the sources to their target weights: documents, pieces and repeats of them."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids with the offsets of the slices they came from, under the document's id and source."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), "source")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("encode", encode_texts),
]

#: Classifiers, fingerprints and byte pairs have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``, each written and read again."""
    docs = table(spark, folder, "documents")
    for name, work in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        work(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
