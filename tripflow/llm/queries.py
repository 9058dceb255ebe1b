"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import bpe, brown, divergence, jaccard, licenses, mixing, order_minhash, quality, secrets, simhash, topk, toxicity, whitening
from tripflow.llm.common import table


def op1_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score(table(spark, folder, "documents"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"))


def op6_quality_fm(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op8_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, folder, "documents"))


def op9_secrets_crf(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


def op10_mixing_sainte_lague(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op11_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components_of(table(spark, folder, "embeddings"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.joined(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_brown_lm,
        op2_byte_bpe,
        op3_toxicity_ftrl,
        op4_simhash_near_dedup,
        op5_topk_search,
        op6_quality_fm,
        op7_license_scan,
        op8_order_minhash,
        op9_secrets_crf,
        op10_mixing_sainte_lague,
        op11_feast_whitening,
        op12_source_divergence,
        op13_jaccard_join,
    )
}

ORACLES: dict[str, str] = {
    "op5_topk_search": """
        WITH sound AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        scored AS (
            SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.parts, v.parts), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM sound q JOIN sound v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.parts) = len(v.parts)
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_source_divergence": divergence.ORACLE_SQL,
}
