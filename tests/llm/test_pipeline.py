from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tripflow.llm import bpe, queries

from .conftest import make, words

SAMPLE = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="no sample tables here")


def folder_of(spark, path, rows, labels):
    make(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    rows = [(i, words(i, 80), "ab"[i % 2]) for i in range(120)]
    rows += [(200 + i, " ".join(w.upper() + "!!" for w in words(i, 40).split()), "a") for i in range(60)]
    rows += [(300 + i, words(7, 80), "b") for i in range(10)]
    rows += [(400 + i, words(50 + i, 40) + ' token = "' + "0a1b2c3d" * 5 + f'" {i}', "a") for i in range(20)]
    folder = folder_of(spark, tmp_path / "in", rows, [(r[0], int(not 200 <= r[0] < 300), 0) for r in rows])
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, work in corpus_pipeline.STAGES:
        out = work(spark, docs, folder)
        if name != "encode":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        found[name] = docs.collect()
    clean = {r[0] for r in rows if not 200 <= r[0] < 300}
    kept = {r.doc_id for r in found["quality"]}
    assert clean <= kept and len(kept - clean) < 10
    assert [r.doc_id for r in found["near_duplicates"] if r.text == words(7, 80)] == [7]
    assert len(found["secrets"]) == len(found["near_duplicates"])
    assert not any("0a1b2c3d" in r.text for r in found["secrets"]) and any("[SECRET]" in r.text for r in found["secrets"])
    own = bpe.Encoder(bpe.read_ranks(queries.public_tokenizers.path(corpus_pipeline.RANKS)), bpe.class_array())
    texts = sorted(own.decode(bpe.pack(r.ids)).decode() for r in found["encode"])
    assert texts == sorted(r.text for r in found["mix"])


def test_an_empty_table_runs_through(spark, tmp_path):
    folder = folder_of(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_run(spark, name):
    """The number of rows that each query's contract fixes: one per document, unless it says otherwise."""
    rows = queries.QUERIES[name](spark, SAMPLE)
    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    if name == "op5_topk_search":
        wanted = rows.select("query_id").distinct().count() * 5
    elif name == "op11_feast_whitening":
        vectors = spark.read.parquet(f"{SAMPLE}/embeddings.parquet").where("size(embedding) > 0").selectExpr("least(size(embedding), 32) AS n").collect()
        wanted = sum(v.n for v in vectors)
    elif name == "op12_source_divergence":
        rows = rows.where("part = 'pair'")
        sources = documents.selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source").distinct().groupBy("lang").count().collect()
        wanted = sum(g["count"] * (g["count"] - 1) for g in sources)
    else:
        wanted = documents.count()
    assert rows.count() == wanted
