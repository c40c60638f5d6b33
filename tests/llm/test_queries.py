"""Registered queries against SQL, and the pipeline against its operators' brute-force forms."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from ledgerlens.llm.queries import QUERIES, SQL
from tests.compare import differences, oracle
from tests.llm.conftest import CLASHES
from tests.llm.test_blob_ledger import brute as secrets
from tests.llm.test_combination_join import brute as groups
from tests.llm.test_contamination import brute as leaks
from tests.llm.test_fertility import brute as counts

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op12_window_packing", "op13_embedding_whitening"}))
def test_all_rows(spark, name):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rows = QUERIES[name](spark, FOLDER)
    assert rows.count() == n and rows.select("doc_id").distinct().count() == n


def test_pieces_of_all_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = QUERIES["op12_window_packing"](spark, FOLDER).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert whole.where("n = all").count() == docs.count()


def test_whitened_embeddings(spark):
    made = QUERIES["op13_embedding_whitening"](spark, FOLDER)
    assert made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = made.agg(F.count("*"), F.countDistinct("vec_id"), F.max("component"), F.max("identity_error")).first()
    n = spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    assert tuple(rows)[:3] == (32 * n, n, 32) and rows[3] < 1e-9


def test_one_query_an_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries() if q.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries()


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        path = os.path.join(tmp_path, str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        ids = {r["doc_id"] for r in after}
        assert len(ids) == len(after)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
        if name == "quality rules":
            for r in before:
                n, _, _, _, repeats = counts(r["text"])
                assert not (r["doc_id"] in ids and (n < 50 or 100 * repeats > 50 * n))
            assert len(ids) > 0.7 * len(before)
        elif name == "n-gram Jaccard join":
            assert ids == {i for i, _, c in groups([(r["doc_id"], r["text"]) for r in before]) if i == c}
        elif name == "benchmark decontamination":
            bad = {d for d, *_ in leaks([(r["doc_id"], r["text"]) for r in before], items)}
            assert bad and ids == {r["doc_id"] for r in before} - bad
        elif name == "secret scans":
            texts = {r["doc_id"]: r for r in after}
            for r in before:
                clean = texts[r["doc_id"]]["text"]
                assert not secrets(clean) and (clean == r["text"]) == (not secrets(r["text"]))
                assert texts[r["doc_id"]]["n_chars"] == len(clean)
        else:
            assert ids == {r["doc_id"] for r in before} and all(r["exact"] for r in after)


def test_stages_with_odd_rows(spark, docs, no_docs, tmp_path):
    for rows, label in ((docs, "odd"), (no_docs, "none")):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = os.path.join(tmp_path, f"{label}{k}")
            stage(spark, rows, FOLDER).write.parquet(path)
            if k < len(corpus_pipeline.STAGES) - 1:
                rows = spark.read.parquet(path)
                assert rows.columns == docs.columns
                assert rows.where(F.col(CLASHES[0]) != "clash").count() == 0
    assert spark.read.parquet(path).count() == 0
