"""A corpus pipeline of the operators in `ledgerlens.llm`, stage after stage.

Every stage keeps rows as they are, whatever their ids: decisions go by text, so
rows with null or repeated ids fare like any others. An empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import blob_ledger, combination_join, contamination, fertility, viterbi_pieces
from ledgerlens.operators.sizing import written
from ledgerlens.session import work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the fertility bands of their language."""
    return fertility.kept_rows(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return combination_join.keep_one(docs)


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(_key(F.col("text")).alias("key"), "text")
    hits = written(contamination.contained_items(keyed, items, id_col="key").select("key").distinct(), "contaminated")
    return docs.join(hits, _key(docs["text"]) == hits["key"], "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span masked."""
    scanned = blob_ledger.scan(docs, work_folder(spark, "ledger")).where(F.size("spans") > 0)
    found = written(scanned.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans")).dropDuplicates(["_blob"]), "secrets")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.unhex(F.sha2(
        F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("blob"))
    text = F.col("row.text")
    masked = F.when(F.col("_spans").isNull(), text).otherwise(blob_ledger.mask(text, F.col("_spans")))
    changed = {"text": masked, "n_chars": F.when(F.col("_spans").isNull(), F.col("row.n_chars")).otherwise(F.char_length(masked))}
    return rows.join(found, rows["blob"] == found["_blob"], "left").select(
        *[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids, with whether decoding gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    back = viterbi_pieces.round_trip(rows, model)
    return back.select(
        "doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.col("text")).alias("exact"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", sentence_pieces),
]

#: Piece counts decide the quality stage, and pieces are the result of the last one; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = work_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
