"""Multinomial naive Bayes as grouped counts, with add-one smoothing.

A model is two count tables, so fitting is two aggregations, fine-tuning on
more data is a sum of counts, and scoring looks weights up in the row.

    nb_class(run_id, label_idx, category, n_docs, n_tokens)
    nb_token(run_id, idx, label_idx, n)

With prior(c) = ln(N_c / N) and lik(t, c) = ln((cnt(t, c) + 1) / (tot(c) + V))
the score of a text with m words is
    prior(c) - m * ln(tot(c) + V) + sum over words of ln(cnt(t, c) + 1)
and a word never seen with a class adds ln(1) = 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.numbers import softmax
from ledgerlens.operators.features import sequence_words, text_indices
from ledgerlens.operators.lookup import weight_sums
from ledgerlens.operators.sizing import written


@dataclass(frozen=True)
class NaiveBayes:
    """Count tables of one run and the vocabulary they were counted with.

    `vocabulary_size` counts the unknown word and leaves padding out.
    """

    classes: DataFrame
    token_counts: DataFrame
    vocabulary: DataFrame
    vocabulary_size: int
    max_seq_len: int


def fit(train: DataFrame, labels: DataFrame, vocabulary: DataFrame, row_id: str, max_seq_len: int,
        run_id: str = "base", column: str = "description") -> NaiveBayes:
    """Count documents and words per class. `train` carries `label_idx`.

    The words come from `seq` where the rows are encoded already, else from
    the text column.
    """
    words = train.select("label_idx", F.explode(_words(train, vocabulary, max_seq_len, column)).alias("idx"))
    token_counts = (
        words.groupBy("idx", "label_idx").agg(F.count("*").alias("n"))
        .select(F.lit(run_id).alias("run_id"), "idx", "label_idx", "n")
    )
    token_counts = written(token_counts, "nb-token")
    classes = _class_table(
        train.groupBy("label_idx").agg(F.count("*").alias("n_docs")), token_counts, labels, run_id)
    return NaiveBayes(written(classes), token_counts, vocabulary, vocabulary.count() + 1, max_seq_len)


def _words(df: DataFrame, vocabulary: DataFrame, length: int, column: str) -> Column:
    """The word numbers of each row, from `seq` where it has one."""
    return sequence_words() if "seq" in df.columns else text_indices(vocabulary, length, column)


def _class_table(docs: DataFrame, token_counts: DataFrame, labels: DataFrame, run_id: str) -> DataFrame:
    words = token_counts.groupBy("label_idx").agg(F.sum("n").alias("n_tokens"))
    return docs.join(words, "label_idx", "left").join(labels, "label_idx").select(
        F.lit(run_id).alias("run_id"), "label_idx", "category", "n_docs",
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
    )


def merge(old: NaiveBayes, new: NaiveBayes, run_id: str) -> NaiveBayes:
    """Fine-tune: add the counts of two models that share a vocabulary."""
    if old.vocabulary_size != new.vocabulary_size or old.max_seq_len != new.max_seq_len:
        raise ValueError("models count over different vocabularies; refit instead")
    tokens = (
        old.token_counts.unionByName(new.token_counts)
        .groupBy("idx", "label_idx").agg(F.sum("n").alias("n"))
        .select(F.lit(run_id).alias("run_id"), "idx", "label_idx", "n")
    )
    classes = (
        old.classes.unionByName(new.classes)
        .groupBy("label_idx", "category").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        .select(F.lit(run_id).alias("run_id"), "label_idx", "category", "n_docs", "n_tokens")
    )
    return NaiveBayes(written(classes), written(tokens, "nb-token"), old.vocabulary, old.vocabulary_size, old.max_seq_len)


def class_rows(model: NaiveBayes) -> list:
    """The class table in label order. Label domains are small by nature."""
    return model.classes.orderBy("label_idx").collect()


def _weights(model: NaiveBayes, labels: list) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers, rising, and for each ln(n + 1) in every class."""
    table = model.token_counts.select(F.col("idx").cast("int").alias("idx"), "label_idx", F.col("n").cast("double").alias("n")).toArrow()
    numbers, row = np.unique(table.column("idx").to_numpy(), return_inverse=True)
    column = {label: i for i, label in enumerate(labels)}
    place = np.array([column.get(label, -1) for label in table.column("label_idx").to_pylist()], np.int64)
    weights = np.zeros((len(numbers), len(labels)))
    known = place >= 0
    np.add.at(weights, (row[known], place[known]), table.column("n").to_numpy()[known])
    return numbers, np.log1p(weights)


def score_columns(df: DataFrame, model: NaiveBayes, row_id: str, column: str = "description",
                  carry: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """(row_id, carry…, score_0…) with one log score column per class, row for row.

    The weights of a word, one number a class, are bounded by vocabulary and labels; they go
    to the tasks, and nothing is shuffled.
    """
    classes = class_rows(model)
    n_all = sum(c["n_docs"] for c in classes)
    numbers, weights = _weights(model, [c["label_idx"] for c in classes])
    found = weight_sums(_words(df, model.vocabulary, model.max_seq_len, column), numbers, weights)
    sums = df.select(row_id, *carry, found.alias("_sums")).select(
        row_id, *carry, F.col("_sums")[0].alias("_m"), *[F.col("_sums")[i + 1].alias(f"_s{i}") for i in range(len(classes))])

    def score(i: int, c) -> Column:
        prior = F.log(F.lit(float(c["n_docs"])) / F.lit(float(n_all)))
        norm = F.log(F.lit(float(c["n_tokens"] + model.vocabulary_size)))
        return prior + F.col(f"_s{i}") - F.col("_m") * norm

    scored = sums.select(row_id, *carry, *[score(i, c).alias(f"score_{i}") for i, c in enumerate(classes)])
    return scored, [c["category"] for c in classes]


def predict(df: DataFrame, model: NaiveBayes, row_id: str, column: str = "description",
            carry: Sequence[str] = ()) -> DataFrame:
    """(row_id, carry…, predicted_category, confidence, all_scores).

    Ties go to the lowest label index. A text without known words gets the
    class priors.
    """
    scored, names = score_columns(df, model, row_id, column, carry)
    raw = [F.col(f"score_{i}") for i in range(len(names))]
    with_probs = scored.select(row_id, *carry, F.array(*raw).alias("_raw"), F.array(*softmax(raw)).alias("_p"))
    best = F.array_position("_raw", F.array_max("_raw")).cast("int")
    labels = F.array(*[F.lit(n) for n in names])
    return with_probs.select(
        row_id, *carry,
        F.element_at(labels, best).alias("predicted_category"),
        F.element_at("_p", best).alias("confidence"),
        F.map_from_arrays(labels, F.col("_p")).alias("all_scores"),
    )


def explode_scores(predictions: DataFrame, row_id: str) -> DataFrame:
    """Long form of the score map: (row_id, category, probability)."""
    return predictions.select(row_id, F.explode("all_scores").alias("category", "probability"))


# --- Model tables by run id -------------------------------------------------
def save_model(model: NaiveBayes, path: str, run_id: str) -> None:
    """Write the model tables under `path`, one partition per run id."""
    def put(df: DataFrame, name: str) -> None:
        (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{path}/{name}"))

    put(model.classes, "nb_class")
    put(model.token_counts, "nb_token")
    put(model.vocabulary, "vocabulary")
    spark = model.classes.sparkSession
    put(spark.range(1).select(F.lit(model.vocabulary_size).alias("vocabulary_size"), F.lit(model.max_seq_len).alias("max_seq_len")), "settings")


def load_model(spark, path: str, run_id: str) -> NaiveBayes:
    """Load one run's tables; the run id prunes partitions. Raise if it is unknown."""
    def get(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}").where(F.col("run_id") == run_id)

    settings = get("settings").collect()
    if not settings:
        raise LookupError(f"no model for run id {run_id}")
    return NaiveBayes(
        written(get("nb_class")), get("nb_token"), get("vocabulary").select("token", "idx"),
        settings[0]["vocabulary_size"], settings[0]["max_seq_len"],
    )
