"""Scoring a stream of descriptions with a stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.classifier import NaiveBayes, predict
from ledgerlens.streaming.io import start_batches


def start_scoring(stream: DataFrame, model: NaiveBayes, row_id: str, path: str, checkpoint: str,
                  carry: Sequence[str] = ()) -> StreamingQuery:
    """Score each batch with the batch operator and write it to its own folder."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        filled = batch.na.fill("", ["description"])
        predict(filled, model, row_id, carry=carry).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start_batches(stream, handle, checkpoint)


def prediction_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("predicted_category").agg(F.count("*").alias("n"))
