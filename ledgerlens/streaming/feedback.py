"""Feedback stream: parse, check, mark, append; continuous feedback drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.numbers import parse_event_time
from ledgerlens.operators.drift import counted_feedback_status
from ledgerlens.operators.profile import label_fallback
from ledgerlens.operators.quality import feedback_rules, split_valid
from ledgerlens.sinks.writers import TIMESTAMP_FORMAT
from ledgerlens.sources.files import parse_feedback_lines
from ledgerlens.streaming.io import start_batches


def accepted_feedback(lines: DataFrame) -> DataFrame:
    """Valid feedback rows of a table or stream of JSON lines, with `correct` and a real timestamp.

    A row without a readable timestamp keeps null; the sink may fill it.
    """
    parsed = parse_feedback_lines(lines).where("_corrupt_record IS NULL").drop("_corrupt_record")
    valid, _ = split_valid(parsed, feedback_rules())
    return valid.withColumns({
        "correct": F.col("predicted_category") == F.col("actual_category"),
        "timestamp": parse_event_time(F.col("timestamp")),
    })


def append_feedback_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append accepted feedback as JSON files; the sink log makes it exactly once."""
    return (
        rows.writeStream.format("json").outputMode("append").option("timestampFormat", TIMESTAMP_FORMAT)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def label_counts_stream(feedback: DataFrame) -> DataFrame:
    """Running label counts; the state is one row per label."""
    return label_fallback(feedback).groupBy("label").agg(F.count("*").alias("n"))


def start_feedback_drift(feedback: DataFrame, baseline_label_counts: DataFrame, labels: DataFrame,
                         path: str, checkpoint: str, **settings) -> StreamingQuery:
    """Per batch, the drift status of all feedback so far against the fixed baseline.

    Complete mode hands over all label counts, which are few.
    """
    def handle(counts: DataFrame, batch_id: int) -> None:
        status = counted_feedback_status(baseline_label_counts, labels, counts, **settings)
        status.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start_batches(label_counts_stream(feedback), handle, checkpoint, "complete")
