"""Writers for tables, statistics, features and prediction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.text import percent_text

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header. Texts keep their outer blanks; a null is an empty cell."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_stats(one_row: DataFrame, path: str) -> None:
    """A one-row statistics table as JSON."""
    one_row.write.mode("overwrite").json(path)


def append_feedback(df: DataFrame, path: str) -> None:
    """Append feedback rows as JSON lines."""
    df.write.mode("append").option("timestampFormat", TIMESTAMP_FORMAT).json(path)


def write_lookups(path: str, vocabulary: DataFrame, labels: DataFrame, baseline: DataFrame) -> None:
    """The lookup tables and the baseline that go with encoded rows."""
    write_table(vocabulary, f"{path}/vocabulary")
    write_table(labels, f"{path}/labels")
    write_stats(baseline, f"{path}/feature_baseline")


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Result file: description, amount where there is one, category, confidence text."""
    amount = ["amount"] if "amount" in predictions.columns else []
    write_csv(predictions.select(
        "description", *amount, "predicted_category", percent_text(F.col("confidence")).alias("confidence")), path)


def append_runs(df: DataFrame, path: str) -> None:
    """Append rows to the run log, one partition per run id."""
    df.write.mode("append").partitionBy("run_id").parquet(path)
