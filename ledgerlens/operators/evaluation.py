"""Confusion matrix, per-class and averaged metrics, acceptance gate.

The large table is grouped once into (actual, predicted, n), which is
materialised where it is used several times; every metric is computed from
those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.config import F1_GATE
from ledgerlens.functions.numbers import safe_ratio
from ledgerlens.operators.sizing import written


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(actual, predicted, n) for the pairs that occur."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_dense(matrix: DataFrame) -> DataFrame:
    """All (actual, predicted) pairs over the union of labels, 0 where none occurred.

    Each actual label gets its counts as a map and walks the label array, so
    no label pairs are joined.
    """
    matrix = written(matrix)
    names = matrix.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()
    label_array = names.agg(F.array_sort(F.collect_list("label"))).scalar()
    rows = matrix.groupBy("actual").agg(F.map_from_entries(F.collect_list(F.struct("predicted", "n"))).alias("_row"))
    full = names.withColumnRenamed("label", "actual").join(rows, "actual", "left").withColumn("_labels", label_array)
    return full.select("actual", "_row", F.explode("_labels").alias("predicted")).select(
        "actual", "predicted", F.coalesce(F.try_element_at("_row", F.col("predicted")), F.lit(0).cast("long")).alias("n"))


def confusion_matrix_rows(matrix: DataFrame) -> DataFrame:
    """Export form: one row per actual label with its counts in label order."""
    cells = F.collect_list(F.struct("predicted", "n"))
    return confusion_dense(matrix).groupBy("actual").agg(
        F.transform(F.array_sort(cells), lambda x: x["n"]).alias("counts"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """(label, support, precision, recall, f1), 0 on empty denominators."""
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")),
    ))
    sums = matrix.select(sides.alias("s")).groupBy("s.label").agg(
        F.sum("s.a").alias("support"), F.sum("s.p").alias("_pred"), F.sum("s.tp").alias("_tp"))
    return sums.select(
        "label", "support",
        safe_ratio(F.col("_tp"), F.col("_pred")).alias("precision"),
        safe_ratio(F.col("_tp"), F.col("support")).alias("recall"),
        safe_ratio(2 * F.col("_tp"), F.col("_pred") + F.col("support")).alias("f1"),
    )


def summary_metrics(matrix: DataFrame) -> DataFrame:
    """One row: accuracy, macro F1, support-weighted F1."""
    matrix = written(matrix)
    scores = class_metrics(matrix).agg(
        F.avg("f1").alias("f1_macro"),
        safe_ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
    )
    hits = matrix.agg(safe_ratio(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)), F.sum("n")))
    return scores.select(hits.scalar().alias("accuracy"), "f1_macro", "f1_weighted")


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def evaluation_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Long report (metric, label, value): averages, per-class F1 and cell counts."""
    matrix = written(confusion(df, actual, predicted))
    overall = summary_metrics(matrix).select(F.explode(F.create_map(
        F.lit("test_accuracy"), F.col("accuracy"),
        F.lit("test_f1_macro"), F.col("f1_macro"),
        F.lit("test_f1_weighted"), F.col("f1_weighted"),
    )).alias("metric", "value")).select("metric", F.lit(None).cast("string").alias("label"), "value")
    per_class = class_metrics(matrix).select(F.lit("per_class_f1").alias("metric"), "label", F.col("f1").alias("value"))
    return overall.unionByName(per_class)


class BelowGate(RuntimeError):
    """The model misses the acceptance threshold."""


def check_gate(summary: DataFrame, threshold: float = F1_GATE) -> float:
    """Return macro F1 of the one-row summary, or raise when it is below the threshold."""
    value = summary.select("f1_macro").first()[0]
    if value is None or value < threshold:
        raise BelowGate(f"macro F1 {value} is below {threshold}")
    return value
