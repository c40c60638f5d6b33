"""Category drift: baseline shares against current shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.config import DRIFT_THRESHOLD, MIN_FEEDBACK_SAMPLES
from ledgerlens.functions.numbers import half_even
from ledgerlens.operators.labels import decode_counts
from ledgerlens.operators.profile import feedback_label_counts, shares_of_counts, value_shares
from ledgerlens.operators.sizing import written


def compare_shares(baseline: DataFrame, current: DataFrame, threshold: float = DRIFT_THRESHOLD,
                   column: str = "category") -> DataFrame:
    """(category, baseline, current, shift, flagged) over the labels of both sides.

    Both inputs have one row per label. A label missing on one side counts as
    0 there; the threshold is strict and applies to the unrounded shift.
    """
    base = baseline.select(column, F.col("share").alias("baseline"))
    cur = current.select(column, F.col("share").alias("current"))
    shift = F.abs(F.col("current") - F.col("baseline"))
    return (
        base.join(cur, column, "full").na.fill(0.0, ["baseline", "current"])
        .withColumn("shift", shift)
        .withColumn("flagged", shift > threshold)
    )


def category_drift(baseline_counts: DataFrame, current: DataFrame, threshold: float = DRIFT_THRESHOLD,
                   column: str = "category", dedup_current: bool = False) -> DataFrame:
    """Drift of raw rows against stored baseline counts (category, n).

    By default the current rows are taken as they come, copies included.
    """
    if dedup_current:
        current = current.distinct()
    return compare_shares(shares_of_counts(baseline_counts), value_shares(current, column), threshold, column)


def drift_flags(report: DataFrame) -> DataFrame:
    """Flagged labels with shares rounded to four digits, for display."""
    return report.where("flagged").select(
        report.columns[0], *[half_even(F.col(c), 4).alias(c) for c in ("baseline", "current", "shift")])


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: drift_detected, flagged labels, largest flagged shift (rounded, 0 if none)."""
    return report.agg(
        F.coalesce(F.bool_or("flagged"), F.lit(False)).alias("drift_detected"),
        F.count_if("flagged").alias("n_flagged"),
        max_flagged_shift().alias("max_shift"),
    )


def max_flagged_shift() -> Column:
    return F.coalesce(F.max(F.when(F.col("flagged"), half_even(F.col("shift"), 4))), F.lit(0.0))


def check_drift(baseline_counts: DataFrame | None, current: DataFrame | None,
                threshold: float = DRIFT_THRESHOLD) -> tuple[str, DataFrame | None]:
    """Outcome of the daily check and its report.

    Outcomes: no_drift_file, no_baseline, detected, clean. The report has one
    row per label; only its one-row summary comes to the driver.
    """
    if current is None:
        return "no_drift_file", None
    if baseline_counts is None:
        return "no_baseline", None
    report = category_drift(baseline_counts, current, threshold)
    found = drift_summary(report).first()["drift_detected"]
    return ("detected" if found else "clean"), report


def next_step(outcome: str) -> str:
    """The step after the drift check."""
    return "combine_data" if outcome == "detected" else "finish"


# --- Feedback drift ---------------------------------------------------------
def feedback_report(baseline_label_counts: DataFrame, labels: DataFrame, feedback: DataFrame,
                    threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Drift of feedback labels against the label counts of the train split.

    Baseline indices that no longer decode stay in the baseline total.
    """
    return counted_feedback_report(baseline_label_counts, labels, feedback_label_counts(feedback), threshold)


def counted_feedback_report(baseline_label_counts: DataFrame, labels: DataFrame, counts: DataFrame,
                            threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """The same from feedback that is already counted as (label, n)."""
    base = decode_counts(baseline_label_counts, labels)
    current = shares_of_counts(counts).withColumnRenamed("label", "category")
    return compare_shares(base, current, threshold)


def feedback_status(baseline_label_counts: DataFrame, labels: DataFrame, feedback: DataFrame,
                    threshold: float = DRIFT_THRESHOLD, minimum: int = MIN_FEEDBACK_SAMPLES) -> DataFrame:
    """One row: status, feedback_samples, n_flagged, max_shift.

    The feedback is counted once; everything after that is label-sized.
    """
    counts = written(feedback_label_counts(feedback))
    return counted_feedback_status(baseline_label_counts, labels, counts, threshold, minimum)


def counted_feedback_status(baseline_label_counts: DataFrame, labels: DataFrame, counts: DataFrame,
                            threshold: float = DRIFT_THRESHOLD, minimum: int = MIN_FEEDBACK_SAMPLES) -> DataFrame:
    """The same from feedback that is already counted as (label, n)."""
    samples = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("feedback_samples"))
    found = drift_summary(counted_feedback_report(baseline_label_counts, labels, counts, threshold))
    enough = F.col("feedback_samples") >= minimum
    joined = found.withColumn("feedback_samples", samples.scalar())
    return joined.select(
        F.when(~enough, "insufficient_data").when(F.col("drift_detected"), "drift_detected").otherwise("ok").alias("status"),
        "feedback_samples",
        F.when(enough, F.col("n_flagged")).otherwise(0).alias("n_flagged"),
        F.when(enough, F.col("max_shift")).otherwise(0.0).alias("max_shift"),
    )


def check_feedback_drift(baseline_label_counts: DataFrame | None, labels: DataFrame | None,
                         feedback: DataFrame | None, threshold: float = DRIFT_THRESHOLD,
                         minimum: int = MIN_FEEDBACK_SAMPLES) -> dict:
    """Status of the feedback check as a small dict, missing inputs included."""
    if baseline_label_counts is None or labels is None:
        return {"status": "no_baseline"}
    if feedback is None:
        return {"status": "no_feedback", "feedback_samples": 0}
    return feedback_status(baseline_label_counts, labels, feedback, threshold, minimum).first().asDict()


def delta_table(baseline: DataFrame, current: DataFrame, column: str = "category") -> DataFrame:
    """Percentage shares of two tables and their difference, largest increase first."""
    both = compare_shares(value_shares(baseline, column), value_shares(current, column), column=column)
    return both.select(
        column,
        (F.col("baseline") * 100).alias("base_pct"),
        (F.col("current") * 100).alias("drift_pct"),
        (F.col("current") * 100 - F.col("baseline") * 100).alias("delta"),
    ).orderBy(F.desc("delta"), column)


def label_union(left: DataFrame, right: DataFrame, column: str = "category") -> DataFrame:
    """Labels that occur on either side."""
    return left.select(column).union(right.select(column)).where(F.col(column).isNotNull()).distinct()
