"""Retraining: combine the corpus after drift, refit or fine-tune, gate."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlens.config import DRIFT_THRESHOLD, F1_GATE, FeatureParams, SPENDING_CATEGORIES
from ledgerlens.operators.classifier import NaiveBayes, fit, predict, save_model
from ledgerlens.operators.drift import check_drift, next_step
from ledgerlens.operators.evaluation import check_gate, confusion, summary_metrics
from ledgerlens.operators.quality import dedup_any
from ledgerlens.plans.features import build_features, save_features
from ledgerlens.plans.ingest import ingest
from ledgerlens.sinks.writers import write_stats
from ledgerlens.sources.files import baseline_counts, corrections, read_ingest_baseline


def combine_sources(baseline: DataFrame | None, new_rows: DataFrame | None, feedback: DataFrame | None) -> DataFrame:
    """Distinct (description, category) of all present sources.

    Feedback counts under its actual category; rows with a blank text are
    left out.
    """
    parts = [df.select("description", "category") for df in (baseline, new_rows) if df is not None]
    if feedback is not None:
        parts.append(corrections(feedback))
    if not parts:
        raise FileNotFoundError("no data sources to combine")
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return dedup_any(combined, ["description", "category"])


def decode(encoded: DataFrame, labels: DataFrame) -> DataFrame:
    """Encoded rows with their label name next to the index."""
    return encoded.join(labels, "label_idx")


@dataclass(frozen=True)
class RetrainResult:
    outcome: str
    f1_macro: float | None
    model: NaiveBayes | None


def with_row_id(rows: DataFrame) -> DataFrame:
    """A stable id made of the row's own content, the same on every run."""
    return rows.withColumn("row_id", F.sha2(F.concat_ws("|", "category", "description"), 256))


def retrain(baseline: DataFrame, new_rows: DataFrame | None, feedback: DataFrame | None,
            baseline_path: str | None, path: str, run_id: str,
            allowed: Sequence[str] = SPENDING_CATEGORIES, params: FeatureParams = FeatureParams(),
            gate: float = F1_GATE, threshold: float = DRIFT_THRESHOLD) -> RetrainResult:
    """Check drift; when found, combine, ingest, build features, fit, evaluate, gate, save.

    `baseline_path` holds the stored ingest baseline. Stages hand over written
    tables, so a failed job restarts from the last one. A failed ingest writes
    0 to its success gauge before the error goes up. The model is saved only
    when it passes the gate.
    """
    spark = baseline.sparkSession
    stored = baseline_counts(read_ingest_baseline(spark, baseline_path)) if baseline_path else None
    outcome, _ = check_drift(stored, new_rows, threshold)
    if next_step(outcome) == "finish":
        return RetrainResult(outcome, None, None)

    def gauge(value: float) -> None:
        write_stats(spark.range(1).select(F.lit(value).alias("pipeline_ingest_success")), f"{path}/gauges/ingest")

    try:
        rows = ingest(combine_sources(baseline, new_rows, feedback), f"{path}/ingested", allowed)
    except Exception:
        gauge(0.0)
        raise
    gauge(1.0)

    made = build_features(with_row_id(rows), "row_id", params)
    encoded = decode(save_features(made, f"{path}/processed"), made.labels)
    model = fit(encoded.where("split = 'train'"), made.labels, made.vocabulary, "row_id", params.max_seq_len, run_id)
    scored = predict(encoded.where("split = 'test'"), model, "row_id", carry=["category"])
    summary = summary_metrics(confusion(scored, "category", "predicted_category"))
    write_stats(summary, f"{path}/metrics/{run_id}")
    f1 = check_gate(spark.read.json(f"{path}/metrics/{run_id}"), gate)
    save_model(model, f"{path}/models", run_id)
    return RetrainResult(outcome, f1, model)
