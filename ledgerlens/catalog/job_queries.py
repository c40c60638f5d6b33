"""Readers, writers and whole jobs on files that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.bindings import DIRTY, GUESSED, SHORT, TX, dirty_transactions, guessed_language, short_transactions
from ledgerlens.catalog.registry import query
from ledgerlens.catalog.text_queries import FEATURES, P, encoded_cte, split_rows, split_sql, texts
from ledgerlens.config import F1_GATE
from ledgerlens.operators.classifier import load_model
from ledgerlens.operators.evaluation import evaluation_report
from ledgerlens.operators.runs import metric_log
from ledgerlens.plans.features import build_features, save_features
from ledgerlens.plans.ingest import ingest
from ledgerlens.plans.retrain import retrain
from ledgerlens.session import work_folder
from ledgerlens.sinks.writers import append_runs, write_csv, write_predictions
from ledgerlens.sources.files import present_sources, read_csv, read_features, sample_columns

LANGUAGES = ("de", "en", "es", "fr")


@query("csv_roundtrip", "S1, K1, P2", f"WITH {DIRTY} SELECT row_id, md5(description) AS digest, category FROM dirty")
def csv_roundtrip(t):
    folder = work_folder(t.spark, "csv")
    write_csv(dirty_transactions(t).select("row_id", "description", "category"), folder)
    sample_columns(t.spark, folder)
    rows = read_csv(t.spark, folder, ["row_id", "description", "category"], multi_line=True)
    return rows.select(F.col("row_id").cast("long").alias("row_id"), F.md5("description").alias("digest"), "category")


@query("prediction_file", "K6, F8", f"""
WITH {SHORT} SELECT s.description, CAST(s.amount AS DOUBLE) AS amount, s.category AS predicted_category, printf('%.1f%%', round_even((p.p_size * 25 % 1000)::DOUBLE / 1000 * 100, 1)) AS confidence
FROM short_tx s JOIN part p ON p.p_partkey = s.row_id""")
def prediction_file(t):
    sizes = t.part.select(F.col("p_partkey").alias("row_id"), (F.col("p_size") * 25 % 1000 / 1000).alias("confidence"))
    folder = work_folder(t.spark, "predictions")
    write_predictions(short_transactions(t).withColumnRenamed("category", "predicted_category").join(sizes, "row_id"), folder)
    return read_csv(t.spark, folder).withColumn("amount", F.col("amount").cast("double"))


@query("stored_features", "K4, S10, L4", f"""
WITH {TX}, {FEATURES}, {encoded_cte('split_tx', carry=', split, category')}
SELECT e.row_id, l.label_idx, md5(string_agg(idx, ',' ORDER BY pos)) AS fingerprint
FROM enc e JOIN li l USING (category) WHERE e.split = 'train' GROUP BY ALL""")
def stored_features(t):
    folder = work_folder(t.spark, "features")
    save_features(build_features(texts(t).select("row_id", "description", "category"), "row_id", P), folder)
    rows = read_features(t.spark, folder, "train")
    return rows.select("row_id", "label_idx", F.md5(F.array_join("seq", ",")).alias("fingerprint"))


@query("present_sources", "S8, S9, U1", """
SELECT length(text) % 10 AS digit, count(*) AS n FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations) GROUP BY 1""")
def present_sources_union(t):
    def read(path):
        return t.spark.read.parquet(path).select("text")

    paths = [f"{t.folder}/{n}.parquet" for n in ("no_such_table", "documents", "conversations")]
    first, *others = present_sources(t.spark, {p: read for p in paths}, warn=lambda message: None)
    for other in others:
        first = first.unionByName(other)
    return first.groupBy((F.length("text") % 10).cast("long").alias("digit")).agg(F.count("*").alias("n"))


_REPORT = f"""{GUESSED}, conf AS (SELECT actual, predicted, count(*) AS n FROM guessed GROUP BY 1, 2),
ids AS (SELECT unnest(['first', 'second']) AS run_id)"""


@query("metric_log", "L11, L8", f"""
WITH {_REPORT} SELECT run_id, 'test_accuracy' AS metric, round(sum(n) FILTER (WHERE actual = predicted) / sum(n)::DOUBLE, 12) AS value
FROM conf, ids GROUP BY run_id""")
def metric_log_rows(t):
    folder = work_folder(t.spark, "runs")
    report = evaluation_report(guessed_language(t))
    for run_id in ("first", "second"):
        append_runs(metric_log(run_id, report), folder)
    rows = t.spark.read.parquet(folder).where("metric = 'test_accuracy'")
    return rows.select(F.col("run_id").cast("string").alias("run_id"), "metric", F.round("value", 12).alias("value"))


@query("retrain_job", "D8, D4, D7, L7, L9, P20", f"""
WITH {TX}, {split_sql()}, u AS (
  SELECT description, category FROM base UNION SELECT description, category FROM drifted UNION SELECT trim(text), 'en' FROM benchmark)
SELECT 'detected' AS outcome, category, count(*) AS n, true AS passed, true AS saved, 'clean' AS second_outcome, false AS second_saved
FROM u GROUP BY category""")
def retrain_job(t):
    """Drift found, corpus combined, ingested, encoded, fitted, evaluated, gated, stored; the ingested rows are counted.

    The threshold is 0, so that the job also runs through on small tables. A second
    run gets rows as the baseline has them and must end without a model.
    """
    base, drifted = split_rows(t)
    feedback = t.benchmark.select(F.col("text").alias("description"), F.lit("en").alias("actual_category"))
    folder = work_folder(t.spark, "retrain")
    ingest(base, f"{folder}/base", LANGUAGES, "row_id")
    result = retrain(base, drifted, feedback, f"{folder}/base/baseline_stats", f"{folder}/run", "run-1", LANGUAGES, P, threshold=0.0)
    rows = t.spark.read.parquet(f"{folder}/run/ingested/transactions")
    again = retrain(base, base, feedback, f"{folder}/base/baseline_stats", f"{folder}/again", "run-2", LANGUAGES, P, threshold=0.05)
    stored = load_model(t.spark, f"{folder}/run/models", "run-1").classes.count()
    return rows.groupBy("category").agg(F.count("*").alias("n")).select(
        F.lit(result.outcome).alias("outcome"), "category", "n", F.lit(result.f1_macro >= F1_GATE).alias("passed"), F.lit(stored > 0).alias("saved"),
        F.lit(again.outcome).alias("second_outcome"), F.lit(again.model is not None).alias("second_saved"))
