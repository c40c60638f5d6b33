import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import FeatureParams
from ledgerlens.operators import drift, evaluation, profile
from ledgerlens.operators.labels import label_index
from ledgerlens.plans.ingest import ingest
from ledgerlens.plans.retrain import combine_sources, retrain
from ledgerlens.sinks.writers import append_feedback, write_csv, write_predictions
from ledgerlens.sources import files

TWO = "description string, category string"


def half_half(rows):
    return rows([("Food & Dining", 500), ("Transportation", 500)], "category string, n long")


def current(rows, food, travel):
    return rows([("Food & Dining",)] * food + [("Transportation",)] * travel, "category string")


def test_clean(rows):
    outcome, report = drift.check_drift(half_half(rows), current(rows, 50, 50))
    assert outcome == "clean" and report.where("flagged").isEmpty()
    assert drift.next_step(outcome) == "finish"


def test_detected(rows):
    outcome, report = drift.check_drift(half_half(rows), current(rows, 95, 5))
    assert outcome == "detected" and drift.next_step(outcome) == "combine_data"
    flags = {r["category"]: r.asDict() for r in drift.drift_flags(report).collect()}
    assert flags["Transportation"] == {"category": "Transportation", "baseline": 0.5, "current": 0.05, "shift": 0.45}
    assert drift.drift_summary(report).first()["max_shift"] == 0.45


def test_missing_inputs(rows):
    assert drift.check_drift(None, None)[0] == "no_drift_file"
    assert drift.check_drift(None, current(rows, 1, 1))[0] == "no_baseline"


def test_threshold_is_strict(rows):
    base = rows([("a", 0.5), ("b", 0.5)], "category string, share double")
    cur = rows([("a", 0.625), ("b", 0.375)], "category string, share double")
    assert drift.compare_shares(base, cur, 0.125).where("flagged").isEmpty()
    assert drift.compare_shares(base, cur, 0.124).where("flagged").count() == 2


def test_drift_is_symmetric_and_keeps_one_sided_labels(rows):
    a = rows([("x", 0.7), ("y", 0.3)], "category string, share double")
    b = rows([("x", 0.4), ("z", 0.6)], "category string, share double")
    one = {r["category"]: r["shift"] for r in drift.compare_shares(a, b).collect()}
    two = {r["category"]: r["shift"] for r in drift.compare_shares(b, a).collect()}
    assert one == pytest.approx(two) and set(one) == {"x", "y", "z"}


@pytest.mark.parametrize("n, status", [(99, "insufficient_data"), (100, "drift_detected"), (0, "insufficient_data")])
def test_feedback_minimum(rows, n, status):
    names = label_index(rows([("a",), ("b",)], "category string"))
    base = rows([(0, 50), (1, 50)], "label_idx int, n long")
    log = rows([("d", "a", "a")] * n, "description string, predicted_category string, actual_category string")
    got = drift.check_feedback_drift(base, names, log)
    assert got["status"] == status and got["feedback_samples"] == n


def test_feedback_statuses_without_input(rows):
    assert drift.check_feedback_drift(None, None, None)["status"] == "no_baseline"
    names = label_index(rows([("a",)], "category string"))
    assert drift.check_feedback_drift(rows([(0, 5)], "label_idx int, n long"), names, None)["status"] == "no_feedback"


def test_feedback_ok(rows):
    names = label_index(rows([("a",), ("b",)], "category string"))
    base = rows([(0, 50), (1, 50)], "label_idx int, n long")
    log = rows([("d", "a", "a"), ("d", "b", "")] * 60, "description string, predicted_category string, actual_category string")
    assert drift.check_feedback_drift(base, names, log)["status"] == "ok"


# --- Sources and sinks ------------------------------------------------------
def test_csv_missing_texts_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('description,category,extra\n"He said ""hi"", twice",Income,1\nNA,Income,2\n,x,3\nnull,None,4\n')
    df = files.read_csv(spark, str(tmp_path / "a.csv"), ["description", "category"])
    assert [tuple(r) for r in df.collect()] == [('He said "hi", twice', "Income"), (None, "Income"), (None, "x"), (None, None)]
    assert files.read_csv(spark, str(tmp_path / "a.csv"), na_markers=None).where("description = 'NA'").count() == 1


def test_csv_sample_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("description\nx\n")
    with pytest.raises(ValueError):
        files.sample_columns(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text("description,category\nx,y\n")
    assert files.sample_columns(spark, str(tmp_path / "b.csv")) == ["description", "category"]


def feedback_file(tmp_path):
    good = {"timestamp": 1700000000.5, "description": " Zomato ", "predicted_category": "Income", "actual_category": "Food & Dining", "correct": False, "transaction_id": None}
    lines = [json.dumps(good), "", "   ", "[1, 2]", "not json", json.dumps({"description": "x"}),
             json.dumps({**good, "timestamp": "2023-11-14T22:13:20Z"})]
    path = tmp_path / "feedback.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_feedback_lines_are_sorted_out(spark, tmp_path):
    rows = files.parse_feedback_lines(spark.read.text(feedback_file(tmp_path)))
    assert rows.count() == 5
    assert {r[0] for r in rows.where("_corrupt_record IS NOT NULL").select("_corrupt_record").collect()} == {"[1, 2]", "not json"}
    assert [tuple(r) for r in files.corrections(rows).distinct().collect()] == [("Zomato", "Food & Dining")]


def test_feedback_reader(spark, tmp_path):
    df = files.read_feedback(spark, feedback_file(tmp_path))
    assert files.corrections(df).count() == 2
    assert df.where("timestamp = '1700000000.5'").count() == 1


def test_append_feedback(spark, rows, tmp_path):
    one = rows([("d", "A", "A")], "description string, predicted_category string, actual_category string")
    append_feedback(one, str(tmp_path / "log"))
    append_feedback(one, str(tmp_path / "log"))
    assert files.read_feedback(spark, str(tmp_path / "log")).count() == 2


def test_sources_present_or_not(spark, rows, tmp_path):
    write_csv(rows([("a", "x")], TWO), str(tmp_path / "raw"))
    missing, there = str(tmp_path / "new"), str(tmp_path / "raw")
    assert files.first_source(spark, missing, there) == there
    with pytest.raises(FileNotFoundError):
        files.first_source(spark, missing)
    warned = []
    got = files.present_sources(spark, {missing: lambda p: None, there: lambda p: files.read_csv(spark, p)}, warned.append)
    assert len(got) == 1 and len(warned) == 1
    with pytest.raises(FileNotFoundError):
        files.present_sources(spark, {missing: lambda p: None}, warned.append)


def test_source_size(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"0" * 2_200_000)
    row = files.source_size(spark, str(tmp_path / "d")).first()
    assert (row["files"], row["size_mb"]) == (1, 2.1)


def test_description_lines(spark, tmp_path):
    (tmp_path / "d.txt").write_text("  Zomato food \n\n \t\nUber ride\n")
    assert sorted(r[0] for r in files.read_descriptions(spark, str(tmp_path / "d.txt")).collect()) == ["Uber ride", "Zomato food"]


def test_prediction_file(spark, rows, tmp_path):
    df = rows([("d", 12.5, "Income", 0.9876)], "description string, amount double, predicted_category string, confidence double")
    write_predictions(df, str(tmp_path / "p"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "p")).collect()] == [("d", "12.5", "Income", "98.8%")]


# --- Jobs -------------------------------------------------------------------
def test_ingest_job(spark, rows, tmp_path):
    raw = rows([("Zomato payment", "Food & Dining"), ("Uber ride", "Transportation"), ("Salary", "Income"), ("Salary", "Income"),
                (None, "Income"), ("x", "Nonsense")], TWO)
    out = ingest(raw, str(tmp_path))
    assert out.count() == 3 and out.columns == ["description", "category"]
    stored = files.read_ingest_baseline(spark, f"{tmp_path}/baseline_stats")
    assert {r["category"]: r["n"] for r in files.baseline_counts(stored).collect()} == {"Food & Dining": 1, "Transportation": 1, "Income": 1}


def test_ingest_of_nothing(rows, tmp_path):
    with pytest.raises(ValueError):
        ingest(rows([("x", "Nonsense")], TWO), str(tmp_path))


def test_combine(rows):
    base = rows([("a", "x"), ("b", "y")], TWO)
    new = rows([("a", "x"), ("c", "z")], TWO)
    log = rows([("a", "q", "w"), (" ", "q", "w"), ("b", "q", "y")], "description string, predicted_category string, actual_category string")
    got = {tuple(r) for r in combine_sources(base, new, log).collect()}
    assert got == {("a", "x"), ("b", "y"), ("c", "z"), ("a", "w")}
    with pytest.raises(FileNotFoundError):
        combine_sources(None, None, None)


def corpus(rows, skew):
    names = ["Income", "Transportation"]
    return rows([(f"{names[i % 2].lower()} payment {i}" if not skew else f"income salary {i}", names[i % 2] if not skew else "Income")
                 for i in range(80)], TWO)


def test_retrain_job(spark, rows, tmp_path):
    base = corpus(rows, False)
    ingest(base, str(tmp_path / "base"))
    log = rows([("uber ride", "Income", "Transportation")], "description string, predicted_category string, actual_category string")
    stats = f"{tmp_path}/base/baseline_stats"
    got = retrain(base, corpus(rows, True), log, stats, str(tmp_path / "run"), "r1", params=FeatureParams(min_freq=1))
    assert got.outcome == "detected" and got.f1_macro > 0.9
    assert spark.read.parquet(f"{tmp_path}/run/ingested/transactions").count() == 161
    assert spark.read.json(f"{tmp_path}/run/gauges/ingest").first()[0] == 1.0
    assert retrain(base, base, None, stats, str(tmp_path / "no"), "r2").outcome == "clean"
    assert retrain(base, None, None, stats, str(tmp_path / "no"), "r3").outcome == "no_drift_file"


def test_failed_ingest_writes_the_gauge(spark, rows, tmp_path):
    base = corpus(rows, False)
    ingest(base, str(tmp_path / "base"))
    with pytest.raises(ValueError):
        retrain(base, corpus(rows, True), None, f"{tmp_path}/base/baseline_stats", str(tmp_path / "run"), "r", allowed=["None of these"])
    assert spark.read.json(f"{tmp_path}/run/gauges/ingest").first()[0] == 0.0


def test_gate_stops_the_job(rows, tmp_path):
    base = corpus(rows, False)
    ingest(base, str(tmp_path / "base"))
    with pytest.raises(evaluation.BelowGate):
        retrain(base, corpus(rows, True), None, f"{tmp_path}/base/baseline_stats", str(tmp_path / "run"), "r", gate=1.01)


def test_top_values(rows):
    df = rows([("a",)] * 3 + [("c",)] * 2 + [("b",)] * 2 + [("d",)], "category string")
    assert [r["category"] for r in profile.top_values(df).collect()] == ["a", "b", "c"]
    assert profile.length_histogram(rows([("s", "x")], "split string, description string")).select(F.sum("n")).first()[0] == 1
