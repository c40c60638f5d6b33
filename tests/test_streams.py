"""Stream queries over tables of several files, and the files that they make of the events."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerlens.catalog import streaming_queries as sq
from ledgerlens.catalog.registry import Tables

START = datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
KINDS = ["error", "view", "purchase", "click", "signup"]


def events(n, every=600):
    return [(i, START + timedelta(seconds=i * every), i % 7, KINDS[i * i % 5], float(i * 37 % 200), None) for i in range(n)]


@pytest.fixture
def folder_tables(spark, tmp_path):
    """Tables of three files each."""
    docs = [(i, f"word{i % 5} other{i % 3} text", ["en", "de"][i % 2], "web", 20) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(events(90), EVENTS).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_scoring_of_a_folder_of_files(spark, folder_tables):
    got = queries()["stream_scoring"](spark, folder_tables).collect()
    want = queries()["predicted_labels"](spark, folder_tables).select("row_id", "predicted_category").collect()
    assert len(got) == 60 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_gauges_of_a_folder_of_files(spark, folder_tables):
    got = queries()["stream_latest_gauges"](spark, folder_tables).collect()
    want = queries()["latest_gauges"](spark, folder_tables).collect()
    assert want and sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("values", [[], [5], [3, 1, 2, None], list(range(100)), [7] * 30 + [9] * 3, [10 ** 15 + i * i for i in range(77)]])
def test_percentiles_are_those_of_spark(spark, values):
    shares = [i / 5 for i in range(1, 5)]
    table = spark.createDataFrame([(v,) for v in values], "v long")
    want = table.agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("p")).first()["p"]
    assert sq.percentiles(table, shares) == (want or [])


@pytest.mark.parametrize("every", [600, 0])
def test_many_events_make_several_files_of_a_batch(spark, tmp_path, monkeypatch, every):
    """Also where all events have one time, so that four batches are empty."""
    spark.createDataFrame(events(90, every), EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(sq, "FILE_ROWS", 7)
    t = Tables(spark, str(tmp_path))
    parts = sq.event_files(t, str(tmp_path), 5, F.lit(False))
    files = spark.read.parquet(str(tmp_path / "events")).inputFiles()
    assert parts == 3 and len(files) == 15
    in_order = sorted(files, key=lambda f: os.stat(f.removeprefix("file://")).st_mtime_ns)
    ids = [sorted(r[0] for r in spark.read.parquet(*in_order[k:k + 3]).select("event_id").collect()) for k in range(0, 15, 3)]
    assert ids == ([list(range(k, k + 18)) for k in range(0, 90, 18)] if every else [list(range(90)), [], [], [], []])


def test_counters_over_batches_of_several_files(spark, folder_tables, monkeypatch):
    monkeypatch.setattr(sq, "FILE_ROWS", 7)
    got = queries()["stream_counter_increase"](spark, folder_tables).collect()
    assert len(got) == 90 and sorted(got) == sorted(queries()["counter_increase"](spark, folder_tables).select(*got[0].__fields__).collect())
