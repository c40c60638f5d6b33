"""Keyed state on streams, over several batches."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.operators import telemetry
from ledgerlens.streaming import keyed
from ledgerlens.streaming.io import read_batches, start_table, stream_parquet

START = datetime(2024, 1, 1)


def ran(spark, tmp_path, batches, schema, build):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_batch=1)
    start_table(build(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return read_batches(spark, str(tmp_path / "out"))


SAMPLES = "sample_id long, ts timestamp_ntz, series string, value double"


def test_counters_over_batches(spark, tmp_path):
    """Restarts at and between batch borders, samples a batch late, equal times, a null series, null values."""
    draw = random.Random(4)
    rows = [(i, START + timedelta(seconds=i // 2 * 30), draw.choice(["a", "a", "b", None]), float(draw.randrange(100))) for i in range(400)]
    batches = [[] for _ in range(5)]
    for r in rows:
        home = r[0] // 100
        batches[home + (1 if draw.random() < 0.1 and r[0] % 100 > 80 else 0)].append(r)
    for b in batches:
        draw.shuffle(b)
    batches[1].append((900, START, "a", 5.0))  # on time only within the delay
    batches[4] += [(901, START, "a", 7.0), (902, START + timedelta(hours=3), "a", None)]  # behind the watermark; without a value
    batches.append([(None, START + timedelta(hours=9), "clock", 0.0)])
    got = ran(spark, tmp_path, batches, SAMPLES, lambda s: keyed.counter_increase_stream(s, ["series"], "1 hour"))
    want = telemetry.counter_increase(spark.createDataFrame([*rows, (900, START, "a", 5.0)], SAMPLES), ["series"]).select("sample_id", "series", "increase")
    assert {tuple(r) for r in got.select("sample_id", "series", "increase").collect()} == {tuple(r) for r in want.collect()}
    assert got.count() == 401 and got.select("batch_id").distinct().count() >= 3


def test_last_rows_of_hot_and_rare_keys(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, START + timedelta(seconds=draw.randrange(i // 200 * 100, i // 200 * 100 + 100)), draw.choice(["hot"] * 8 + ["x", None]), draw.choice([True, True, False, None])) for i in range(800)]
    batches = [rows[a:a + 200] for a in range(0, 800, 200)]
    got = ran(spark, tmp_path, batches, "event_id long, ts timestamp_ntz, key string, ok boolean", lambda s: keyed.rolling_error_rates(s, ["key"], 30, 4))
    found = {(r["batch_id"], r["key"]): (r["error_rate"], r["n"]) for r in got.collect()}
    kept = {}
    for k, batch in enumerate(batches):
        for i, ts, key, ok in sorted(batch, key=lambda r: (r[1], r[0])):
            kept.setdefault(key, []).append(0 if ok else 1)
        for key in {r[2] for r in batch}:
            last = kept[key][-30:]
            assert found.pop((k, key)) == (sum(last) / len(last), len(last))
    assert not found


def test_every_row_is_kept_late_or_repeated(spark, tmp_path):
    at = lambda minutes: START + timedelta(minutes=minutes)
    batches = [
        [(1, at(0), "a"), (2, at(10), "b"), (2, at(10), "b")],
        [(3, at(100), "c"), (2, at(10), "b"), (1, at(0), "other")],  # the watermark is at 0: row 1 is late
        [(4, at(50), "d"), (5, at(95), "e"), (3, at(100), "again"), (None, at(99), "no id"), (None, at(99), "no id"), (6, None, "no time")],
        [(7, at(89), "g"), (7, at(91), "a first"), (7, at(91), "b second"), (8, at(200), "h")],
    ]
    schema = "event_id long, ts timestamp_ntz, note string"
    got = ran(spark, tmp_path, batches, schema, lambda s: keyed.arrivals(s, "event_id", "10 minutes", 3))
    rows = sorted((str(r["event_id"]), r["note"], r["arrival"]) for r in got.collect())
    assert rows == sorted([
        ("1", "a", "kept"), ("2", "b", "kept"), ("2", "b", "repeated"), ("3", "c", "kept"), ("2", "b", "repeated"), ("1", "other", "late"),
        ("4", "d", "late"), ("5", "e", "kept"), ("3", "again", "repeated"), ("None", "no id", "kept"), ("None", "no id", "kept"), ("6", "no time", "late"),
        ("7", "g", "late"), ("7", "a first", "kept"), ("7", "b second", "repeated"), ("8", "h", "kept")])
    assert got.where(F.col("arrival").isNull()).isEmpty() and got.columns[:3] == ["event_id", "ts", "note"]


class Held:
    """A state value and its handle outside a stream."""
    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_samples_of_a_lot_pass_one_batch_at_a_time():
    """The series' step holds the first sample of each lot only, whatever the lots hold."""
    taken = []

    def lots():
        for k in (1, 0):  # in any order
            for opens in (True, False):
                taken.append((k, opens))
                n = 1 if opens else 1000
                yield pd.DataFrame({
                    "series": "a", "sample_id": np.arange(n), "ts": pd.to_datetime([START + timedelta(hours=k)] * n, utc=True), "value": 5.0 + k,
                    "increase": np.nan if opens else 0.0, "closes": 9.0 - 6 * k if opens else np.nan})

    step, state = keyed.CounterSeries(["series"]), Held()
    step.init(state)
    rows = step.handleInputRows(("a",), lots(), None)
    assert len(next(rows)) == 1000 and taken == [(1, True), (1, False)]
    assert len(next(rows)) == 1000 and len(taken) == 4
    assert next(rows)["increase"].tolist() == [0.0, 6.0]  # 5 with nothing before; 6 after a restart from 9
    assert state.value == (3.0,) and next(rows, None) is None


def test_last_rows_hold_no_more_than_they_keep(monkeypatch):
    largest = []
    ordered = pd.DataFrame.sort_values
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda self, *a, **k: largest.append(len(self)) or ordered(self, *a, **k))
    step = keyed.LastRows(["key"], 10, True)
    step.init(Held())
    batches = (pd.DataFrame({"at": np.arange(k * 100, k * 100 + 100), "event_id": 1, "failed": np.int8(k % 2)}) for k in (3, 0, 2, 1))
    (out,) = step.handleInputRows(("a",), batches, None)
    assert out["at"].tolist() == list(range(390, 400)) and max(largest) <= 110


def test_counters_over_short_spans(spark, tmp_path):
    """Lots of many spans and batches join as one series, with spans that have no sample or end inside a batch."""
    draw = random.Random(6)
    rows = [(i, START + timedelta(seconds=i // 3 * 50 + i // 100 * 4000), draw.choice(["a", "b", None]), float(draw.randrange(50))) for i in range(300)]
    timeless = [(500 + i, None, draw.choice(["a", "b", None]), 3.0) for i in range(40)]
    batches = [rows[a:a + 75] + timeless[a // 75::4] for a in range(0, 300, 75)] + [[(None, START + timedelta(hours=30), "clock", 0.0)]]
    got = ran(spark, tmp_path, batches, SAMPLES, lambda s: keyed.counter_increase_stream(s, ["series"], "10 minutes", span=120))
    want = telemetry.counter_increase(spark.createDataFrame(rows, SAMPLES), ["series"]).select("sample_id", "series", "increase")
    assert sorted(map(str, got.select("sample_id", "series", "increase").collect())) == sorted(map(str, want.collect()))
