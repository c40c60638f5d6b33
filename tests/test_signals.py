"""Signals on a stream against the batch operator, over several files."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from ledgerlens.operators import alerts
from ledgerlens.streaming import alerts as stream_alerts, signals
from ledgerlens.streaming.arrow_state import packed, unpacked
from ledgerlens.streaming.io import read_batches, start_table, stream_parquet

START = datetime(2024, 1, 1)
REQUESTS = "event_id long, ts timestamp_ntz, endpoint string, ok boolean, latency_s double, is_feedback boolean, is_switch boolean"
PUSHES = "event_id long, ts timestamp_ntz, metric string, value double"
STEP = 60


def log(seed, n=700, hours=30):
    """Requests and pushes with equal times, in order of time, and a gap of ten hours."""
    draw = random.Random(seed)
    seconds = sorted(draw.choice([draw.randrange(0, 10 * 3600), draw.randrange(20 * 3600, hours * 3600)]) for _ in range(n))
    asked, pushed = [], []
    for i, s in enumerate(seconds):
        ts = START + timedelta(seconds=s)
        if draw.random() < 0.3:
            pushed.append((i, ts, draw.choice([*alerts.GAUGES, "other"]), draw.random() * 2))
        else:
            asked.append((i, ts, draw.choice(["/predict", "/feedback"]), draw.choice([True, True, False, None]), draw.random() * 2, draw.random() < 0.1, draw.random() < 0.05))
    return asked, pushed


def streamed(spark, tmp_path, files, clock, late="10 minutes", build=None):
    """Run batches of (requests, pushes), then one of a clock row; all batches are files of one log."""
    for requests, pushes in files:
        rows = signals.service_log(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(pushes, PUSHES))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    none = signals.service_log(spark.createDataFrame([], REQUESTS), spark.createDataFrame([], PUSHES), spark.createDataFrame([(clock,)], "ts timestamp_ntz"))
    none.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), none.schema, files_per_batch=1)
    ticks = signals.service_signal_stream(stream, late=late, parts=3, step=STEP)
    start_table(build(ticks) if build else ticks, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return read_batches(spark, str(tmp_path / "out"))


def behind(seconds, late=600):
    return START + timedelta(seconds=-(-seconds // STEP) * STEP + late + 1)


def same(got, want):
    want = want.select([c for c in got.columns if c in want.columns])
    got = got.select(want.columns)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_several_files_equal_the_batch(spark, tmp_path):
    asked, pushed = log(1)
    end = max(r[1] for r in asked + pushed)
    files = [([r for r in asked if r[0] % 700 // 140 == k], [r for r in pushed if r[0] % 700 // 140 == k]) for k in range(5)]
    # some rows come a file late, in any order, yet within the watermark's delay
    for k in range(4):
        edge = max(r[1] for part in files[k] for r in part)
        for side in (0, 1):
            late = [r for r in files[k][side] if edge - r[1] < timedelta(minutes=5)]
            files[k][side][:] = [r for r in files[k][side] if r not in late]
            files[k + 1][side][:0] = late[::-1]
    got = streamed(spark, tmp_path, files, behind((end - START).total_seconds() // 1))
    want = alerts.service_signals(spark.createDataFrame(asked, REQUESTS), spark.createDataFrame(pushed, PUSHES), step=STEP)
    assert got.select("batch_id").distinct().count() >= 4
    assert same(got, want)


def test_silence_is_raised_by_the_clock(spark, tmp_path):
    """Feedback stops for good; only the watermark moves on, and the alert fires 72 hours later."""
    asked = [(i, START + timedelta(minutes=i), "/feedback", True, 0.1, True, False) for i in range(5)]
    rule = [r for r in alerts.default_rules() if r.name == "FeedbackLoopDead"]
    hours = 24 + 48
    last = -(-(4 * 60) // STEP) * STEP
    got = streamed(spark, tmp_path, [(asked[:3], []), (asked[3:], [])], behind(last + hours * 3600),
                   build=lambda ticks: stream_alerts.alert_transition_stream(alerts.rule_conditions(ticks, rule), STEP))
    zero = int(START.timestamp()) // STEP
    found = [(r["state"], r["tick_no"] - zero - last // STEP) for r in got.orderBy("tick_no").collect()]
    assert found == [("pending", 24 * 60), ("firing", 72 * 60)]


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    asked, _ = log(2, 200)
    early = [(900 + i, START + timedelta(seconds=i), "/predict", False, 2.0, False, False) for i in range(20)]
    half = len(asked) // 2
    end = max(r[1] for r in asked)
    got = streamed(spark, tmp_path, [(asked[:half], []), (asked[half:], []), (early, [])], behind((end - START).total_seconds() // 1))
    want = alerts.service_signals(spark.createDataFrame(asked, REQUESTS), spark.createDataFrame([], PUSHES), step=STEP)
    assert same(got, want)


def test_events_without_an_id_make_no_ticks(spark, tmp_path):
    nameless = [(None, START, "/predict", True, 0.1, False, False)]
    assert streamed(spark, tmp_path, [(nameless, [])], behind(100)).isEmpty()


def test_last_outcomes_of_a_pane():
    frame = pd.DataFrame({"tick_no": [1, 1, 1, 2, 2], "at": [5, 3, 4, 9, 9], "event_id": [1, 2, 3, 5, 4], "failed": [1, 0, 1, 0, 1]})
    assert signals._last_of_each(frame, "tick_no", 2)["event_id"].tolist() == [3, 1, 4, 5]


def test_parts_do_not_matter():
    """Panes of few and of many parts give the same ticks, since the second step adds them up."""
    ticks = signals.SignalTicks(STEP, 1, ["up"], 3)
    rows = [(1, [1, 2, 0, 0], None), (1, [2, 1, 1, 0], None), (1, None, 1), (1, None, 0), (3, [1, 1, 0, 2], None), (3, None, 1)]
    panes = pd.DataFrame([(t, c, 0, 0, f, None, None) for t, c, f in rows], columns=["tick_no", "counts", "at", "event_id", "failed", "metric", "value"])
    made, *_ = ticks._ticks(1, 4, panes, np.zeros((0, 4), np.int64), np.zeros(0, np.int8), {})
    assert made["c0"].tolist() == [3, 3, 4, 4] and made["total"].tolist() == [3, 3, 4, 4]
    assert made["error_rate"].tolist() == [0.5, 0.5, 2 / 3, 2 / 3] and made["model_switches_1h"].tolist() == [0, 0, 2, 2]


def test_a_tick_has_one_pane_however_many_parts():
    """Thirty parts of a tick, each with all the outcomes it may hand on, end as one pane with as many as one part has."""
    step = signals.SpanPanes(STEP, 5)
    part = lambda k: {
        "counts": packed(pd.DataFrame({"tick_no": [7], "c0": [k], "total": [1]})),
        "outcomes": packed(pd.DataFrame({"tick_no": 7, "at": np.arange(5) * 30 + k, "event_id": k, "failed": np.int8(k % 2)})),
        "gauges": packed(pd.DataFrame({"tick_no": [7], "at": [k], "event_id": [1], "metric": ["up"], "value": [float(k)]}))}
    (out,) = step.handleInputRows(("s", 0), iter([pd.DataFrame([part(k) for k in range(30)])]), None)
    panes = unpacked(out["panes"][0])
    assert len(out) == 1 and out["tick"][0].timestamp() == 7 * STEP
    assert [list(c) for c in panes["counts"].dropna()] == [[sum(range(30)), 30]]
    assert panes["failed"].dropna().tolist() == [1, 0, 1, 0, 1] and panes["value"].dropna().tolist() == [29.0]


def test_events_without_a_time_change_nothing(spark, tmp_path):
    asked, pushed = log(3, 200)
    half, end = 100, max(r[1] for r in asked + pushed)
    timeless = [(800 + i, None, "/predict", False, 2.0, False, True) for i in range(20)]
    files = [([r for r in asked if r[0] < half] + timeless, [r for r in pushed if r[0] < half]),
             ([r for r in asked if r[0] >= half] + timeless, [r for r in pushed if r[0] >= half] + [(900, None, "up", 5.0)])]
    got = streamed(spark, tmp_path, files, behind((end - START).total_seconds() // 1))
    want = alerts.service_signals(spark.createDataFrame(asked, REQUESTS), spark.createDataFrame(pushed, PUSHES), step=STEP)
    assert same(got, want)
