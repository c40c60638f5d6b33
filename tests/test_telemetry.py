import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from ledgerlens.config import LATENCY_BOUNDS
from ledgerlens.operators import alerts, ordered, runs, telemetry
from ledgerlens.operators.statement import debit_rows, resolve_columns
from ledgerlens.sources.statements import headerless_files, read_statement_lines, statement_rows
from ledgerlens.streaming import alerts as stream_alerts, telemetry as stream_telemetry
from ledgerlens.streaming.io import read_batches, start_table, stream_parquet

START = datetime(2024, 1, 1)


def log(rows, n=5000, seed=1, hot=0.4):
    """A request log in which one key holds a large part of the rows, with equal timestamps."""
    r = random.Random(seed)
    data = [(i, START + timedelta(seconds=r.randrange(0, 6 * 3600)), "hot" if r.random() < hot else f"k{r.randrange(9)}", r.random() > 0.2) for i in range(n)]
    return rows(data, "event_id long, ts timestamp_ntz, key string, ok boolean")


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_rolling_rate_equals_plain_window(rows, keys):
    df = log(rows)
    w = Window.partitionBy(*keys).orderBy("ts", "event_id").rowsBetween(-99, 0)
    want = df.select("event_id", F.avg(F.when(F.col("ok"), 0).otherwise(1)).over(w).alias("r"))
    got = ordered.rolling_mean(df, keys, ["ts", "event_id"], F.when(F.col("ok"), 0).otherwise(1), 100, "r", chunk_rows=150)
    assert got.select("event_id", "r").exceptAll(want).isEmpty() and got.count() == 5000


def test_running_with_null_keys_and_values(rows):
    data = [(i, None if i % 3 == 0 else "k", None if i % 5 == 0 else i) for i in range(300)]
    df = rows(data, "i long, key string, v long")
    w = Window.partitionBy("key").orderBy("i")
    got = ordered.running(df, ["key"], ["i"], sums={"s": F.col("v")}, maxes={"m": F.col("v")})
    want = df.select("*", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.max("v").over(w).alias("m"))
    assert got.exceptAll(want).isEmpty() and got.count() == 300


def test_previous_equals_lag(rows):
    df = log(rows, 2000)
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    want = df.select("*", F.lag("ok").over(w).alias("prev_ok"))
    got = ordered.with_previous(df, ["key"], ["ts", "event_id"], ["ok"])
    assert got.exceptAll(want).isEmpty()


def test_first_request_rolls_out(rows):
    data = [(i, START + timedelta(seconds=i), i != 0) for i in range(101)]
    got = telemetry.rolling_error_rate(rows(data, "event_id long, ts timestamp_ntz, ok boolean"))
    rates = {r["event_id"]: r["error_rate"] for r in got.collect()}
    assert rates[0] == 1.0 and rates[99] == 0.01 and rates[100] == 0.0


def test_quantile_worked_example(rows):
    df = rows([(1.5,)] * 40, "latency_s double")
    got = telemetry.with_quantiles(telemetry.histogram(df, "latency_s"), {"p99": 0.99, "p50": 0.5}).first()
    assert got["p99"] == pytest.approx(2.485) and got["p50"] == pytest.approx(1.75)


def test_quantile_edges(rows):
    none = telemetry.with_quantiles(telemetry.histogram(rows([], "latency_s double"), "latency_s"), {"p": 0.5}).first()
    assert none["p"] is None
    above = telemetry.with_quantiles(telemetry.histogram(rows([(9.0,)], "latency_s double"), "latency_s"), {"p": 0.5}).first()
    assert above["p"] == LATENCY_BOUNDS[-1]
    first = telemetry.with_quantiles(telemetry.histogram(rows([(0.001,)] * 2, "latency_s double"), "latency_s"), {"p": 0.5}).first()
    assert first["p"] == pytest.approx(0.005)


def test_counter_restart(rows):
    data = [(i, START + timedelta(minutes=i), "s", float(v)) for i, v in enumerate([5, 8, 3, 3, 10])]
    got = telemetry.counter_increase(rows(data, "sample_id long, ts timestamp_ntz, series string, value double"), ["series"])
    assert [r["increase"] for r in got.orderBy("sample_id").collect()] == [0.0, 3.0, 3.0, 0.0, 7.0]


def test_replace_and_merge_pushes(rows):
    data = [(1, START, "job", 1, "a", 1.0), (2, START + timedelta(1), "job", 1, "b", 2.0), (3, START + timedelta(2), "job", 2, "a", 3.0)]
    df = rows(data, "event_id long, ts timestamp_ntz, job string, push_id long, metric string, value double")
    assert {r["metric"]: r["value"] for r in telemetry.latest_gauges(df).collect()} == {"a": 3.0, "b": 2.0}
    assert {r["metric"]: r["value"] for r in telemetry.replaced_gauges(df).collect()} == {"a": 3.0}


def states_by_hand(active, hold):
    out, since = [], None
    for i, on in enumerate(active):
        since = None if not on else (i if since is None else since)
        out.append("inactive" if not on else ("firing" if i - since >= hold else "pending"))
    return out


@pytest.mark.parametrize("hold", [0, 15, 60])
def test_alert_states(rows, hold):
    r = random.Random(hold)
    active = [r.random() < 0.7 for _ in range(400)]
    df = rows([(i, a) for i, a in enumerate(active)], "tick_no long, flag boolean")
    states = alerts.alert_states(df, [alerts.AlertRule("A", F.col("flag"), hold, "warning")])
    got = [x["state"] for x in states.orderBy("tick_no").collect()]
    assert got == states_by_hand(active, -(-hold // 15))
    previous = [x["prev_state"] for x in states.orderBy("tick_no").collect()]
    assert previous == ["inactive", *got[:-1]]
    held = alerts.hold_states(df.withColumn("active", F.col("flag")), [], "tick_no", F.lit(-(-hold // 15)))
    assert [x["state"] for x in held.orderBy("tick_no").collect()] == got


def test_missing_signal_is_not_active(rows):
    df = rows([(0, None), (1, 0.5)], "tick_no long, v double")
    states = alerts.alert_states(df, [alerts.AlertRule("A", F.col("v") < 0.7, 0, "warning")])
    assert [x["state"] for x in states.orderBy("tick_no").collect()] == ["inactive", "firing"]


def test_notices(rows):
    df = rows([("A", "warning", 100, 100, 225), ("B", "warning", 100, 100, 101), ("C", "critical", 100, 100, None)],
              "alertname string, severity string, since long, firing_from long, resolved_at long")
    got = {}
    # the log ends at tick 400 for what is resolved, at tick 200 for what still fires
    ended, open_ = df.where("resolved_at IS NOT NULL"), df.where("resolved_at IS NULL")
    for r in [*alerts.notices(ended, end_tick=F.lit(400)).collect(), *alerts.notices(open_, end_tick=F.lit(200)).collect()]:
        got.setdefault(r["alertname"], []).append((r["kind"], r["at_seconds"] - 1500))
    # A fires for 1875 s: notices after 30, 930 and 1830 s; resolved at the next five-minute mark
    assert sorted(got["A"], key=lambda x: x[1]) == [("firing", 30), ("firing", 930), ("firing", 1830), ("resolved", 2130)]
    assert "B" not in got
    assert sorted(got["C"], key=lambda x: x[1]) == [("firing", 30), ("firing", 930)]


def test_inhibition(rows):
    df = rows([("A", "critical"), ("A", "warning"), ("B", "warning")], "alertname string, severity string")
    assert {tuple(r) for r in alerts.inhibit(df).collect()} == {("A", "critical"), ("B", "warning")}


def test_early_stop(rows):
    data = [("r", e, f) for e, f in enumerate([0.0, 0.5, 0.4, 0.5, 0.3, 0.9], start=1)]
    history = rows(data, "run_id string, epoch int, val_f1 double")
    assert runs.stop_epoch(history).first()["stop_epoch"] == 5
    assert runs.best_epoch(history).first()["epoch"] == 6
    assert runs.best_epoch(rows([("z", 1, 0.0)], "run_id string, epoch int, val_f1 double")).isEmpty()


def test_latest_version_is_numeric(rows):
    assert runs.latest_version(rows([("m", "9"), ("m", "10")], "name string, version string")).first()["version"] == "10"


def test_hot_group_latest_n(spark):
    df = spark.range(20_000).select(F.col("id").alias("run_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("g"), (F.col("id") % 100).alias("t"))
    w = Window.partitionBy("g").orderBy(F.desc("t"), "run_id")
    want = df.withColumn("rank", F.row_number().over(w)).where("rank <= 10")
    assert runs.latest_n_per_group(df, "g", "t", "run_id", 10).select(want.columns).exceptAll(want).isEmpty()


# --- Statements -------------------------------------------------------------
STATEMENT = """Statement of account,,,,
01/01/24,"not a row yet",,5.00,
Date,Narration,Ref,Withdrawal Amt.,Deposit Amt.
01/01/24,"UPI/ZOMATO, MUMBAI/9148",1,250.50,
02/01/24,SALARY,2,,50000
03/01/24,TOLL PLAZA,3,"1,200.00",
4/1/2024,NEFT RENT,4,9000,
Total,,,9250.50,50000
"""


def test_statement_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(STATEMENT)
    (tmp_path / "b.csv").write_text("nothing,here\n1,2\n")
    lines = read_statement_lines(spark, str(tmp_path))
    got = sorted((r["description"], r["amount"]) for r in debit_rows(statement_rows(lines)).collect())
    assert got == [("RENT", 9000.0), ("ZOMATO, MUMBAI/9148", 250.5)]
    commas = debit_rows(statement_rows(lines), commas=True)
    assert {r["description"]: r["amount"] for r in commas.collect()}["LL PLAZA"] == 1200.0
    assert [r["reason"] for r in headerless_files(lines).collect()] == ["no narration column"]


def test_statement_cut_into_many_splits(spark, tmp_path):
    body = "".join(f"01/01/24,SHOP {i},x,{i}.00,\n" for i in range(3000))
    (tmp_path / "big.csv").write_text("01/01/24,SHOP before,x,7.00,\n" * 200 + "Date,Narration,Ref,Withdrawal Amt.,D\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = debit_rows(statement_rows(read_statement_lines(spark, str(tmp_path))))
        assert got.count() == 3000 and got.where("description = 'SHOP before'").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_resolve_columns():
    assert resolve_columns([" Date", "NARRATION", "Withdrawal Amt."]) == {"narration": "NARRATION", "withdrawal": "Withdrawal Amt.", "date": " Date"}
    assert resolve_columns(["When", "Narration", "Withdrawal"])["date"] == "When"
    with pytest.raises(ValueError):
        resolve_columns(["Date", "Withdrawal"])
    with pytest.raises(ValueError):
        resolve_columns(["Date", "Narration"])


# --- Streams over several batches -------------------------------------------
def in_files(df, path, order, files=4):
    """The table cut into several files along `order`, so that a stream takes several batches."""
    for i, part in enumerate(df.withColumn("_f", F.ntile(files).over(Window.orderBy(order))).select("_f").distinct().orderBy("_f").collect()):
        df.withColumn("_f", F.ntile(files).over(Window.orderBy(order))).where(F.col("_f") == part["_f"]).drop("_f").coalesce(1).write.mode("append").parquet(path)


def test_rolling_rate_stream(spark, rows, tmp_path):
    df = log(rows, 1200).withColumn("event_id", F.row_number().over(Window.orderBy("ts", "event_id")).cast("long"))
    in_files(df, str(tmp_path / "in"), "event_id")
    stream = stream_parquet(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    stream_telemetry.start_rolling_error_rate(stream, ["key"], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r["key"]: r["error_rate"] for r in stream_telemetry.latest_rates(spark, str(tmp_path / "out"), ["key"]).collect()}
    w = Window.partitionBy("key").orderBy(F.desc("ts"), F.desc("event_id"))
    last = df.withColumn("rn", F.row_number().over(w)).where("rn <= 100").groupBy("key").agg(F.avg(F.when(F.col("ok"), 0).otherwise(1)).alias("r"))
    assert got == pytest.approx({r["key"]: r["r"] for r in last.collect()})
    assert spark.read.parquet(str(tmp_path / "out" / "rates")).select("batch_id").distinct().count() == 4


def test_alert_stream_over_batches(spark, rows, tmp_path):
    r = random.Random(5)
    active = [r.random() < 0.8 for _ in range(300)]
    conditions = rows([(i, "A", "warning", 60, a) for i, a in enumerate(active)], "tick_no long, alertname string, severity string, hold_seconds long, active boolean")
    in_files(conditions, str(tmp_path / "in"), "tick_no", 3)
    stream = stream_parquet(spark, str(tmp_path / "in"), conditions.schema, files_per_batch=1)
    start_table(stream_alerts.alert_transition_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = sorted((x["tick_no"], x["state"]) for x in read_batches(spark, str(tmp_path / "out")).collect())
    states = states_by_hand(active, 4)
    want = []
    for i, state in enumerate(states):
        before = states[i - 1] if i else "inactive"
        if state != before:
            want.append((i, "resolved" if (before, state) == ("firing", "inactive") else state))
    assert got == want


def test_parts_are_even_when_one_second_holds_most_rows(spark):
    """Nine in ten rows of one series share a second, yet no part has many more than its share."""
    df = spark.range(20_000).selectExpr(
        "id AS event_id", "IF(id % 10 < 9, 'hot', concat('k', id % 70)) AS key",
        "IF(id % 10 < 9, timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)) AS ts")
    got = ordered.with_position(df, ["key"], ["ts", "event_id"])
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    assert got.exceptAll(df.select("*", F.row_number().over(w).cast("long").alias("pos"))).isEmpty()
    parts = df.repartitionByRange(8, "key", "ts", "event_id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 2 * 20_000 / 8


def test_open_silence_and_open_stretch(rows):
    events = rows([(1, START), (2, START + timedelta(days=2))], "event_id long, ts timestamp_ntz")
    now = F.lit(START + timedelta(days=6)).cast("timestamp_ntz")
    got = telemetry.silence_gaps(events, now=now).orderBy("silent_from").collect()
    assert [(r["open"], r["gap_seconds"] / 86400, r["alerted"]) for r in got] == [(False, 2.0, False), (True, 4.0, True)]
    df = rows([("C", "critical", 100, 100, None)], "alertname string, severity string, since long, firing_from long, resolved_at long")
    sent = [r["at_seconds"] - 1500 for r in alerts.notices(df, end_tick=F.lit(250)).collect()]
    assert sorted(sent) == [30, 930, 1830]


def test_a_broken_line_widens_no_other(rows):
    from ledgerlens.sources.statements import with_cells

    data = [("f", 1, 'a,"b, ""c""", d ,'), ("f", 2, "x" + "," * 5000), ("f", 3, "")]
    got = [r["cells"] for r in with_cells(rows(data, "file string, line_order long, line string")).orderBy("line_order").collect()]
    assert got[0] == ["a", 'b, "c"', "d", ""] and len(got[1]) == 5001 and got[2] == [""]
