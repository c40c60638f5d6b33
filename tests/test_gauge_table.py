"""The gauge table against a dictionary."""

import random
from datetime import datetime, timedelta

from ledgerlens.sinks.gauge_table import GaugeTable

START = datetime(2024, 1, 1)
SCHEMA = "job string, metric string, value double, push_id long, ts timestamp_ntz, event_id long"


def pushes(seed, version):
    """Some pushes of several jobs, with nulls, repeated metrics and equal times."""
    draw, rows = random.Random(f"{seed}-{version}"), []
    for k in range(3):
        job = draw.choice(["a", "b", "c", None])
        for _ in range(draw.randrange(1, 4)):
            n = len(rows)
            rows.append((job, draw.choice(["x", "y", "z"]), draw.choice([None, 1.0, 2.0, 3.0]), version * 10 + k, START + timedelta(seconds=draw.randrange(3)), n))
    return rows


def apply(state, rows, mode):
    if mode == "replace":
        for job in {r[0] for r in rows}:
            last = max(r[3] for r in rows if r[0] == job)
            state[job] = {}
            rows = [r for r in rows if r[0] != job or r[3] == last]
    for job, metric, value, push, ts, event in sorted(rows, key=lambda r: (r[4], r[5])):
        if metric is not None and (mode == "replace" or value is not None):
            state.setdefault(job, {})[metric] = value


def gauges(table):
    return {(r["job"], r["metric"], r["value"]) for r in table.read().collect()}


def test_merges_and_replacements_with_compactions(spark, tmp_path):
    table, state, draw = GaugeTable(spark, str(tmp_path / "g"), buckets=3), {}, random.Random(3)
    assert gauges(table) == set() and table.compact() == []
    for version in range(8):
        rows, mode = pushes(1, version), draw.choice(["merge", "replace"])
        if version == 5:
            rows, mode = [("a", None, None, 1, START, 0)], "replace"
        table.push(spark.createDataFrame(rows, SCHEMA), version, mode)
        if version % 3 == 0:  # a push that is run again changes nothing
            table.push(spark.createDataFrame(rows, SCHEMA), version, mode)
        apply(state, rows, mode)
        if version in (2, 6):
            before = gauges(table)
            table.compact()
            assert gauges(table) == before and table.compact() == []
        assert gauges(table) == {(j, m, v) for j, kept in state.items() for m, v in kept.items()}


def test_compaction_leaves_other_buckets(spark, tmp_path):
    table = GaugeTable(spark, str(tmp_path / "g"), buckets=64)
    rows = [(f"job{i}", "x", float(i), 0, START, i) for i in range(20)]
    table.push(spark.createDataFrame(rows, SCHEMA), 0)
    assert len(table.compact()) > 5
    table.push(spark.createDataFrame(rows[:1], SCHEMA), 1)
    assert len(table.compact()) == 1
    assert gauges(table) == {(j, m, v) for j, m, v, *_ in rows}


def test_what_is_not_committed_is_not_read(spark, tmp_path):
    table = GaugeTable(spark, str(tmp_path / "g"))
    table.push(spark.createDataFrame([("a", "x", 1.0, 0, START, 0)], SCHEMA), 0)
    table._commit = lambda *_: None  # the writer dies before its last step
    table.push(spark.createDataFrame([("a", "x", 2.0, 0, START, 0)], SCHEMA), 1)
    table.compact()
    assert gauges(GaugeTable(spark, table.path)) == {("a", "x", 1.0)}
