"""Notification groups and inhibition against the rule, moment by moment."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import notify

SCHEMA = "alertname string, severity string, member string, fires_at long, ends_at long"


def fires(rows, name, severity, at):
    return {m for n, s, m, a, b in rows if (n, s) == (name, severity) and a <= at and (b is None or b > at)}


def by_rule(rows, end, wait=30, interval=300, repeat=900):
    """One second after the other: the flushes of every group and what they send."""
    sent = []
    for name, severity in {(r[0], r[1]) for r in rows}:
        flush, named, last = None, set(), None
        for at in range(end):
            firing = fires(rows, name, severity, at)
            if flush is None and any((n, s, a) == (name, severity, at) for n, s, _, a, _ in rows):
                flush = at + wait
            if at != flush:
                continue
            shown = set() if severity == "warning" and fires(rows, name, "critical", at) else firing
            gone = named - firing
            if shown - named or gone or shown and last is not None and at - last >= repeat:
                sent.append((name, severity, at, "firing" if shown else "resolved", tuple(sorted(shown)), tuple(sorted(gone))))
                named, last = shown, at
            flush = flush + interval if firing else None
            if not firing:
                named, last = set(), None
    return sorted(sent)


def by_operator(spark, rows, end, **times):
    stretches = spark.createDataFrame(rows, SCHEMA).repartition(3)
    hidden = notify.inhibited_time(stretches, F.lit(end), bucket=200)
    made = notify.group_notices(stretches, F.lit(end), hidden, **times).collect()
    return sorted((r["alertname"], r["severity"], r["at_seconds"], r["kind"], tuple(r["firing"]), tuple(r["resolved"])) for r in made)


def drawn(seed, n=60, end=9000):
    """Stretches of several members that do not overlap within a member; one still fires."""
    draw, rows = random.Random(seed), []
    for name in "AB":
        for severity in ("warning", "critical"):
            for member in ("x", "y", ""):
                at = draw.randrange(1500)
                for _ in range(n // 12):
                    upto = at + draw.choice([5, 40, 250, 900, 2000])
                    rows.append((name, severity, member, at, upto))
                    at = upto + draw.choice([1, 100, 280, 700, 3000])
    rows.append(("A", "warning", "late", 8000, None))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_groups_against_the_rule(spark, seed):
    rows = drawn(seed)
    assert by_operator(spark, rows, 9000) == by_rule(rows, 9000)


def test_a_short_pause_is_no_change(spark):
    """Stops and fires again between two flushes: one group, one notice, one resolved."""
    rows = [("A", "warning", "", 0, 400), ("A", "warning", "", 450, 700)]
    assert [(r[2], r[3]) for r in by_operator(spark, rows, 5000)] == [(30, "firing"), (930, "resolved")]


def test_long_pause_is_a_new_group(spark):
    rows = [("A", "warning", "", 0, 100), ("A", "warning", "", 1000, 1100)]
    assert [(r[2], r[3]) for r in by_operator(spark, rows, 5000)] == [(30, "firing"), (330, "resolved"), (1030, "firing"), (1330, "resolved")]


def test_repeats_while_nothing_changes(spark):
    got = [(r[2], r[3]) for r in by_operator(spark, [("A", "warning", "", 0, None)], 2000)]
    assert got == [(30, "firing"), (930, "firing"), (1830, "firing")]


def test_nothing_for_what_ends_within_the_wait(spark):
    assert by_operator(spark, [("A", "warning", "", 0, 20)], 2000) == []


def test_inhibited_warnings_are_silent(spark):
    rows = [("A", "warning", "w", 0, 2000), ("A", "critical", "c", 100, 1000), ("B", "warning", "w", 0, 500)]
    got = by_operator(spark, rows, 4000)
    assert got == by_rule(rows, 4000)
    assert not [r for r in got if r[:2] == ("A", "warning") and 100 <= r[2] < 1000]


def test_empty(spark):
    assert by_operator(spark, [], 1000) == []


@pytest.mark.parametrize("on", [("alertname",), ("alertname", "member")])
def test_shown_time_second_by_second(spark, on):
    rows = drawn(9)
    labels = ["alertname", "severity", "member"]
    left = notify.shown_time(spark.createDataFrame(rows, SCHEMA), F.lit(9000), on, labels, bucket=170).collect()
    got = {(r["alertname"], r["severity"], r["member"], s) for r in left for s in range(r["fires_at"], r["ends_at"])}
    at = [labels.index(c) for c in on]
    hidden = {(*[r[i] for i in at], s) for r in rows if r[1] == "critical" for s in range(r[3], r[4] or 9000)}
    want = {(*r[:3], s) for r in rows for s in range(r[3], min(r[4] or 9000, 9000)) if r[1] != "warning" or (*[r[i] for i in at], s) not in hidden}
    assert {g for g in got if g[3] < 9000} == want
    pieces = sorted((r["alertname"], r["severity"], r["member"], r["fires_at"], r["ends_at"]) for r in left)
    assert all(a[:3] != b[:3] or a[4] < b[3] for a, b in zip(pieces, pieces[1:]))


def test_joined_stretches(spark):
    rows = [("A", "s", "m", 0, 10), ("A", "s", "m", 5, 7), ("A", "s", "m", 10, 12), ("A", "s", "m", 14, 15), ("A", "s", "m", 20, None), ("A", "s", "m", 25, 26), ("A", "s", None, 3, 4)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = lambda gap: sorted((r["member"] or "", r["fires_at"], r["ends_at"]) for r in notify.joined_stretches(table, ["alertname", "member"], gap).collect())
    assert got(0) == [("", 3, 4), ("m", 0, 12), ("m", 14, 15), ("m", 20, None)]
    assert got(2) == [("", 3, 4), ("m", 0, 15), ("m", 20, None)]
