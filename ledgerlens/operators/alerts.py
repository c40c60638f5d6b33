"""Alert rules over regular ticks: signals, hold times, notices, inhibition.

Rules are boolean column expressions over one row of signals per tick. All
event-sized work is reduced to panes of one tick first; what follows is as
large as the observed time span divided by the tick, never as the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.config import F1_GATE, LATENCY_BOUNDS
from ledgerlens.functions.numbers import epoch_micros, from_micros
from ledgerlens.operators.notify import group_notices, inhibited_time
from ledgerlens.operators.ordered import running, with_previous
from ledgerlens.operators.sizing import one_row, written
from ledgerlens.operators.telemetry import DAY, HOUR, SECOND, quantile_of_buckets, rolling_error_rate

TICK_SECONDS = 15
GAUGES = (
    "model_loaded", "up", "test_f1_macro", "training_val_f1",
    "training_duration_seconds", "pipeline_drift_detected", "pipeline_ingest_success",
)


@dataclass(frozen=True)
class AlertRule:
    """A condition over the signal columns, and how long it must hold."""

    name: str
    condition: Column
    hold_seconds: int
    severity: str


def default_rules() -> list[AlertRule]:
    """The eleven service rules. Names, limits and hold times are fixed values."""
    c = F.col
    down = (c("model_loaded") == 0) | (c("up") == 0)
    return [
        AlertRule("HighErrorRate", c("error_rate") > 0.05, 120, "warning"),
        AlertRule("ModelNotLoaded", down, 60, "critical"),
        AlertRule("HighPredictionLatency", c("latency_p95") > 0.5, 300, "warning"),
        AlertRule("LowTestF1", c("test_f1_macro") < F1_GATE, 0, "critical"),
        AlertRule("LowValF1", c("training_val_f1") < 0.65, 0, "warning"),
        AlertRule("TrainingDurationHigh", c("training_duration_seconds") > 7200, 0, "warning"),
        AlertRule("DataDriftDetected", c("pipeline_drift_detected") == 1, 0, "warning"),
        AlertRule("IngestFailed", c("pipeline_ingest_success") == 0, 0, "critical"),
        AlertRule("FeedbackLoopDead", c("feedback_24h") == 0, 48 * HOUR, "warning"),
        AlertRule("TailLatencySpike", c("latency_p99") > 1.0, 300, "warning"),
        AlertRule("FrequentModelSwitch", c("model_switches_1h") > 3, 0, "warning"),
    ]


def tick_number(ts: Column, step: int = TICK_SECONDS) -> Column:
    """The first tick at or after a timestamp."""
    return F.ceil(epoch_micros(ts) / F.lit(step * SECOND)).cast("long")


def tick_spine(ends: DataFrame, step: int = TICK_SECONDS) -> DataFrame:
    """Every tick number from `lo` to `hi` of a one-row table, made day by day."""
    per_day = DAY // step
    days = ends.where("lo IS NOT NULL").select("lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / per_day), F.floor(F.col("hi") / per_day))).alias("day"))
    return days.select(F.explode(F.sequence(
        F.greatest("lo", F.col("day") * per_day),
        F.least("hi", F.col("day") * per_day + (per_day - 1)))).alias("tick_no"))


def service_signals(requests: DataFrame, pushes: DataFrame, step: int = TICK_SECONDS,
                    bounds: Sequence[float] = LATENCY_BOUNDS, gauges: Sequence[str] = GAUGES) -> DataFrame:
    """One row of signals per tick.

    `requests` has ts, event_id, endpoint, ok, latency_s, is_feedback,
    is_switch; `pushes` has ts, event_id, metric, value. Ranges are differences
    of running totals between two ticks, so a 24-hour range costs one equi-join
    of ticks. A gauge keeps its last pushed value.
    """
    n = len(bounds)
    tick = tick_number(F.col("ts"), step)
    timed = F.when(F.col("endpoint") == "/predict", F.col("latency_s"))
    request_panes = requests.groupBy(tick.alias("tick_no")).agg(
        *[F.count_if(timed <= b).alias(f"c{i}") for i, b in enumerate(bounds)],
        F.count(timed).alias("total"),
        F.count_if("is_feedback").alias("feedback"),
        F.count_if("is_switch").alias("switches"),
    )
    rates = rolling_error_rate(requests.where("NOT is_feedback").select("ts", "event_id", "ok")).groupBy(
        tick.alias("tick_no")).agg(F.max_by("error_rate", F.struct("ts", "event_id")).alias("error_rate"))
    gauge_panes = pushes.where(F.col("metric").isin(list(gauges))).groupBy(tick.alias("tick_no"), "metric").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("value")
    ).select("tick_no", *[F.when(F.col("metric") == g, F.col("value")).alias(g) for g in gauges])
    times = requests.select("ts").unionByName(pushes.select("ts"))
    ends = one_row(times.agg(tick_number(F.min("ts"), step).alias("lo"), tick_number(F.max("ts"), step).alias("hi")))

    counted = [*[f"c{i}" for i in range(n)], "total", "feedback", "switches"]
    held = ["error_rate", *gauges]
    cells = tick_spine(ends, step)
    for part in (request_panes, rates, gauge_panes):
        cells = cells.unionByName(part, allowMissingColumns=True)
    panes = written(cells.groupBy("tick_no").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"p_{c}") for c in counted],
        # a tick has at most one value per gauge here
        *[F.max(g).alias(f"p_{g}") for g in held],
    ), "panes")
    totals = written(
        running(
            panes, [], ["tick_no"],
            sums={c: F.col(f"p_{c}") for c in counted},
            lasts={g: F.col(f"p_{g}") for g in held},
        ).select("tick_no", *counted, *held),
        "totals",
    )

    def earlier(columns: Sequence[str], seconds: int, tag: str) -> DataFrame:
        return totals.select((F.col("tick_no") + seconds // step).alias("tick_no"), *[F.col(c).alias(f"{tag}_{c}") for c in columns])

    def grown(column: str, tag: str) -> Column:
        return F.col(column) - F.coalesce(f"{tag}_{column}", F.lit(0))

    buckets = [f"c{i}" for i in range(n)]
    joined = (
        totals.join(earlier([*buckets, "total"], 300, "m5"), "tick_no", "left")
        .join(earlier(["switches"], HOUR, "h1"), "tick_no", "left")
        .join(earlier(["feedback"], DAY, "d1"), "tick_no", "left")
    )
    in_range = [grown(b, "m5") for b in buckets]
    return joined.select(
        "tick_no",
        *held,
        quantile_of_buckets(0.95, bounds, in_range, grown("total", "m5")).alias("latency_p95"),
        quantile_of_buckets(0.99, bounds, in_range, grown("total", "m5")).alias("latency_p99"),
        grown("switches", "h1").alias("model_switches_1h"),
        grown("feedback", "d1").alias("feedback_24h"),
    )


def rule_conditions(signals: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """(tick_no, alertname, severity, hold_seconds, active); a missing signal is not active."""
    cells = [
        F.struct(F.lit(r.name).alias("alertname"), F.lit(r.severity).alias("severity"),
                 F.lit(r.hold_seconds).cast("long").alias("hold_seconds"),
                 F.coalesce(r.condition, F.lit(False)).alias("active"))
        for r in rules
    ]
    return signals.select("tick_no", F.explode(F.array(*cells)).alias("x")).select("tick_no", "x.*")


def hold_states(conditions: DataFrame, keys: Sequence[str], order: str, hold: Column,
                active: str = "active") -> DataFrame:
    """Add `since`, `state` and `prev_state` for a condition that must hold without a break.

    `order` is a number unique per series; `hold` is in the same unit. States
    are inactive, pending and firing; `since` is the start of the latest
    active stretch.
    """
    prev = with_previous(conditions, keys, [order], [order, active])
    began = F.when(F.col(active) & ~F.coalesce(F.col(f"prev_{active}"), F.lit(False)), F.col(order))
    out = running(prev, keys, [order], maxes={"since": began})

    def state(on: Column, at: Column) -> Column:
        return F.when(~F.coalesce(on, F.lit(False)), "inactive").when(at - F.col("since") >= hold, "firing").otherwise("pending")

    return (
        out.withColumn("state", state(F.col(active), F.col(order)))
        .withColumn("prev_state", state(F.col(f"prev_{active}"), F.col(f"prev_{order}")))
        .drop(f"prev_{active}", f"prev_{order}")
    )


def alert_states(signals: DataFrame, rules: Sequence[AlertRule], step: int = TICK_SECONDS) -> DataFrame:
    """State of every rule at every tick of a gapless tick series.

    With gapless ticks the last inactive tick before a row tells all: when the
    active stretch began and what the state one tick earlier was. All rules
    share one window over the ticks and are spread into rows afterwards.
    """
    wide = written(signals.select("tick_no", *[
        F.coalesce(r.condition, F.lit(False)).alias(f"on{i}") for i, r in enumerate(rules)]), "conditions")
    start = wide.agg(F.min("tick_no")).scalar()
    marked = running(
        wide, [], ["tick_no"],
        maxes={f"off{i}": F.when(~F.col(f"on{i}"), F.col("tick_no")) for i in range(len(rules))},
        include_current=False,
    ).withColumn("_start", start)
    cells = [
        F.struct(F.lit(r.name).alias("alertname"), F.lit(r.severity).alias("severity"),
                 F.lit(-(-r.hold_seconds // step)).cast("long").alias("hold"),
                 F.col(f"on{i}").alias("active"),
                 (F.coalesce(f"off{i}", F.col("_start") - 1) + 1).alias("began"))
        for i, r in enumerate(rules)
    ]
    rows = marked.select("tick_no", F.explode(F.array(*cells)).alias("x")).select("tick_no", "x.*")
    before = F.col("tick_no") - 1

    def state(on: Column, at: Column) -> Column:
        return F.when(~on, "inactive").when(at - F.col("began") >= F.col("hold"), "firing").otherwise("pending")

    return rows.select(
        "alertname", "severity", "tick_no", "active",
        F.when(F.col("active"), F.col("began")).alias("since"),
        state(F.col("active"), F.col("tick_no")).alias("state"),
        # `began` is this very tick when the tick before was inactive or missing
        state(F.col("began") <= before, before).alias("prev_state"),
    )


def alert_transitions(states: DataFrame) -> DataFrame:
    """Ticks at which an alert changes state; leaving `firing` reads as `resolved`."""
    shown = F.when((F.col("state") == "inactive") & (F.col("prev_state") == "firing"), "resolved").otherwise(F.col("state"))
    return states.where(F.col("state") != F.col("prev_state")).select("alertname", "severity", "tick_no", shown.alias("state"))


def firing_intervals(states: DataFrame) -> DataFrame:
    """(alertname, severity, since, firing_from, resolved_at) in tick numbers.

    `resolved_at` is null for an alert that still fires at the last tick.
    """
    end = states.agg(F.max("tick_no")).scalar()
    stretches = states.where("active").groupBy("alertname", "severity", "since").agg(
        F.min(F.when(F.col("state") == "firing", F.col("tick_no"))).alias("firing_from"),
        F.max("tick_no").alias("_last"),
    )
    return stretches.where("firing_from IS NOT NULL").withColumn("_end", end).select(
        "alertname", "severity", "since", "firing_from",
        F.when(F.col("_last") < F.col("_end"), F.col("_last") + 1).alias("resolved_at"))


def firing_counts(states: DataFrame, ticks_per_range: int) -> DataFrame:
    """Firing ticks per alert and range."""
    return states.where("state = 'firing'").groupBy(
        "alertname", F.floor(F.col("tick_no") / ticks_per_range).alias("range_no")).agg(F.count("*").alias("n"))


def now_firing(states: DataFrame) -> DataFrame:
    """Alerts firing at the last tick, latest start first."""
    end = states.agg(F.max("tick_no")).scalar()
    return (
        states.withColumn("_end", end).where((F.col("tick_no") == F.col("_end")) & (F.col("state") == "firing"))
        .select("alertname", "severity", "since").orderBy(F.desc("since"), "alertname")
    )


def inhibit(firing: DataFrame, on: Sequence[str] = ("alertname",)) -> DataFrame:
    """Drop warnings for which a critical alert of the same name fires."""
    critical = firing.where("severity = 'critical'").select(*on).distinct()
    warnings = firing.where("severity = 'warning'").join(critical, list(on), "left_anti").select(*firing.columns)
    return firing.where("severity <> 'warning'").unionByName(warnings)


def notice_stretches(intervals: DataFrame, step: int = TICK_SECONDS) -> DataFrame:
    """Firing intervals of ticks as stretches of seconds, for `operators.notify`."""
    return intervals.select(
        "alertname", "severity", F.lit("").alias("member"), (F.col("firing_from") * step).alias("fires_at"),
        (F.col("resolved_at") * step).cast("long").alias("ends_at"))


def notices(intervals: DataFrame, step: int = TICK_SECONDS, wait: int = 30, interval: int = 300, repeat: int = 900,
            *, end_tick: Column) -> DataFrame:
    """(alertname, severity, kind, at_seconds): what is sent for the firing intervals of alerts without labels.

    Each alert is a group with one member; see `operators.notify.group_notices`. Warnings
    are silent while a critical alert of the same name fires. Seconds count from 1970 and
    go up to `end_tick`, the last tick evaluated.
    """
    end = F.lit(intervals.sparkSession.range(1).select(((end_tick + 1) * step).cast("long")).first()[0])
    stretches = written(notice_stretches(intervals, step), "stretches")
    sent = group_notices(stretches, end, inhibited_time(stretches, end), wait=wait, interval=interval, repeat=repeat)
    return sent.select("alertname", "severity", "kind", "at_seconds")


def tick_time(tick_no: Column, step: int = TICK_SECONDS) -> Column:
    return from_micros(tick_no * F.lit(step * SECOND))
