"""Telemetry, alerts and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.bindings import (
    HISTORY, PUSHES, REQUESTS, RUNS, SAMPLES, counter_samples, history, pushes, requests, runs,
)
from ledgerlens.catalog.registry import query
from ledgerlens.config import BATCH_SIZE_BOUNDS, LATENCY_BOUNDS
from ledgerlens.operators import alerts, notify, runs as run_ops, telemetry
from ledgerlens.operators.sizing import written

DAY_TICKS = telemetry.DAY // alerts.TICK_SECONDS


def bucket_sql(value: str, bounds=LATENCY_BOUNDS) -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE {value} <= {b!r}::DOUBLE) AS c{i}" for i, b in enumerate(bounds))
    return f"{cells}, count({value}) AS total"


def quantile_sql(q: float, name: str, bounds=LATENCY_BOUNDS, total: str = "total", c: str = "c") -> str:
    cases = []
    for i, bound in enumerate(bounds):
        low, below = (repr(float(bounds[i - 1])), f"{c}{i - 1}") if i else ("0.0", "0")
        cases.append(f"WHEN {c}{i} >= {q!r}::DOUBLE * {total} THEN {low}::DOUBLE + ({float(bound)!r}::DOUBLE - {low}::DOUBLE) * "
                     f"(({q!r}::DOUBLE * {total} - {below})::DOUBLE / nullif({c}{i} - {below}, 0)::DOUBLE)")
    return f"CASE WHEN {total} > 0 THEN CASE {' '.join(cases)} ELSE {float(bounds[-1])!r}::DOUBLE END END AS {name}"


# --- Counters and histograms ------------------------------------------------
@query("request_counters", "A19", f"WITH {REQUESTS} SELECT endpoint, status, count(*) AS n FROM requests GROUP BY 1, 2")
def request_counters(t):
    return telemetry.counters(requests(t), ["endpoint", "status"])


@query("request_counters_per_minute", "T2, A19", f"""
WITH {REQUESTS} SELECT date_trunc('minute', ts) AS window_start, endpoint, status, count(*) AS n FROM requests GROUP BY 1, 2, 3""")
def request_counters_per_minute(t):
    return telemetry.windowed_counters(requests(t), ["endpoint", "status"])


def long_sql(bounds, by="endpoint"):
    lead = f"{by}, " if by else ""
    rows = " UNION ALL ".join(f"SELECT {lead}{b!r}::DOUBLE AS le, c{i} AS cumulative FROM h" for i, b in enumerate(bounds))
    return f"{rows} UNION ALL SELECT {lead}NULL, total FROM h"


@query("latency_histogram", "A20", f"""
WITH {REQUESTS}, h AS (SELECT endpoint, {bucket_sql('latency_s')} FROM requests GROUP BY endpoint) {long_sql(LATENCY_BOUNDS)}""")
def latency_histogram(t):
    return telemetry.histogram_long(telemetry.histogram(requests(t), "latency_s", LATENCY_BOUNDS, ["endpoint"]))


@query("batch_size_histogram", "A20", f"""
WITH {REQUESTS}, h AS (SELECT {bucket_sql('batch_size', BATCH_SIZE_BOUNDS)} FROM requests WHERE endpoint = '/predict/batch')
{long_sql(BATCH_SIZE_BOUNDS, '')}""")
def batch_size_histogram(t):
    batches = requests(t).where("endpoint = '/predict/batch'")
    return telemetry.histogram_long(telemetry.histogram(batches, "batch_size", BATCH_SIZE_BOUNDS), BATCH_SIZE_BOUNDS)


@query("latency_histogram_per_hour", "T3", f"""
WITH {REQUESTS} SELECT date_trunc('hour', ts) AS window_start, endpoint, {bucket_sql('latency_s')}, round(sum(latency_s), 6) AS value_sum
FROM requests GROUP BY 1, 2""")
def latency_histogram_per_hour(t):
    found = telemetry.windowed_histogram(requests(t), "latency_s", LATENCY_BOUNDS, ["endpoint"], "1 hour")
    return found.withColumn("value_sum", F.round("value_sum", 6))


@query("latency_quantiles_by_endpoint", "T5", f"""
WITH {REQUESTS}, h AS (SELECT endpoint, {bucket_sql('latency_s')} FROM requests GROUP BY endpoint)
SELECT endpoint, {quantile_sql(0.5, 'p50')}, {quantile_sql(0.95, 'p95')}, {quantile_sql(0.99, 'p99')} FROM h""")
def latency_quantiles_by_endpoint(t):
    wide = telemetry.histogram(requests(t), "latency_s", LATENCY_BOUNDS, ["endpoint"])
    return telemetry.with_quantiles(wide, {"p50": 0.5, "p95": 0.95, "p99": 0.99}).select("endpoint", "p50", "p95", "p99")


SPREAD = f"""{REQUESTS}, ticks AS (
  SELECT *, (epoch_us(ts) + 14999999) // 15000000 + d.k AS tick_no FROM requests, (SELECT unnest(range(20)) AS k) d)"""


@query("request_rate", "T4", f"""
WITH {SPREAD} SELECT make_timestamp(tick_no * 15000000) AS tick, endpoint, count(*) AS n, count(*) / 300.0::DOUBLE AS per_second FROM ticks GROUP BY 1, 2""")
def request_rate(t):
    return telemetry.request_rate(requests(t), ["endpoint"])


@query("latency_quantiles_sliding", "T5, T4", f"""
WITH {SPREAD}, h AS (SELECT make_timestamp(tick_no * 15000000) AS tick, endpoint, {bucket_sql('latency_s')} FROM ticks GROUP BY 1, 2)
SELECT tick, endpoint, {quantile_sql(0.5, 'p50')}, {quantile_sql(0.95, 'p95')}, {quantile_sql(0.99, 'p99')} FROM h""")
def latency_quantiles_sliding(t):
    return telemetry.latency_quantiles(requests(t), "latency_s", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["endpoint"])


@query("error_share", "J7", f"WITH {REQUESTS} SELECT endpoint, avg(CAST(status <> '200' AS INT)) AS error_share FROM requests GROUP BY 1")
def error_share(t):
    return telemetry.error_share(requests(t), ["endpoint"])


@query("vector_match", "J7", f"""
WITH {PUSHES},
a AS (SELECT job, max_by(value, (ts, event_id)) AS value FROM pushes WHERE metric = 'model_loaded' GROUP BY job),
b AS (SELECT job, max_by(value, (ts, event_id)) AS value FROM pushes WHERE metric = 'up' GROUP BY job)
SELECT job, a.value * b.value AS value FROM a JOIN b USING (job)""")
def vector_match(t):
    gauges = telemetry.latest_gauges(pushes(t))
    return telemetry.vector_match(
        gauges.where("metric = 'model_loaded'").select("job", "value"), gauges.where("metric = 'up'").select("job", "value"), ["job"])


# --- Ordered series ---------------------------------------------------------
@query("rolling_error_rate", "W5, T7", f"""
WITH {REQUESTS} SELECT event_id, avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS error_rate FROM requests""")
def rolling_error_rate(t):
    return telemetry.rolling_error_rate(requests(t)).select("event_id", "error_rate")


@query("rolling_error_rate_by_endpoint", "W5, T7", f"""
WITH {REQUESTS} SELECT event_id, endpoint, avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS error_rate FROM requests""")
def rolling_error_rate_by_endpoint(t):
    return telemetry.rolling_error_rate(requests(t), ["endpoint"]).select("event_id", "endpoint", "error_rate")


GROWN = f"""{SAMPLES}, grown AS (
  SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS increase
  FROM samples WINDOW w AS (PARTITION BY series ORDER BY ts, sample_id))"""


@query("counter_increase", "W9", f"WITH {GROWN} SELECT sample_id, series, increase FROM grown")
def counter_increase(t):
    return telemetry.counter_increase(counter_samples(t), ["series"]).select("sample_id", "series", "increase")


@query("increase_per_hour", "T6, W9", f"WITH {GROWN} SELECT series, date_trunc('hour', ts) AS range_start, sum(increase) AS increase FROM grown GROUP BY 1, 2")
def increase_per_hour(t):
    return telemetry.increase_per_range(counter_samples(t), ["series"])


HELD = f"""{REQUESTS}, marked AS (
  SELECT user_id, epoch_us(ts) * 100 + event_id % 100 AS moment, latency_s > 0.3 AS active FROM requests),
f AS (SELECT *, lag(active) OVER w AS pa FROM marked WINDOW w AS (PARTITION BY user_id ORDER BY moment)),
g AS (SELECT *, max(CASE WHEN active AND NOT coalesce(pa, false) THEN moment END) OVER (PARTITION BY user_id ORDER BY moment) AS since FROM f)"""


@query("hold_states", "W10", f"""
WITH {HELD}
SELECT user_id, moment, coalesce(since, -1) AS since, CASE WHEN NOT active THEN 'inactive' WHEN moment - since >= 8640000000000 THEN 'firing' ELSE 'pending' END AS state FROM g""")
def hold_states(t):
    """Per user: slow requests in an unbroken row for a day."""
    from ledgerlens.functions.numbers import epoch_micros

    at = epoch_micros(F.col("ts")) * 100 + F.col("event_id") % 100
    rows = requests(t).select("user_id", at.alias("moment"), (F.col("latency_s") > 0.3).alias("active"))
    day = 86_400_000_000 * 100
    states = alerts.hold_states(rows, ["user_id"], "moment", F.lit(day))
    return states.select("user_id", "moment", F.coalesce("since", F.lit(-1)).alias("since"), "state")


@query("latest_gauges", "K5, T8, W11", f"""
WITH {PUSHES} SELECT job, metric, max_by(value, (ts, event_id)) AS value FROM pushes WHERE value IS NOT NULL GROUP BY 1, 2""")
def latest_gauges(t):
    return telemetry.latest_gauges(pushes(t))


@query("replaced_gauges", "K5", f"""
WITH {PUSHES}, last AS (SELECT job, max(push_id) AS push_id FROM pushes GROUP BY job)
SELECT job, metric, max_by(value, (ts, event_id)) AS value FROM pushes JOIN last USING (job, push_id) GROUP BY 1, 2""")
def replaced_gauges(t):
    return telemetry.replaced_gauges(pushes(t))


@query("silence_gaps", "T15", """
WITH e AS (SELECT ts, event_id FROM events WHERE value > 250),
g AS (SELECT lag(ts) OVER (ORDER BY ts, event_id) AS silent_from, ts AS silent_to, false AS open FROM e
      UNION ALL SELECT max(ts), (SELECT max(ts) + INTERVAL 3 DAY FROM events), true FROM e)
SELECT open, silent_from, silent_to, epoch_us(silent_to) / 1000000.0::DOUBLE - epoch_us(silent_from) / 1000000.0::DOUBLE AS gap_seconds,
       (epoch_us(silent_to) - epoch_us(silent_from)) >= 86400000000 + 21600000000 AS alerted
FROM g WHERE epoch_us(silent_to) - epoch_us(silent_from) > 86400000000""".replace(
    "epoch_us(silent_to) / 1000000.0::DOUBLE - epoch_us(silent_from) / 1000000.0::DOUBLE", "(epoch_us(silent_to) - epoch_us(silent_from)) / 1000000.0::DOUBLE"))
def silence_gaps(t):
    """Silences of a rare event type, the open one included, three days after the log's last event."""
    now = t.events.agg(F.max("ts") + F.expr("INTERVAL 3 DAYS")).scalar()
    return telemetry.silence_gaps(t.events.where("value > 250"), hold_seconds=6 * telemetry.HOUR, now=now)


# --- Alerts -----------------------------------------------------------------
_PANES = f"""
{REQUESTS}, {PUSHES},
req_panes AS (
  SELECT (epoch_us(ts) + 14999999) // 15000000 AS tick_no, {bucket_sql("lat")},
         count(*) FILTER (WHERE is_feedback) AS feedback, count(*) FILTER (WHERE is_switch) AS switches
  FROM (SELECT *, CASE WHEN endpoint = '/predict' THEN latency_s END AS lat FROM requests) GROUP BY 1),
rates AS (
  SELECT ts, event_id, avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS rate
  FROM requests WHERE NOT is_feedback),
rate_panes AS (SELECT (epoch_us(ts) + 14999999) // 15000000 AS tick_no, max_by(rate, (ts, event_id)) AS error_rate FROM rates GROUP BY 1),
gauge_panes AS (SELECT (epoch_us(ts) + 14999999) // 15000000 AS tick_no, {', '.join(
    f"max_by(value, (ts, event_id)) FILTER (WHERE metric = '{g}') AS {g}" for g in alerts.GAUGES)} FROM pushes GROUP BY 1),
spine AS (SELECT unnest(range(min(tick_no), max(tick_no) + 1)) AS tick_no FROM req_panes),
totals AS (
  SELECT tick_no, {', '.join(f"coalesce(sum(c{i}) OVER o, 0) AS s{i}" for i in range(len(LATENCY_BOUNDS)))},
         coalesce(sum(total) OVER o, 0) AS s_total, coalesce(sum(feedback) OVER o, 0) AS s_feedback, coalesce(sum(switches) OVER o, 0) AS s_switches,
         {', '.join(f"last_value({g} IGNORE NULLS) OVER o AS {g}" for g in ('error_rate', *alerts.GAUGES))}
  FROM spine LEFT JOIN req_panes USING (tick_no) LEFT JOIN rate_panes USING (tick_no) LEFT JOIN gauge_panes USING (tick_no)
  WINDOW o AS (ORDER BY tick_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ranges AS (
  SELECT t.tick_no, {', '.join(f"t.s{i} - coalesce(m.s{i}, 0) AS c{i}" for i in range(len(LATENCY_BOUNDS)))}, t.s_total - coalesce(m.s_total, 0) AS total,
         {', '.join(f"t.{g}" for g in ('error_rate', *alerts.GAUGES))},
         t.s_switches - coalesce(h.s_switches, 0) AS model_switches_1h, t.s_feedback - coalesce(d.s_feedback, 0) AS feedback_24h
  FROM totals t LEFT JOIN totals m ON m.tick_no = t.tick_no - 20 LEFT JOIN totals h ON h.tick_no = t.tick_no - 240 LEFT JOIN totals d ON d.tick_no = t.tick_no - 5760),
signals AS (SELECT *, {quantile_sql(0.95, 'latency_p95')}, {quantile_sql(0.99, 'latency_p99')} FROM ranges)"""

_RULES_SQL = [
    ("HighErrorRate", "error_rate > 0.05::DOUBLE", 120, "warning"), ("ModelNotLoaded", "model_loaded = 0 OR up = 0", 60, "critical"),
    ("HighPredictionLatency", "latency_p95 > 0.5::DOUBLE", 300, "warning"), ("LowTestF1", "test_f1_macro < 0.70::DOUBLE", 0, "critical"),
    ("LowValF1", "training_val_f1 < 0.65::DOUBLE", 0, "warning"), ("TrainingDurationHigh", "training_duration_seconds > 7200", 0, "warning"),
    ("DataDriftDetected", "pipeline_drift_detected = 1", 0, "warning"), ("IngestFailed", "pipeline_ingest_success = 0", 0, "critical"),
    ("FeedbackLoopDead", "feedback_24h = 0", 172800, "warning"), ("TailLatencySpike", "latency_p99 > 1.0::DOUBLE", 300, "warning"),
    ("FrequentModelSwitch", "model_switches_1h > 3", 0, "warning"),
]
ALERTS = f"""{_PANES},
conditions AS ({' UNION ALL '.join(
    f"SELECT tick_no, '{n}' AS alertname, '{s}' AS severity, {h} AS hold, coalesce({c}, false) AS active FROM signals" for n, c, h, s in _RULES_SQL)}),
edges AS (SELECT *, lag(active) OVER (PARTITION BY alertname ORDER BY tick_no) AS was FROM conditions),
held AS (SELECT *, max(CASE WHEN active AND NOT coalesce(was, false) THEN tick_no END) OVER (PARTITION BY alertname ORDER BY tick_no) AS since FROM edges),
states AS (SELECT *, CASE WHEN NOT active THEN 'inactive' WHEN (tick_no - since) * 15 >= hold THEN 'firing' ELSE 'pending' END AS state FROM held),
stretches AS (
  SELECT alertname, severity, since, min(tick_no) FILTER (WHERE state = 'firing') AS firing_from, max(tick_no) AS last_tick
  FROM states WHERE active GROUP BY 1, 2, 3),
intervals AS (
  SELECT alertname, severity, since, firing_from, CASE WHEN last_tick < (SELECT max(tick_no) FROM spine) THEN last_tick + 1 END AS resolved_at
  FROM stretches WHERE firing_from IS NOT NULL)"""


def signals(t):
    return alerts.service_signals(requests(t), pushes(t))


def states(t):
    return alerts.alert_states(signals(t), alerts.default_rules())


@query("service_signals", "T9, T5, T6, W11", f"""
WITH {_PANES} SELECT CAST(tick_no // 240 AS BIGINT) AS hour_no, count(*) AS n, max(error_rate) AS error_rate, round(max(latency_p95), 9) AS p95, round(max(latency_p99), 9) AS p99,
  CAST(max(model_switches_1h) AS BIGINT) AS switches, CAST(min(feedback_24h) AS BIGINT) AS feedback, min(test_f1_macro) AS test_f1, max(training_duration_seconds) AS seconds
FROM signals GROUP BY 1""")
def service_signals(t):
    return signals_per_hour(signals(t))


def signals_per_hour(ticks):
    return ticks.groupBy(F.floor(F.col("tick_no") / 240).alias("hour_no")).agg(
        F.count("*").alias("n"), F.max("error_rate").alias("error_rate"), F.round(F.max("latency_p95"), 9).alias("p95"),
        F.round(F.max("latency_p99"), 9).alias("p99"), F.max("model_switches_1h").alias("switches"), F.min("feedback_24h").alias("feedback"),
        F.min("test_f1_macro").alias("test_f1"), F.max("training_duration_seconds").alias("seconds"))


@query("alert_transitions", "T9, W10", f"""
WITH {ALERTS}, s AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY alertname ORDER BY tick_no), 'inactive') AS before FROM states)
SELECT alertname, severity, tick_no, CASE WHEN state = 'inactive' AND before = 'firing' THEN 'resolved' ELSE state END AS state FROM s WHERE state <> before""")
def alert_transitions(t):
    return alerts.alert_transitions(states(t))


@query("firing_intervals", "T9", f"""
WITH {ALERTS} SELECT alertname, severity, since, firing_from, coalesce(resolved_at, -1) AS resolved_at FROM intervals""")
def firing_intervals(t):
    return alerts.firing_intervals(states(t)).na.fill(-1, ["resolved_at"])


@query("firing_counts", "A25, T12", f"WITH {ALERTS} SELECT alertname, tick_no // 5760 AS range_no, count(*) AS n FROM states WHERE state = 'firing' GROUP BY 1, 2")
def firing_counts(t):
    return alerts.firing_counts(states(t), DAY_TICKS)


@query("now_firing", "T12", f"""
WITH {ALERTS} SELECT alertname, severity, since FROM states WHERE state = 'firing' AND tick_no = (SELECT max(tick_no) FROM spine)""")
def now_firing(t):
    return alerts.now_firing(states(t))


def notices_sql(stretches: str, end: str) -> str:
    """Flush by flush: the rule of notification groups over stretches (alertname, severity, member, f, e), e null while it fires.

    A row is a flush: its time, the members shown and gone, what the last notice named and when it was sent.
    """
    fires = "s.alertname = n.alertname AND s.severity = n.severity AND s.f <= n.moment AND coalesce(s.e, n.moment + 1) > n.moment"
    return f"""
s AS ({stretches}),
finish AS (SELECT {end} AS finish),
flushes(alertname, severity, moment, shown, gone, alive, named, sent_at, sent) AS (
  SELECT alertname, severity, CAST(-1 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), false, CAST([] AS VARCHAR[]), CAST(NULL AS BIGINT), false
  FROM (SELECT DISTINCT alertname, severity FROM s)
  UNION ALL
  SELECT alertname, severity, moment, shown, gone, alive, CASE WHEN NOT alive THEN CAST([] AS VARCHAR[]) WHEN sent THEN shown ELSE named END,
         CASE WHEN NOT alive THEN NULL WHEN sent THEN moment ELSE sent_at END, sent
  FROM (
    SELECT *, NOT list_has_all(named, shown) OR len(gone) > 0 OR (len(shown) > 0 AND moment - coalesce(sent_at, moment) >= 900) AS sent
    FROM (
      SELECT n.alertname, n.severity, n.moment, n.named, n.sent_at, len(firing) > 0 AS alive, list_filter(n.named, lambda m: NOT list_contains(firing, m)) AS gone,
             CASE WHEN n.severity = 'warning' AND EXISTS (SELECT 1 FROM s c WHERE c.severity = 'critical' AND c.alertname = n.alertname AND c.f <= n.moment AND coalesce(c.e, n.moment + 1) > n.moment)
                  THEN CAST([] AS VARCHAR[]) ELSE firing END AS shown
      FROM (
        SELECT n.*, coalesce((SELECT list(member) FROM s WHERE {fires}), CAST([] AS VARCHAR[])) AS firing
        FROM (
          SELECT alertname, severity, named, sent_at, CASE WHEN alive THEN moment + 300 ELSE 30 + (
                   SELECT min(f) FROM s WHERE s.alertname = flushes.alertname AND s.severity = flushes.severity AND s.f > flushes.moment) END AS moment
          FROM flushes) n
        WHERE n.moment < (SELECT finish FROM finish)) n)))"""


@query("alert_notices", "T10, T11", f"""
WITH RECURSIVE {ALERTS}, {notices_sql("SELECT alertname, severity, '' AS member, firing_from * 15 AS f, resolved_at * 15 AS e FROM intervals",
                                      "(SELECT (max(tick_no) + 1) * 15 FROM spine)")}
SELECT alertname, severity, CASE WHEN len(shown) > 0 THEN 'firing' ELSE 'resolved' END AS kind, moment AS at_seconds FROM flushes WHERE sent""")
def alert_notices(t):
    rows = written(states(t), "states")
    return alerts.notices(alerts.firing_intervals(rows), end_tick=rows.agg(F.max("tick_no")).scalar())


# slow and failing requests as stretches of alerts: of one name and severity for many users, warnings and critical ones at once
_STRETCHES = """
  SELECT event_type AS alertname, CASE WHEN value > 100 THEN 'critical' ELSE 'warning' END AS severity, 'user' || (user_id % 7) AS member,
         epoch_us(ts) // 1000000 AS f, CASE WHEN value <= 200 THEN epoch_us(ts) // 1000000 + CAST(floor(value * 20) AS BIGINT) END AS e
  FROM events WHERE value > 60"""
# overlapping stretches of one member are one
_JOINED = f"""raw AS ({_STRETCHES}),
reach AS (SELECT *, max(coalesce(e, 99999999999)) OVER (PARTITION BY alertname, severity, member ORDER BY f, coalesce(e, 99999999999) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM raw),
named AS (SELECT *, sum(CASE WHEN far IS NULL OR f > far THEN 1 ELSE 0 END) OVER (PARTITION BY alertname, severity, member ORDER BY f, coalesce(e, 99999999999)) AS k FROM reach),
joined AS (SELECT alertname, severity, member, min(f) AS f, nullif(max(coalesce(e, 99999999999)), 99999999999) AS e FROM named GROUP BY alertname, severity, member, k)"""
_END = "(SELECT epoch_us(max(ts)) // 1000000 + 1 FROM events)"


def member_stretches(t):
    """Requests over 0.6 s as stretches of a member; the slowest still last."""
    at = F.expr("unix_micros(cast(ts AS timestamp)) div 1000000")
    return t.events.where("value > 60").select(
        F.col("event_type").alias("alertname"), F.when(F.col("value") > 100, "critical").otherwise("warning").alias("severity"),
        F.concat(F.lit("user"), (F.col("user_id") % 7).cast("string")).alias("member"), at.alias("fires_at"),
        F.when(F.col("value") <= 200, at + F.floor(F.col("value") * 20)).alias("ends_at"))


def log_end(t):
    return t.events.agg((F.expr("unix_micros(cast(max(ts) AS timestamp)) div 1000000") + 1)).scalar()


@query("grouped_notices", "T10, T11, J8", f"""
WITH RECURSIVE {_JOINED}, {notices_sql("SELECT * FROM joined", _END)}
SELECT alertname, severity, moment AS at_seconds, CASE WHEN len(shown) > 0 THEN 'firing' ELSE 'resolved' END AS kind,
       array_to_string(list_sort(shown), ',') AS firing, array_to_string(list_sort(gone), ',') AS resolved FROM flushes WHERE sent""")
def grouped_notices(t):
    """Groups of several members, warnings silent while a critical alert of the same name fires."""
    stretches = written(notify.joined_stretches(member_stretches(t), ["alertname", "severity", "member"]), "members")
    hidden = notify.inhibited_time(stretches, log_end(t))
    sent = notify.group_notices(stretches, log_end(t), hidden)
    return sent.withColumns({c: F.array_join(c, ",") for c in ("firing", "resolved")})


@query("shown_time", "T11, J8", f"""
WITH {_JOINED},
closed AS (SELECT alertname, severity, member, f, coalesce(e, {_END}) AS e FROM joined),
seconds AS (
  SELECT w.alertname, w.severity, w.member, unnest(range(w.f, w.e)) AS moment FROM closed w WHERE severity = 'warning'
  EXCEPT SELECT w.alertname, w.severity, w.member, unnest(range(greatest(w.f, c.f), least(w.e, c.e))) FROM closed w JOIN closed c USING (alertname, member)
  WHERE w.severity = 'warning' AND c.severity = 'critical'),
numbered AS (SELECT *, moment - row_number() OVER (PARTITION BY alertname, severity, member ORDER BY moment) AS island FROM seconds)
SELECT alertname, severity, member, min(moment) AS fires_at, max(moment) + 1 AS ends_at FROM numbered GROUP BY alertname, severity, member, island""")
def shown_time(t):
    """Warnings without the time in which a critical alert of the same name and member fires, against single seconds."""
    labels = ["alertname", "severity", "member"]
    stretches = written(notify.joined_stretches(member_stretches(t), labels), "members")
    left = notify.shown_time(stretches, log_end(t), ["alertname", "member"], labels)
    return left.where("severity = 'warning'")


_SEVERE = """fired AS (
  SELECT DISTINCT event_type AS alertname, user_id, CASE WHEN value > 100 THEN 'critical' ELSE 'warning' END AS severity FROM events WHERE value > 60)"""


@query("inhibited_alerts", "J8, T11", f"""
WITH {_SEVERE}
SELECT alertname, user_id, severity FROM fired f WHERE severity <> 'warning'
   OR NOT EXISTS (SELECT 1 FROM fired c WHERE c.severity = 'critical' AND c.alertname = f.alertname AND c.user_id = f.user_id)""")
def inhibited_alerts(t):
    fired = t.events.where("value > 60").select(
        F.col("event_type").alias("alertname"), "user_id", F.when(F.col("value") > 100, "critical").otherwise("warning").alias("severity")).distinct()
    return alerts.inhibit(fired, ["alertname", "user_id"])


# --- Runs -------------------------------------------------------------------
@query("run_listing", "S11, W7", f"""
WITH {RUNS} SELECT * FROM runs WHERE status = 'F' AND run_name IN ('1-URGENT', '2-HIGH') ORDER BY start_time DESC, run_id LIMIT 20""")
def run_listing(t):
    return run_ops.list_runs(runs(t), ["1-URGENT", "2-HIGH"], status="F")


@query("latest_runs_per_name", "W7", f"""
WITH {RUNS}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id) AS INT) AS rank FROM runs)
SELECT * FROM r WHERE rank <= 10""")
def latest_runs_per_name(t):
    return run_ops.latest_n_per_group(runs(t), "run_name", "start_time", "run_id", 10)


@query("latest_run_per_status", "W6", f"""
WITH {RUNS} SELECT status, max_by(run_id, (start_time, run_id)) AS run_id FROM runs GROUP BY status""")
def latest_run_per_status(t):
    return run_ops.latest_per_group(runs(t), "status", "start_time", "run_id").select("status", "run_id")


@query("latest_version", "W6", """
SELECT p_brand AS name, CAST(max(p_size) AS VARCHAR) AS version FROM part GROUP BY 1""")
def latest_version(t):
    return run_ops.latest_version(t.part.select(F.col("p_brand").alias("name"), F.col("p_size").cast("string").alias("version")))


@query("best_epochs", "A24", f"""
WITH {HISTORY}, b AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY val_f1 DESC, epoch) AS rn FROM history WHERE val_f1 > 0)
SELECT run_id, epoch, val_f1 FROM b WHERE rn = 1""")
def best_epochs(t):
    return run_ops.best_epoch(history(t).select("run_id", "epoch", "val_f1"))


STOP = f"""{HISTORY}, h AS (
  SELECT *, row_number() OVER r AS rn, val_f1 > greatest(coalesce(max(val_f1) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS improved,
         greatest(max(val_f1) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS best_so_far
  FROM history WINDOW r AS (PARTITION BY run_id ORDER BY epoch)),
s AS (SELECT *, rn - coalesce(max(CASE WHEN improved THEN rn END) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS stale FROM h)"""


@query("early_stop", "W8", f"""
WITH {STOP} SELECT run_id, epoch, improved, best_so_far, CAST(stale AS INT) AS stale_epochs, stale >= 3 AS should_stop FROM s""")
def early_stop(t):
    return run_ops.early_stop(history(t).select("run_id", "epoch", "val_f1")).drop("val_f1")


@query("stop_epochs", "W8", f"WITH {STOP} SELECT run_id, min(epoch) AS stop_epoch FROM s WHERE stale >= 3 GROUP BY run_id")
def stop_epochs(t):
    return run_ops.stop_epoch(history(t).select("run_id", "epoch", "val_f1"))


@query("weighted_loss", "A21", f"""
WITH {HISTORY} SELECT run_id, round(sum(loss * n) / sum(n)::DOUBLE, 9) AS mean_loss FROM history GROUP BY run_id""")
def weighted_loss(t):
    return run_ops.weighted_loss(history(t)).withColumn("mean_loss", F.round("mean_loss", 9))
