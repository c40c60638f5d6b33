"""Streams over the test tables, run to their end; the SQL twins are those of the batch operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ledgerlens.catalog import telemetry_queries as tq, text_queries as xq
from ledgerlens.catalog.bindings import (
    FEEDBACK, REQUESTS, TX, counter_columns, event_labels, feedback, label_baseline, push_columns, request_columns,
)
from ledgerlens.catalog.registry import REGISTRY, query
from ledgerlens.operators import alerts
from ledgerlens.operators.ordered import with_position
from ledgerlens.session import ROCKSDB, STATE_STORE, work_folder
from ledgerlens.sinks.gauge_table import GaugeTable
from ledgerlens.sources.scrape import ScrapeSource, place
from ledgerlens.streaming import alerts as stream_alerts, feedback as stream_feedback, keyed, scoring, signals, telemetry
from ledgerlens.streaming.io import latest_state, read_batches, start_batches, start_table, stream_lines, stream_parquet, stream_table


def events_stream(t):
    return stream_table(t.spark, t.folder, "events", t.events.schema)


#: Events of a batch beyond this are dealt over several files.
FILE_ROWS = 250_000


def percentiles(values, shares):
    """Interpolated percentiles of a column of numbers, as `percentile` gives them, from places in a range sort."""
    values = values.toDF("at").where("at IS NOT NULL")
    n = values.count()
    if not n:
        return []
    wanted = [(n - 1) * share for share in shares]
    ranks = sorted({r + 1 for p in wanted for r in (math.floor(p), math.ceil(p))})
    at = {r["pos"] - 1: float(r["at"]) for r in with_position(values, [], ["at"]).where(F.col("pos").isin(ranks)).collect()}
    ends = [(p, math.floor(p), math.ceil(p)) for p in wanted]
    return [at[low] if at[low] == at[high] else (high - p) * at[low] + (p - low) * at[high] for p, low, high in ends]


def event_files(t, folder, files, late, again=None, by=None):
    """The events as files in order of time, or of `by`, one stream batch each.

    Rows that are `late` come with the file after their own, and those that come `again` once more
    with the next one. Many events make several files of each; gives how many, for `files_per_batch`.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp")) if by is None else by
    edges = percentiles(t.events.select(at), [i / files for i in range(1, files)])
    number = F.least(sum((F.when(at > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0)) + F.when(late, 1).otherwise(0), F.lit(files - 1))
    parts = max(-(-t.events.count() // (files * FILE_ROWS)), 1)
    place = f"{folder}/events"
    for i in range(files):
        rows = t.events.where(number == i)
        if again is not None:
            before = F.least(number + 1, F.lit(files - 1))
            rows = rows.unionByName(t.events.where((before == i) & again))
        if parts == 1:
            rows.coalesce(1).write.mode("append").parquet(place)
            continue
        rows.repartition(parts).write.mode("append").parquet(place)
        for _ in range((i + 1) * parts - len(t.spark.read.parquet(place).inputFiles())):  # empty parts make no file
            t.events.limit(0).coalesce(1).write.mode("append").parquet(place)
    return parts


def clock_file(t, folder, hours):
    """A last file with a row that has a time only, so many hours behind the last event's tick."""
    last = t.events.agg(F.max(alerts.tick_number(F.col("ts"))).alias("tick_no"))
    clock = F.timestamp_seconds(F.col("tick_no") * alerts.TICK_SECONDS + int(hours * 3600) + 1).cast("timestamp_ntz")
    row = last.select(*[(clock if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name) for f in t.events.schema])
    row.coalesce(1).write.mode("append").parquet(f"{folder}/events")


def run_table(t, stream, purpose, mode="append"):
    """Run a stream to its end into batch folders and return all written rows."""
    folder = work_folder(t.spark, purpose)
    start_table(stream, f"{folder}/out", f"{folder}/checkpoint", mode).awaitTermination()
    return read_batches(t.spark, f"{folder}/out")


@query("stream_request_counters", "T2, S12", REGISTRY["request_counters_per_minute"].sql)
def stream_request_counters(t):
    counted = telemetry.counters_per_window(request_columns(events_stream(t)), ["endpoint", "status"])
    found = latest_state(run_table(t, counted, "counters", "update"), ["window_start", "endpoint", "status"])
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_latency_histogram", "T3", REGISTRY["latency_histogram_per_hour"].sql)
def stream_latency_histogram(t):
    wide = telemetry.histogram_per_window(request_columns(events_stream(t)), "latency_s", ["endpoint"])
    found = latest_state(run_table(t, wide, "histogram", "update"), ["window_start", "endpoint"])
    return found.withColumns({"value_sum": F.round("value_sum", 6), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query("stream_latest_gauges", "T8", REGISTRY["latest_gauges"].sql)
def stream_latest_gauges(t):
    return latest_state(run_table(t, telemetry.gauges_so_far(push_columns(events_stream(t))), "gauges", "update"), ["job", "metric"])


@query("stream_rolling_error_rate", "T7", f"""
WITH {REQUESTS}, r AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY ts DESC, event_id DESC) AS rn FROM requests)
SELECT endpoint, avg(CASE WHEN ok THEN 0 ELSE 1 END) AS error_rate, count(*) AS n FROM r WHERE rn <= 100 GROUP BY endpoint""")
def stream_rolling_error_rate(t):
    """Over five files, of which each repeats a tenth of the one before."""
    folder = work_folder(t.spark, "rolling")
    parts = event_files(t, folder, 5, late=F.lit(False), again=F.col("event_id") % 10 == 3)
    t.spark.conf.set(STATE_STORE, ROCKSDB)  # a session not made by build_session may lack it
    rows = stream_parquet(t.spark, f"{folder}/events", t.events.schema, files_per_batch=parts)
    once = telemetry.without_replays(request_columns(rows), ["event_id"], "40 days")
    telemetry.start_rolling_error_rate(once, ["endpoint"], folder, f"{folder}/checkpoint").awaitTermination()
    return telemetry.latest_rates(t.spark, folder, ["endpoint"])


def samples_stream(t, hours):
    """Samples over five files and a last clock row so many hours behind the last one; a twentieth come a file late, within the delay."""
    folder = work_folder(t.spark, "samples")
    parts = event_files(t, folder, 5, late=F.col("event_id") % 20 == 7)
    clock_file(t, folder, hours)
    t.spark.conf.set(STATE_STORE, ROCKSDB)  # a session not made by build_session may lack it
    return counter_columns(stream_parquet(t.spark, f"{folder}/events", t.events.schema, files_per_batch=parts))


@query("stream_counter_increase", "W9, T6", REGISTRY["counter_increase"].sql)
def stream_counter_increase(t):
    """Samples over five files, some a file late; each increase comes once the watermark has passed its sample."""
    grown = keyed.counter_increase_stream(samples_stream(t, 24 * 15), ["series"], "15 days")
    return run_table(t, grown, "increase").select("sample_id", "series", "increase")


@query("stream_increase_per_hour", "T6, T4", REGISTRY["increase_per_hour"].sql)
def stream_increase_per_hour(t):
    ranges = keyed.increase_per_range_stream(samples_stream(t, 24 * 15 + 1), ["series"], "1 hour", "15 days")
    return run_table(t, ranges, "ranges").select("series", F.col("range_start").cast("timestamp_ntz").alias("range_start"), "increase")


@query("stream_arrivals", "T16", """
WITH numbered AS (SELECT *, epoch_us(ts) AS at_us, least(CAST(list_aggregate(list_transform(
       quantile_disc(epoch_us(ts), [0.2, 0.4, 0.6, 0.8]) OVER (), lambda e: CASE WHEN e < epoch_us(ts) THEN 1 ELSE 0 END), 'sum') AS INT), 4) AS home FROM events),
sent AS (SELECT event_id, at_us, least(home + CASE WHEN event_id % 9 = 4 THEN 1 ELSE 0 END, 4) AS file, 0 AS copy FROM numbered
         UNION ALL SELECT event_id, at_us, least(least(home + CASE WHEN event_id % 9 = 4 THEN 1 ELSE 0 END, 4) + 1, 4), 1 FROM numbered WHERE event_id % 10 = 3),
marks AS (SELECT file, max(at_us) AS top FROM sent GROUP BY file),
told AS (SELECT s.*, at_us <= (coalesce((SELECT max(top) FROM marks m WHERE m.file < s.file) , 0) - 86400000000) // 1000 * 1000 AS late FROM sent s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id, late ORDER BY file, copy) AS nth FROM told)
SELECT CASE WHEN late THEN 'late' WHEN nth > 1 THEN 'repeated' ELSE 'kept' END AS arrival, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM ranked GROUP BY 1""")
def stream_arrivals(t):
    """Five files with rows that come late and rows that come twice: every row is kept, late or repeated."""
    folder = work_folder(t.spark, "arrivals")
    parts = event_files(t, folder, 5, late=F.col("event_id") % 9 == 4, again=F.col("event_id") % 10 == 3)
    t.spark.conf.set(STATE_STORE, ROCKSDB)  # a session not made by build_session may lack it
    rows = stream_parquet(t.spark, f"{folder}/events", t.events.schema, files_per_batch=parts)
    told = run_table(t, keyed.arrivals(rows, "event_id", "1 day"), "told")
    return told.groupBy("arrival").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("stream_without_replays", "T16", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_without_replays(t):
    """Every event arrives twice; each counts once."""
    twice = events_stream(t).union(events_stream(t))
    kept = telemetry.without_replays(twice.select("ts", "event_id", "event_type"), ["event_id"], "40 days")
    return run_table(t, kept, "replays").groupBy("event_type").agg(F.count("*").alias("n"))


def pushed_gauges(t, mode, by=None):
    """Pushes over five files into a gauge table, one version a batch, compacted after the third."""
    folder = work_folder(t.spark, "gauges")
    parts = event_files(t, folder, 5, late=F.lit(False), by=by)
    table = GaugeTable(t.spark, f"{folder}/table")

    def handle(batch, batch_id):
        table.push(push_columns(batch), batch_id, mode)
        if batch_id == 2:
            table.compact()

    rows = stream_parquet(t.spark, f"{folder}/events", t.events.schema, files_per_batch=parts)
    start_batches(rows, handle, f"{folder}/checkpoint").awaitTermination()
    return table.read()


@query("merged_pushes", "K5, T8", REGISTRY["latest_gauges"].sql)
def merged_pushes(t):
    return pushed_gauges(t, "merge")


@query("replaced_pushes", "K5", REGISTRY["replaced_gauges"].sql)
def replaced_pushes(t):
    """Files in order of pushes, so the last push of a job is that of its last batch."""
    return pushed_gauges(t, "replace", F.expr("event_id div 10"))


_SCRAPE = 6 * 3600


def write_snapshots(folder, counted, first, last):
    """Text snapshots of request counters at the scrapes `first` to `last`; every seventh is missing."""
    system, path = place(folder)
    for k in range(first, last + 1):
        totals = {}
        for r in counted:
            if r["k"] <= k:
                totals[r["event_type"]] = totals.get(r["event_type"], 0) + r["count"]
        if k % 7 != 3:
            target = f"{path}/job=backend/hour={k * _SCRAPE // 3600}"
            system.create_dir(target, recursive=True)
            with system.open_output_stream(f"{target}/{k * _SCRAPE}.prom") as out:
                out.write(("# TYPE requests_total counter\n" + "".join(f'requests_total{{type="{e}"}} {n}\n' for e, n in sorted(totals.items()))).encode())


@query("scraped_counters", "S12", f"""
WITH seconds AS (SELECT event_type, epoch_us(ts) // 1000000 AS s FROM events),
k AS (SELECT unnest(range((min(s) + {_SCRAPE - 1}) // {_SCRAPE}, max(s) // {_SCRAPE} + 1)) AS k FROM seconds),
seen AS (SELECT k FROM k WHERE k >= (SELECT min(k) FROM k WHERE k % 7 <> 3) AND k <= (SELECT max(k) FROM k WHERE k % 7 <> 3))
SELECT 'backend' AS job, k * {_SCRAPE} AS at_seconds, 'up' AS name, '' AS labels, CASE WHEN k % 7 = 3 THEN 0.0 ELSE 1.0 END::DOUBLE AS value, k % 7 = 3 AS stale FROM seen
UNION ALL SELECT 'backend', k * {_SCRAPE}, 'requests_total', 'type="' || event_type || '"', count(*)::DOUBLE, false
FROM seen JOIN seconds ON s <= k * {_SCRAPE} WHERE k % 7 <> 3 GROUP BY k, event_type""")
def scraped_counters(t):
    """Snapshots scraped in two runs of one query, the second from the checkpoint of the first."""
    folder = work_folder(t.spark, "scrapes")
    seconds = F.expr("unix_micros(cast(ts AS timestamp)) div 1000000")
    counted = t.events.groupBy(F.ceil(seconds / F.lit(_SCRAPE)).alias("k"), "event_type").count().collect()  # a few counts a scrape
    low, high = t.events.agg(F.ceil(F.min(seconds) / F.lit(_SCRAPE)), F.floor(F.max(seconds) / F.lit(_SCRAPE))).first()
    t.spark.dataSource.register(ScrapeSource)
    for first, last in ((low, (low + high) // 2), ((low + high) // 2 + 1, high)):
        write_snapshots(f"{folder}/in", counted, first, last)
        samples = t.spark.readStream.format("scrape").option("interval", _SCRAPE).load(f"{folder}/in")
        start_table(samples, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_batches(t.spark, f"{folder}/out").select("job", F.unix_seconds("at").alias("at_seconds"), "name", "labels", "value", "stale")


@query("stream_feedback", "T1, K3, S4", f"""
WITH {FEEDBACK} SELECT event_id, epoch_us(ts) AS micros, predicted_category = actual_category AS correct FROM feedback
WHERE predicted_category <> '' AND actual_category <> ''""")
def stream_feedback_rows(t):
    """Feedback as JSON lines, half with epoch and half with ISO timestamps."""
    ts = F.col("ts").cast("timestamp")
    stamp = F.when(F.col("event_id") % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).otherwise(
        F.format_string("%.6f", F.unix_micros(ts) / F.lit(1e6)))
    line = F.to_json(F.struct(stamp.alias("timestamp"), "description", "predicted_category", "actual_category",
                              F.col("event_id").cast("string").alias("transaction_id")))
    folder = work_folder(t.spark, "feedback")
    feedback(t).select(line.alias("value")).write.text(f"{folder}/in")
    rows = stream_feedback.accepted_feedback(stream_lines(t.spark, f"{folder}/in"))
    stream_feedback.append_feedback_stream(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    found = t.spark.read.schema("timestamp timestamp, transaction_id string, correct boolean").json(f"{folder}/out")
    return found.select(F.col("transaction_id").cast("long").alias("event_id"), F.unix_micros("timestamp").alias("micros"), "correct")


@query("stream_scoring", "T13, L6", f"""
WITH {TX}, {xq.SCORES} SELECT row_id, category AS predicted_category FROM probs WHERE rn = 1""")
def stream_scoring(t):
    _, _, model = xq.language_model(t)
    docs = stream_table(t.spark, t.folder, "documents", t.documents.schema).select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("description"))
    folder = work_folder(t.spark, "scoring")
    scoring.start_scoring(docs, model, "row_id", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_batches(t.spark, f"{folder}/out").select("row_id", "predicted_category")


@query("stream_feedback_drift", "T14", REGISTRY["feedback_status"].sql)
def stream_feedback_drift(t):
    names = event_labels(t)
    value = F.col("value")
    rows = events_stream(t).select(
        F.when(value >= 300, "").when(value < 50, "view").otherwise(F.col("event_type")).alias("predicted_category"),
        F.when(value >= 30, "").otherwise(F.col("event_type")).alias("actual_category"))
    folder = work_folder(t.spark, "feedback-drift")
    stream_feedback.start_feedback_drift(rows, label_baseline(t, names), names, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_batches(t.spark, f"{folder}/out").drop("batch_id")


def signal_stream(t):
    """Signals of the request stream over five files of events and a last clock row."""
    folder = work_folder(t.spark, "log")
    parts = event_files(t, folder, 5, late=F.lit(False))
    clock_file(t, folder, 1 / 6)  # the watermark's delay is ten minutes
    rows = stream_parquet(t.spark, f"{folder}/events", t.events.schema, files_per_batch=parts)
    events, ticking = rows.where("event_id IS NOT NULL"), rows.where("event_id IS NULL").select("ts")
    t.spark.conf.set(STATE_STORE, ROCKSDB)  # a session not made by build_session may lack it
    return signals.service_signal_stream(
        signals.service_log(request_columns(events), push_columns(events), ticking), late="10 minutes")


@query("stream_service_signals", "T9, T5, T6, W11", REGISTRY["service_signals"].sql)
def stream_service_signals(t):
    return tq.signals_per_hour(run_table(t, signal_stream(t), "signals"))


@query("stream_alert_transitions", "T9", REGISTRY["alert_transitions"].sql)
def stream_alert_transitions(t):
    """From requests to changes of alert states in one stream."""
    conditions = alerts.rule_conditions(signal_stream(t), alerts.default_rules())
    return run_table(t, stream_alerts.alert_transition_stream(conditions), "alerts").drop("batch_id")
