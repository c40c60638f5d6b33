"""Streaming counters, histograms, gauges, rolling error rate, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.config import ERROR_WINDOW, LATENCY_BOUNDS
from ledgerlens.operators.telemetry import latest_gauges, windowed_counters, windowed_histogram
from ledgerlens.streaming.io import latest_state, read_batches, start_table
from ledgerlens.streaming.keyed import rolling_error_rates


def with_event_time(stream: DataFrame, late: str) -> DataFrame:
    """Set the watermark on `ts`, which has to be a timestamp with a zone for that."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def counters_per_window(stream: DataFrame, labels: Sequence[str], width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Windowed counters; rows later than `late` behind the newest are left out."""
    return windowed_counters(with_event_time(stream, late), labels, width)


def histogram_per_window(stream: DataFrame, value: str, by: Sequence[str], width: str = "1 hour",
                         late: str = "10 minutes", bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    return windowed_histogram(with_event_time(stream, late), value, bounds, by, width)


def gauges_so_far(pushes: DataFrame) -> DataFrame:
    """Latest gauge per (job, metric); the state is one row per series."""
    return latest_gauges(pushes)


def without_replays(stream: DataFrame, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """Drop repeated events that arrive within the watermark delay."""
    return with_event_time(stream, late).dropDuplicatesWithinWatermark(list(keys))


# --- Rolling error rate -----------------------------------------------------
def start_rolling_error_rate(requests: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                             rows: int = ERROR_WINDOW, salts: int = 32) -> StreamingQuery:
    """Per batch, the error rate over the last `rows` requests of each key that has requests in it, in arrival order."""
    return start_table(rolling_error_rates(requests, keys, rows, salts), f"{path}/rates", checkpoint)


def latest_rates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The gauge values after the last finished batch."""
    return latest_state(read_batches(spark, f"{path}/rates"), keys)
