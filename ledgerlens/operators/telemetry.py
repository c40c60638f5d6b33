"""Service telemetry: counters, histograms, quantiles, rates, rolling error rate.

The grouped operators work on batch and streaming tables alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.config import ERROR_WINDOW, LATENCY_BOUNDS
from ledgerlens.functions.numbers import epoch_micros, from_micros
from ledgerlens.operators.ordered import rolling_mean, with_previous

SECOND = 1_000_000
HOUR = 3600
DAY = 24 * HOUR


def counters(df: DataFrame, labels: Sequence[str], name: str = "n") -> DataFrame:
    """Events per label set."""
    return df.groupBy(*labels).agg(F.count("*").alias(name))


def windowed_counters(df: DataFrame, labels: Sequence[str], width: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Events per tumbling window and label set."""
    return df.groupBy(F.window(ts, width), *labels).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("window_start"), *labels, "n")


# --- Histograms -------------------------------------------------------------
def bucket_columns(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Aggregates for a cumulative histogram: c0… per bound, total and sum."""
    return [
        *[F.count_if(value <= b).alias(f"c{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("total"),
        F.sum(value).alias("value_sum"),
    ]


def histogram(df: DataFrame, value: str, bounds: Sequence[float] = LATENCY_BOUNDS, by: Sequence[str] = ()) -> DataFrame:
    """Wide cumulative histogram, one row per group, from one pass."""
    return df.groupBy(*by).agg(*bucket_columns(F.col(value), bounds))


def windowed_histogram(df: DataFrame, value: str, bounds: Sequence[float] = LATENCY_BOUNDS,
                       by: Sequence[str] = (), width: str = "1 minute", ts: str = "ts") -> DataFrame:
    grouped = df.groupBy(F.window(ts, width), *by).agg(*bucket_columns(F.col(value), bounds))
    return grouped.select(F.col("window.start").alias("window_start"), *[c for c in grouped.columns if c != "window"])


def histogram_long(wide: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """One row per bound; the last one, infinity, is written as null."""
    keep = [c for c in wide.columns if c not in {"total", "value_sum", *[f"c{i}" for i in range(len(bounds))]}]
    cells = [F.struct(F.lit(float(b)).alias("le"), F.col(f"c{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    cells.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("total").alias("cumulative")))
    return wide.select(*keep, F.explode(F.array(*cells)).alias("x")).select(*keep, "x.*")


def quantile_of_buckets(q: float, bounds: Sequence[float], counts: Sequence[Column], total: Column) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket.

    Above the last bound it is the last bound; without data it is null.
    """
    rank = F.lit(q) * total
    out = None
    for i, bound in enumerate(bounds):
        low = F.lit(float(bounds[i - 1]) if i else 0.0)
        below = counts[i - 1] if i else F.lit(0)
        inside = F.try_divide((rank - below).cast("double"), (counts[i] - below).cast("double"))
        value = low + (F.lit(float(bound)) - low) * inside
        hit = counts[i] >= rank
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.when(total > 0, out.otherwise(F.lit(float(bounds[-1]))))


def with_quantiles(wide: DataFrame, quantiles: dict[str, float], bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Add quantile columns to a wide histogram."""
    counts = [F.col(f"c{i}") for i in range(len(bounds))]
    return wide.withColumns({
        name: quantile_of_buckets(q, bounds, counts, F.col("total")) for name, q in quantiles.items()})


# --- Rates ------------------------------------------------------------------
def sliding_sums(df: DataFrame, by: Sequence[str], range_seconds: int, step_seconds: int,
                 aggregates: Sequence[Column], ts: str = "ts") -> DataFrame:
    """Sums over (tick - range, tick] for every tick that sees an event.

    Events are first reduced to panes of one step. Only panes are then spread
    over the ticks that see them, so the spreading does not multiply events.
    Aggregates must be counts or sums.
    """
    step = step_seconds * SECOND
    # a pane holds the events in (tick - step, tick], named after its tick
    tick_no = F.ceil(epoch_micros(F.col(ts)) / F.lit(step)).cast("long")
    panes = df.groupBy(*by, tick_no.alias("_pane")).agg(*aggregates)
    names = [c for c in panes.columns if c not in (*by, "_pane")]
    reach = range_seconds // step_seconds
    spread = panes.withColumn("_tick", F.explode(F.sequence(F.col("_pane"), F.col("_pane") + (reach - 1))))
    sums = spread.groupBy(*by, "_tick").agg(*[F.sum(n).alias(n) for n in names])
    return sums.select(from_micros(F.col("_tick") * step).alias("tick"), *by, *names)


def request_rate(df: DataFrame, by: Sequence[str] = (), range_seconds: int = 300, step_seconds: int = 15) -> DataFrame:
    """Events per second over the range before each tick."""
    sums = sliding_sums(df, by, range_seconds, step_seconds, [F.count("*").alias("n")])
    return sums.withColumn("per_second", F.col("n") / F.lit(float(range_seconds)))


def latency_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = (),
                      range_seconds: int = 300, step_seconds: int = 15,
                      bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Histogram quantiles over the range before each tick."""
    sums = sliding_sums(df, by, range_seconds, step_seconds, bucket_columns(F.col(value), bounds))
    return with_quantiles(sums, quantiles, bounds).select("tick", *by, *quantiles)


def error_share(df: DataFrame, by: Sequence[str] = (), error: Column | None = None) -> DataFrame:
    """Share of failed requests per label set; 0 where there are none."""
    failed = error if error is not None else F.col("status") != "200"
    return df.groupBy(*by).agg(F.coalesce(F.avg(failed.cast("int")), F.lit(0.0)).alias("error_share"))


def rolling_error_rate(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", tie: str = "event_id",
                       ok: str = "ok", window: int = ERROR_WINDOW) -> DataFrame:
    """Share of failures among the last `window` requests, per request."""
    failed = F.when(F.col(ok), 0).otherwise(1)
    return rolling_mean(df, keys, [ts, tie], failed, window, "error_rate")


def counter_increase(samples: DataFrame, series: Sequence[str], ts: str = "ts", tie: str = "sample_id",
                     value: str = "value") -> DataFrame:
    """Add `increase` since the previous sample; a drop means the counter restarted at 0.

    The first sample of a series has no increase.
    """
    prev = with_previous(samples, series, [ts, tie], [value])
    before, now = F.col(f"prev_{value}"), F.col(value)
    return prev.withColumn(
        "increase", F.when(before.isNull(), 0.0).when(now < before, now).otherwise(now - before)
    ).drop(f"prev_{value}")


def increase_per_range(samples: DataFrame, series: Sequence[str], width: str = "1 hour", ts: str = "ts", **kw) -> DataFrame:
    """Counter increase per tumbling range."""
    grown = counter_increase(samples, series, ts, **kw)
    return grown.groupBy(*series, F.window(ts, width)).agg(F.sum("increase").alias("increase")).select(
        *series, F.col("window.start").alias("range_start"), "increase")


# --- Gauges -----------------------------------------------------------------
def latest_gauges(pushes: DataFrame, value: str = "value") -> DataFrame:
    """Merging push: the last non-null value of every (job, metric)."""
    return pushes.where(F.col(value).isNotNull()).groupBy("job", "metric").agg(
        F.max_by(value, F.struct("ts", "event_id")).alias(value))


def replaced_gauges(pushes: DataFrame, value: str = "value") -> DataFrame:
    """Replacing push: a job keeps only the metrics of its last push.

    Both steps are aggregates; the last push of each job is a small table.
    """
    per_push = pushes.groupBy("job", "push_id", "metric").agg(F.max_by(value, F.struct("ts", "event_id")).alias(value))
    last = per_push.groupBy("job").agg(F.max("push_id").alias("push_id"))
    return per_push.join(last, ["job", "push_id"]).select("job", "metric", value)


def vector_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Product of two labelled values with equal labels (`left * right`)."""
    return left.join(right.withColumnRenamed("value", "_right"), list(on)).select(
        *on, (F.col("value") * F.col("_right")).alias("value"))


def silence_gaps(events: DataFrame, ts: str = "ts", tie: str = "event_id", gap_seconds: int = DAY,
                 hold_seconds: int = 2 * DAY, now: Column | None = None) -> DataFrame:
    """Gaps between events longer than the range, with `alerted` where the hold time also passed.

    After a gap the increase over the range is 0 from start + range on; the
    alert fires if that lasts for the hold time. With `now` (a timestamp, such as
    the last tick of the wider log) the silence since the last event counts too; it is
    `open`, and its `silent_to` is now.
    """
    prev = with_previous(events.select(ts, tie), [], [ts, tie], [ts])
    gaps = prev.select(F.col(f"prev_{ts}").alias("silent_from"), F.col(ts).alias("silent_to"), F.lit(False).alias("open"))
    if now is not None:
        gaps = gaps.unionByName(events.agg(F.max(ts).alias("silent_from")).select(
            "silent_from", now.alias("silent_to"), F.lit(True).alias("open")))
    gap = (epoch_micros(F.col("silent_to")) - epoch_micros(F.col("silent_from"))) / F.lit(float(SECOND))
    return (
        gaps.withColumn("gap_seconds", gap).where(F.col("gap_seconds") > gap_seconds)
        .select(
            "silent_from", "silent_to", "gap_seconds",
            (F.col("gap_seconds") >= gap_seconds + hold_seconds).alias("alerted"), "open",
        )
    )


# --- Metric text lines ------------------------------------------------------
def metric_lines(lines: DataFrame, keys: Sequence[str], column: str = "value", limit: int = 40, order: str | None = None) -> DataFrame:
    """The first lines that name one of the metrics and are no comment."""
    wanted = F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: F.contains(F.col(column), k))
    kept = lines.where(~F.startswith(F.col(column), F.lit("#")) & wanted)
    return (kept.orderBy(order) if order else kept).limit(limit)
