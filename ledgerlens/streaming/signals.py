"""Alert signals from a stream of requests and gauge pushes, one row a tick, by event time.

Three keyed steps. The first is spread over spans of time and, in each, over `parts` keys by a
hash of the event, so no task sees all traffic and none holds more than its share of a span: it
keeps one pane a tick (bucket counts, the last outcomes, the last value of each gauge) until
the watermark has passed the tick, then hands the panes on. The second adds the parts of a
span up, so a tick has one pane. The third has one key a service and sees the panes of a tick
once, with at most as many outcomes as the error rate looks back on, whatever the traffic. It keeps
rings of panes as long as its ranges (five minutes, an hour, a day), the last outcomes
and the last gauges, and emits a row for every tick up to the watermark. Its timer is set
to the tick after the last one emitted, so ticks go on while no request comes: silence
is seen by the clock of the stream, not by an event.

Requests behind the watermark are left out, as in every event-time aggregate. A `clock`
row, which has a time only, moves the watermark when nothing else comes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.config import ERROR_WINDOW, LATENCY_BOUNDS
from ledgerlens.functions.numbers import epoch_micros
from ledgerlens.operators.alerts import GAUGES, TICK_SECONDS
from ledgerlens.operators.telemetry import DAY, HOUR, SECOND, quantile_of_buckets
from ledgerlens.streaming.arrow_state import packed, unpacked

_FIVE_MINUTES = 300
_SPAN = 6 * HOUR


def service_log(requests: DataFrame, pushes: DataFrame, clock: DataFrame | None = None) -> DataFrame:
    """Requests, pushes and clock rows as one table or stream of events.

    `outcome` is 1 for a failed request, 0 for a good one, null for what the error rate
    does not count. `seconds` is the latency of a prediction.
    """
    def whole(c: Column) -> Column:
        return c.cast("int")

    asked = requests.select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.when(F.col("endpoint") == "/predict", F.col("latency_s")).alias("seconds"),
        F.when(~F.col("is_feedback"), whole(~F.coalesce("ok", F.lit(False)))).alias("outcome"),
        whole(F.coalesce("is_feedback", F.lit(False))).alias("feedback"), whole(F.coalesce("is_switch", F.lit(False))).alias("switch"),
        F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"))
    none = {"seconds": "double", "outcome": "int", "feedback": "int", "switch": "int", "metric": "string", "value": "double"}
    empty = [F.lit(0 if c in ("feedback", "switch") else None).cast(kind).alias(c) for c, kind in none.items()]
    pushed = pushes.select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", *empty[:4], "metric", F.col("value").cast("double").alias("value"))
    log = asked.unionByName(pushed)
    return log if clock is None else log.unionByName(clock.select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit(None).cast("long").alias("event_id"), *empty))


def _last_of_each(frame: pd.DataFrame, by: str, most: int) -> pd.DataFrame:
    """The last `most` rows of each group, in order of group and time."""
    frame = frame.sort_values([by, "at", "event_id"], kind="stable", ignore_index=True)
    group = frame[by].to_numpy()
    return frame[np.arange(len(group)) >= np.searchsorted(group, group, "right") - most]


def _joined(pieces: Sequence[tuple[pd.DataFrame, ...]], outcomes: int) -> list[pd.DataFrame]:
    """Panes of several pieces as those of one: counts, the last outcomes of a pane, the last value of each of its gauges."""
    counts, last, gauges = (
        pd.concat([f for f in frames if len(f)] or list(frames[:1]), ignore_index=True) for frames in zip(*pieces))
    return [
        counts.groupby("tick_no", as_index=False).sum(), _last_of_each(last, "tick_no", outcomes),
        gauges.sort_values(["at", "event_id"], kind="stable").drop_duplicates(["tick_no", "metric"], keep="last")]


def _piece(key: tuple, names: Sequence[str], last_tick: int, step: int, **values: bytes) -> pd.DataFrame:
    """One row with the key, the time of the last tick, and packed panes."""
    return pd.DataFrame({
        **dict(zip(names, ([k] for k in key))), "tick": pd.to_datetime([last_tick * step], unit="s", utc=True), **{c: [v] for c, v in values.items()}})


class PaneParts(StatefulProcessor):
    """The panes of one share of a span's traffic; state is what the watermark has not passed yet.

    State and output have three kinds of rows: one with counts for each pane, one for each of
    the last outcomes of a pane, one for each gauge that a pane has.
    """

    def __init__(self, step: int, bounds: Sequence[float], gauges: Sequence[str], outcomes: int):
        self.step, self.bounds, self.gauges, self.outcomes = step, np.array(bounds, float), list(gauges), outcomes
        self.counted = [*[f"c{i}" for i in range(len(bounds))], "total", "feedback", "switch"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", "counts binary, outcomes binary, gauges binary, timer bigint")

    def _load(self) -> tuple[list[pd.DataFrame], int]:
        if self.state.exists():
            *frames, timer = self.state.get()
            return [unpacked(f) for f in frames], timer
        at = {"tick_no": "int64", "at": "int64", "event_id": "int64"}
        columns = [dict.fromkeys(["tick_no", *self.counted], "int64"), {**at, "failed": "int8"}, {**at, "metric": "object", "value": "float64"}]
        return [pd.DataFrame({c: pd.Series(dtype=kind) for c, kind in kinds.items()}) for kinds in columns], -1

    def _save(self, frames: list[pd.DataFrame], timer: int) -> None:
        """Keep what waits, with one timer, at the first tick that waits."""
        first = int(frames[0]["tick_no"].min()) * self.step * 1000 if len(frames[0]) else -1
        if timer >= 0 and timer != first:
            self.handle.deleteTimer(timer)
        if first >= 0 and timer != first:
            self.handle.registerTimer(first)
        if first >= 0:
            self.state.update((*map(packed, frames), first))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames, timer = self._load()
        for batch in rows:
            batch = batch[batch["tick_no"].notna() & batch["event_id"].notna()]
            if batch.empty:
                continue
            seconds = batch["seconds"].to_numpy(float)
            timed = ~np.isnan(seconds)
            at = batch[["tick_no", "at", "event_id"]].astype("int64")
            made = at[["tick_no"]].assign(
                **{f"c{i}": (timed & (seconds <= b)).astype("int64") for i, b in enumerate(self.bounds)}, total=timed.astype("int64"),
                feedback=batch["feedback"].astype("int64"), switch=batch["switch"].astype("int64"))
            counted, pushed = batch["outcome"].notna(), batch["metric"].isin(self.gauges) & batch["value"].notna()
            outcomes = at[counted].assign(failed=batch.loc[counted, "outcome"].astype("int8"))
            gauges = at[pushed].assign(metric=batch.loc[pushed, "metric"], value=batch.loc[pushed, "value"].astype(float))
            frames = _joined([frames, (made, outcomes, gauges)], self.outcomes)
        self._save(frames, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = timerValues.getCurrentWatermarkInMs() // (self.step * 1000)
        frames, timer = self._load()
        counts, outcomes, gauges = (f[f["tick_no"] <= done] for f in frames)
        if len(counts):
            yield _piece(key[:2], ("service", "span"), int(counts["tick_no"].max()), self.step,
                         counts=packed(counts), outcomes=packed(outcomes), gauges=packed(gauges))
        self._save([f[f["tick_no"] > done] for f in frames], timer if timer != expiredTimerInfo.getExpiryTimeInMs() else -1)

    def close(self) -> None:
        pass


PARTS = "service string, span bigint, tick timestamp, counts binary, outcomes binary, gauges binary"
PANES = "service string, tick timestamp, panes binary"


class SpanPanes(StatefulProcessor):
    """The panes of a span from those of its parts, which come in one batch once the watermark has passed them; no state."""

    def __init__(self, step: int, outcomes: int):
        self.step, self.outcomes = step, outcomes

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [tuple(map(unpacked, piece)) for batch in rows for piece in zip(batch["counts"], batch["outcomes"], batch["gauges"])]
        counts, outcomes, gauges = _joined(parts, self.outcomes)
        ticks, cells = counts["tick_no"], counts.drop(columns="tick_no")
        panes = pd.concat([
            pd.DataFrame({"tick_no": ticks, "counts": list(cells.to_numpy())}), outcomes[["tick_no", "failed"]],
            gauges[["tick_no", "metric", "value"]]], ignore_index=True).reindex(columns=["tick_no", "counts", "failed", "metric", "value"])
        for c in ("counts", "metric"):
            panes[c] = [None if v is None or v is np.nan else v for v in panes[c]]
        yield _piece(key[:1], ("service",), int(ticks.max()), self.step, panes=packed(panes))

    def close(self) -> None:
        pass


class SignalTicks(StatefulProcessor):
    """Signals of every tick; state is the rings of the ranges, the last outcomes and gauges, and panes not yet due."""

    def __init__(self, step: int, buckets: int, gauges: Sequence[str], outcomes: int):
        self.step, self.buckets, self.gauges, self.outcomes = step, buckets, list(gauges), outcomes
        #: Ticks that a range covers, for each count of a pane.
        self.reach = np.array([_FIVE_MINUTES // step] * (buckets + 1) + [DAY // step, HOUR // step])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("service", "ring binary, last binary, gauges map<string,double>, waiting binary, next bigint")

    def _load(self) -> tuple[np.ndarray, np.ndarray, dict[str, float], pd.DataFrame | None, int]:
        if not self.state.exists():
            return np.zeros((0, len(self.reach)), np.int64), np.zeros(0, np.int8), {}, None, -1
        ring, last, gauges, waiting, upcoming = self.state.get()
        return (np.frombuffer(bytes(ring), np.int64).reshape(-1, len(self.reach)), np.frombuffer(bytes(last), np.int8), dict(gauges),
                unpacked(waiting) if waiting else None, upcoming)

    def _save(self, ring: np.ndarray, last: np.ndarray, gauges: dict[str, float], waiting: pd.DataFrame | None, upcoming: int) -> None:
        self.state.update((ring.tobytes(), last.tobytes(), gauges, packed(waiting) if waiting is not None and len(waiting) else None, upcoming))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ring, last, gauges, waiting, upcoming = self._load()
        fresh = pd.concat([unpacked(p) for batch in rows for p in batch["panes"]], ignore_index=True)
        waiting = fresh if waiting is None else pd.concat([waiting, fresh], ignore_index=True)
        if upcoming < 0:
            upcoming = int(waiting["tick_no"].min())
            self.handle.registerTimer(upcoming * self.step * 1000)
        self._save(ring, last, gauges, waiting, upcoming)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ring, last, gauges, waiting, upcoming = self._load()
        done = timerValues.getCurrentWatermarkInMs() // (self.step * 1000)
        if waiting is not None:
            waiting = waiting.sort_values("tick_no", kind="stable", ignore_index=True)  # a tick's own rows are in order
        while upcoming <= done:
            end = min(done, upcoming + DAY // self.step - 1)
            upto = int(np.searchsorted(waiting["tick_no"], end, "right")) if waiting is not None else 0
            panes = waiting.iloc[:upto] if waiting is not None else None
            made, ring, last, gauges = self._ticks(upcoming, end, panes, ring, last, gauges)
            made.insert(0, "service", key[0])
            yield made
            waiting = waiting.iloc[upto:] if waiting is not None else None
            upcoming = end + 1
        self.handle.registerTimer(upcoming * self.step * 1000)
        self._save(ring, last, gauges, waiting, upcoming)

    def _ticks(self, first: int, end: int, panes: pd.DataFrame | None, ring: np.ndarray, last: np.ndarray,
               gauges: dict[str, float]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, dict[str, float]]:
        """Rows of the ticks from `first` to `end`, and what the next ones need."""
        n = end - first + 1
        sums, rate, shown = np.zeros((n, len(self.reach)), np.int64), np.full(n, np.nan), {g: np.full(n, np.nan) for g in self.gauges}
        if len(last):
            rate[0] = last.sum() / len(last)
        for g, value in gauges.items():
            shown[g][0] = value
        if panes is not None and len(panes):
            at = panes["tick_no"].to_numpy("int64") - first
            counted = panes["counts"].notna().to_numpy()
            np.add.at(sums, at[counted], np.vstack(panes["counts"][counted].to_list()))
            failed = panes["failed"].notna().to_numpy()
            if failed.any():
                outcomes = np.concatenate([last, panes["failed"][failed].to_numpy("int8")])
                ticks = np.unique(at[failed])
                ends = len(last) + np.searchsorted(at[failed], ticks, "right")
                upto = np.concatenate([[0], np.cumsum(outcomes, dtype=np.int64)])
                begins = np.maximum(ends - self.outcomes, 0)
                rate[ticks] = (upto[ends] - upto[begins]) / (ends - begins)
                last = outcomes[-self.outcomes:]
            pushed = panes["metric"].notna().to_numpy()
            for tick, metric, value in zip(at[pushed].tolist(), panes["metric"][pushed], panes["value"][pushed]):
                shown[metric][tick] = value  # in order of time, so the last one stays
        ring = np.vstack([ring, sums])
        upto = np.vstack([np.zeros((1, len(self.reach)), np.int64), np.cumsum(ring, axis=0)])
        here = np.arange(len(ring) - n, len(ring)) + 1
        ranges = np.column_stack([upto[here, c] - upto[np.maximum(here - reach, 0), c] for c, reach in enumerate(self.reach)])
        filled = {g: pd.Series(v).ffill() for g, v in shown.items()}
        made = pd.DataFrame({
            "tick_no": np.arange(first, end + 1), **{f"c{i}": ranges[:, i] for i in range(self.buckets)}, "total": ranges[:, self.buckets],
            "feedback_24h": ranges[:, -2], "model_switches_1h": ranges[:, -1], "error_rate": pd.Series(rate).ffill(), **filled})
        gauges = {g: float(v.iloc[-1]) for g, v in filled.items() if not np.isnan(v.iloc[-1])}
        return made, ring[-(int(self.reach.max()) - 1):], last, gauges

    def close(self) -> None:
        pass


def service_signal_stream(log: DataFrame, service: Column | None = None, late: str = "10 minutes", parts: int = 8,
                          step: int = TICK_SECONDS, bounds: Sequence[float] = LATENCY_BOUNDS,
                          gauges: Sequence[str] = GAUGES, outcomes: int = ERROR_WINDOW) -> DataFrame:
    """Signals of each service at every tick from its first event to the watermark.

    `log` is a stream of `service_log` rows. Raise `parts` with the traffic of a span of six hours. The
    columns are those of `operators.alerts.service_signals`, after `service`. The session
    must use the RocksDB state store, as `build_session` sets it.
    """
    owner = F.lit("service") if service is None else service
    # a worker takes a null span for another key's, so events without a time go before
    events = log.withWatermark("ts", late).where("ts IS NOT NULL").select(
        owner.alias("service"), "ts", F.ceil(epoch_micros(F.col("ts")) / F.lit(step * SECOND)).cast("long").alias("tick_no"),
        epoch_micros(F.col("ts")).alias("at"), "event_id", "seconds", "outcome", "feedback", "switch", "metric", "value",
        # by the tick, so that a tick lies in one span
        F.floor(F.ceil(epoch_micros(F.col("ts")) / F.lit(step * SECOND)) / F.lit(max(_SPAN // step, 1))).cast("long").alias("span"),
        F.pmod(F.xxhash64("event_id"), F.lit(parts)).cast("int").alias("part"))
    shares = events.groupBy("service", "span", "part").transformWithStateInPandas(
        statefulProcessor=PaneParts(step, bounds, gauges, outcomes), outputStructType=PARTS,
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="tick")
    panes = shares.groupBy("service", "span").transformWithStateInPandas(
        statefulProcessor=SpanPanes(step, outcomes), outputStructType=PANES,
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="tick")
    n = len(bounds)
    shape = ", ".join(["service string, tick_no bigint", *[f"c{i} bigint" for i in range(n)], "total bigint, feedback_24h bigint, model_switches_1h bigint",
                       "error_rate double", *[f"{g} double" for g in gauges]])
    ticks = panes.groupBy("service").transformWithStateInPandas(
        statefulProcessor=SignalTicks(step, n, gauges, outcomes), outputStructType=shape, outputMode="Append", timeMode="EventTime")
    counts = [F.col(f"c{i}") for i in range(n)]
    known = [F.nanvl(F.col(g), F.lit(None).cast("double")).alias(g) for g in ("error_rate", *gauges)]
    return ticks.select(
        "service", "tick_no", *known,
        quantile_of_buckets(0.95, bounds, counts, F.col("total")).alias("latency_p95"),
        quantile_of_buckets(0.99, bounds, counts, F.col("total")).alias("latency_p99"), "model_switches_1h", "feedback_24h")
