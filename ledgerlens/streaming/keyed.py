"""Keyed state on streams: last outcomes, counters in order of time, late and repeated rows.

State lies in the state store of the query, so it is cleaned and restored with the
checkpoint. The session must use the RocksDB state store, as `build_session` sets it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.config import ERROR_WINDOW
from ledgerlens.functions.numbers import epoch_micros
from ledgerlens.streaming.arrow_state import packed, unpacked


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


# --- The last rows of a key ---------------------------------------------------
class LastRows(StatefulProcessor):
    """The last rows of a key in order of arrival; rows of one batch are in order of time.

    With `share` it hands on the rows of a batch that are among the last ones, for another
    step to merge; else the share of failures among the last rows.
    """

    def __init__(self, keys: Sequence[str], rows: int, share: bool):
        self.keys, self.rows, self.share = list(keys), rows, share

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", "failed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = None
        for batch in rows:  # no more than the last rows are held
            both = batch if fresh is None else pd.concat([fresh, batch], ignore_index=True)
            fresh = both.sort_values(["at", "event_id"], kind="stable").iloc[-self.rows:]
        named = {c: pd.Series([k] * len(fresh), dtype=object) for c, k in zip(self.keys, key)}
        if self.share:
            yield pd.DataFrame({**named, **{c: fresh[c].to_numpy() for c in ("at", "event_id", "failed")}})
            return
        kept = np.frombuffer(bytes(self.state.get()[0]), np.int8) if self.state.exists() else np.zeros(0, np.int8)
        kept = np.concatenate([kept, fresh["failed"].to_numpy(np.int8)])[-self.rows:]
        self.state.update((kept.tobytes(),))
        yield pd.DataFrame({**{c: v.iloc[:1] for c, v in named.items()}, "error_rate": [kept.sum() / len(kept)], "n": [len(kept)]})

    def close(self) -> None:
        pass


def rolling_error_rates(requests: DataFrame, keys: Sequence[str], rows: int = ERROR_WINDOW, parts: int = 32) -> DataFrame:
    """Per batch and key that has requests in it, the share of failures among its last `rows` requests.

    Requests of a batch are in order of (ts, event_id), later batches count as newer. A key's
    requests are spread over `parts` tasks, of which each hands on `rows` at most; the
    key's own task sees those. The state is one ring of `rows` outcomes a key.
    """
    keys = list(keys)
    spread = requests.select(
        *keys, F.pmod(F.xxhash64("event_id"), F.lit(parts)).cast("int").alias("_share"), epoch_micros(F.col("ts")).alias("at"), "event_id",
        F.when(F.col("ok"), 0).otherwise(1).cast("tinyint").alias("failed"))
    named = _fields(requests, keys)
    last = spread.groupBy(*keys, "_share").transformWithStateInPandas(
        statefulProcessor=LastRows(keys, rows, True), outputStructType=f"{named}, at bigint, event_id bigint, failed tinyint",
        outputMode="Append", timeMode="None")
    return last.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=LastRows(keys, rows, False), outputStructType=f"{named}, error_rate double, n bigint",
        outputMode="Append", timeMode="None")


# --- Counters in order of time ------------------------------------------------
class CounterSpan(StatefulProcessor):
    """Increases inside one span of time of a counter; samples wait until the watermark has passed them, then come in order of time.

    Those that come at once are a lot. Its first sample has no increase yet; it has `closes`, the value of the
    lot's last sample, by which the series goes on.
    """

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the samples that wait; the time of the one timer, in ms
        self.state = handle.getValueState("span", "waiting binary, timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, timer = self.state.get() if self.state.exists() else (None, -1)
        fresh = pd.concat(list(rows), ignore_index=True)[["at", "sample_id", "value"]].dropna()
        if waiting is not None:
            fresh = pd.concat([unpacked(waiting), fresh], ignore_index=True)
        if len(fresh):
            self._wait(fresh, timer)
        return iter(())

    def _wait(self, waiting: pd.DataFrame, timer: int) -> None:
        due = -(-int(waiting["at"].min()) // 1000) if len(waiting) else -1
        if timer >= 0 and timer != due:
            self.handle.deleteTimer(timer)
        if due >= 0 and timer != due:
            self.handle.registerTimer(due)
        if len(waiting):
            self.state.update((packed(waiting), due))
        else:
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, timer = self.state.get()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = unpacked(waiting).sort_values(["at", "sample_id"], kind="stable", ignore_index=True)
        ready, rest = rows[rows["at"] <= passed], rows[rows["at"] > passed]
        if len(ready):
            value = ready["value"].to_numpy(float)
            first = np.arange(len(ready)) == 0
            yield pd.DataFrame({
                **{c: pd.Series([k] * len(ready), dtype=object) for c, k in zip(self.keys, key)}, "sample_id": ready["sample_id"].to_numpy("int64"),
                "ts": pd.to_datetime(ready["at"].to_numpy("int64"), unit="us", utc=True), "value": value,
                "increase": np.where(first, np.nan, _increases(value, np.nan)), "closes": np.where(first, value[-1], np.nan)})
        self._wait(rest, -1 if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)

    def close(self) -> None:
        pass


def _increases(value: np.ndarray, before: float | np.ndarray) -> np.ndarray:
    """From the value before each one, nan where there is none; a number is that before the first one."""
    if np.isscalar(before):
        before = np.concatenate([[before], value[:-1]])
    return np.where(np.isnan(before), 0.0, np.where(value < before, value, value - before))


class CounterSeries(StatefulProcessor):
    """Joins the lots of a counter: only their first samples are held; all others pass as they come. State is the last value."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", "last double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns, held = [*self.keys, "sample_id", "ts", "value", "increase"], []
        for batch in rows:
            opens = batch["closes"].notna()
            held.append(batch[opens])
            if not opens.all():
                yield batch.loc[~opens, columns]
        firsts = pd.concat(held, ignore_index=True).sort_values("ts", kind="stable", ignore_index=True)
        if len(firsts):
            closes = firsts["closes"].to_numpy(float)
            before = np.concatenate([[self.state.get()[0] if self.state.exists() else np.nan], closes[:-1]])
            firsts["increase"] = _increases(firsts["value"].to_numpy(float), before)
            self.state.update((float(closes[-1]),))
            yield firsts[columns]

    def close(self) -> None:
        pass


def counter_increase_stream(samples: DataFrame, series: Sequence[str], late: str = "10 minutes", span: int = 3600) -> DataFrame:
    """(series, sample_id, ts, value, increase) of a stream of samples, each once the watermark has passed it.

    As `operators.telemetry.counter_increase`: a drop means that the counter began again at 0,
    and the first sample has no increase. Samples may come in any order within
    `late`; those behind the watermark are left out. Samples without a value, time or id do not count.

    Samples wait by `span` seconds of a series, so a task holds those of one span, whatever the delay; the
    series' own step holds one sample a span.
    """
    series = list(series)
    # a worker takes a null span for another key's, so samples without a time go before
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).where("ts IS NOT NULL").select(
        *series, "ts", F.floor(F.unix_seconds("ts") / F.lit(span)).cast("long").alias("_span"), epoch_micros(F.col("ts")).alias("at"), "sample_id",
        F.col("value").cast("double").alias("value"))
    named = f"{_fields(samples, series)}, sample_id bigint, ts timestamp, value double, increase double"
    # without the watermark's mark on its time, no sample of a lot is dropped between the steps
    lots = timed.groupBy(*series, "_span").transformWithStateInPandas(
        statefulProcessor=CounterSpan(series), outputStructType=f"{named}, closes double", outputMode="Append", timeMode="EventTime")
    return lots.groupBy(*series).transformWithStateInPandas(
        statefulProcessor=CounterSeries(series), outputStructType=named,
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="ts")


def increase_per_range_stream(samples: DataFrame, series: Sequence[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Increase per series and tumbling range, each once the watermark has passed its end."""
    grown = counter_increase_stream(samples, series, late)
    return grown.groupBy(*series, F.window("ts", width)).agg(F.sum("increase").alias("increase")).select(
        *series, F.col("window.start").alias("range_start"), "increase")


# --- Late and repeated rows ---------------------------------------------------
class Arrivals(StatefulProcessor):
    """Tells kept, late and repeated rows of one share of the ids; state is the ids the watermark has not passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "ids binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        seen = unpacked(self.state.get()[0]) if self.state.exists() else None
        fresh = pd.concat(list(rows), ignore_index=True).sort_values(["at", "row"], kind="stable", ignore_index=True)
        late = (fresh["at"] <= passed).to_numpy()
        again = np.zeros(len(fresh), bool)  # a late row does not make one that is in time a repetition
        again[~late] = fresh["id"][~late].duplicated()
        if seen is not None:
            again |= fresh["id"].isin(seen["id"]).to_numpy() & ~late
        kept = fresh[["id", "at"]][~late & ~again]
        live = pd.concat([seen[seen["at"] > passed], kept], ignore_index=True) if seen is not None else kept
        if len(live):
            self.state.update((packed(live),))
        else:
            self.state.clear()
        yield pd.DataFrame({
            "row": pd.Series(fresh["row"].to_numpy(), dtype=object),
            "arrival": pd.Series(np.where(late, "late", np.where(again, "repeated", "kept")), dtype=object)})

    def close(self) -> None:
        pass


def arrivals(stream: DataFrame, key: str, late: str = "10 minutes", parts: int = 200) -> DataFrame:
    """All rows of a stream with `arrival`: kept, late (behind the watermark as its batch began), or repeated.

    No row is lost: what an event-time aggregate would drop is told apart, to be
    written beside the result. A row is repeated if one with its key was kept and the watermark
    has not passed that yet; a repetition that comes later is late. Rows without a time
    are late, those without a key are never repeated. Rows travel as JSON; ids are held while
    the watermark has not passed them, spread over `parts`.
    """
    kinds = stream.schema
    # without the watermark's mark on the column, Spark does not drop what is behind it
    packed_rows = stream.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", late).select(
        F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"), F.coalesce(epoch_micros(F.col("_ts")), F.lit(-1)).alias("at"),
        F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\x00"), F.uuid())).alias("id"), F.to_json(F.struct(*stream.columns)).alias("row"))
    told = packed_rows.groupBy("part").transformWithStateInPandas(
        statefulProcessor=Arrivals(), outputStructType="row string, arrival string", outputMode="Append", timeMode="EventTime")
    return told.select(F.from_json("row", kinds).alias("r"), "arrival").select("r.*", "arrival")
