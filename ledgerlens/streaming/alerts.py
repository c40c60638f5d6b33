"""Alert states over a stream of ticks, with one small state per alert."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATES = ("inactive", "pending", "firing", "resolved")
TRANSITIONS = "alertname string, severity string, tick_no bigint, state string"


class HoldTimer(StatefulProcessor):
    """Tracks when a condition became active and reports changes of the alert state.

    Rows of one batch are put in tick order; ticks that come in a later batch
    than a newer tick are ignored, as an evaluator that has moved on would.
    """

    def __init__(self, step_seconds: int):
        self.step = step_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("alert", "since bigint, last_tick bigint, code int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last, code = self.state.get() if self.state.exists() else (-1, -1, 0)
        ticks = pd.concat(list(rows)).sort_values("tick_no")
        ticks = ticks[ticks["tick_no"] > last]
        if ticks.empty:
            return
        tick, active = ticks["tick_no"].to_numpy(), ticks["active"].to_numpy(dtype=bool)
        hold = -(-int(ticks["hold_seconds"].iloc[0]) // self.step)
        before = np.concatenate([[code > 0], active[:-1]])
        began = np.where(active & ~before, tick, -1)
        began[0] = max(began[0], since)
        began = np.maximum.accumulate(began)
        codes = np.where(active, np.where(tick - began >= hold, 2, 1), 0)
        earlier = np.concatenate([[code], codes[:-1]])
        shown = np.where((codes == 0) & (earlier == 2), 3, codes)
        changed = codes != earlier
        self.state.update((int(began[-1]), int(tick[-1]), int(codes[-1])))
        yield pd.DataFrame({
            "alertname": key[0], "severity": key[1], "tick_no": tick[changed],
            "state": np.array(STATES, dtype=object)[shown[changed]],
        })

    def close(self) -> None:
        pass


def alert_transition_stream(conditions: DataFrame, step_seconds: int = 15) -> DataFrame:
    """State changes of a stream of (tick_no, alertname, severity, hold_seconds, active).

    The rows may come from a table or straight from `service_signal_stream`, by
    `operators.alerts.rule_conditions`.

    There is one row per rule and tick, whatever the traffic, so the rows of a
    key in a batch are as many as the ticks it covers. The session must use the
    RocksDB state store, as `build_session` sets it.
    """
    return conditions.groupBy("alertname", "severity").transformWithStateInPandas(
        statefulProcessor=HoldTimer(step_seconds), outputStructType=TRANSITIONS,
        outputMode="Append", timeMode="None")
