"""What is sent about firing alerts: groups, waits, repeats, and silence of the inhibited.

Stretches are rows of a member of a group (an alert with its labels) that fires from
`fires_at` to before `ends_at`, null if it still fires; times are whole numbers of one
unit. Stretches of one member do not overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.operators.ordered import running
from ledgerlens.operators.sizing import written

NOTICE = "at_seconds bigint, kind string, firing array<string>, resolved array<string>"


def joined_stretches(stretches: DataFrame, keys: Sequence[str], gap: int = 0) -> DataFrame:
    """Per key the unions of stretches that overlap, touch or lie at most `gap` apart: keys, fires_at, ends_at.

    No window holds a key: the furthest end so far comes from running maxima over ranges.
    """
    far = F.coalesce(F.col("ends_at"), F.lit((1 << 62) - 1))
    rows = written(stretches.select(*keys, "fires_at", far.alias("_end")), "stretches")
    before = running(rows, keys, ["fires_at", "_end"], maxes={"_reach": F.col("_end")}, include_current=False)
    begins = F.when(F.col("_reach").isNull() | (F.col("fires_at") > F.col("_reach") + gap), F.col("fires_at"))
    marked = running(before.select(*keys, "fires_at", "_end", begins.alias("_begins")), keys, ["fires_at", "_end"], maxes={"_from": F.col("_begins")})
    return marked.groupBy(*keys, F.col("_from").alias("fires_at")).agg(F.max("_end").alias("_end")).select(
        *keys, "fires_at", F.when(F.col("_end") < (1 << 62) - 1, F.col("_end")).alias("ends_at"))


def _cut(stretches: DataFrame, end: Column, bucket: int) -> DataFrame:
    """Stretches cut at multiples of `bucket`; a long one is several rows, so none meets many others in one row."""
    rows = stretches.withColumn("ends_at", F.coalesce("ends_at", end)).where(F.col("ends_at") > F.col("fires_at"))
    first, last = F.floor(F.col("fires_at") / bucket), F.floor((F.col("ends_at") - 1) / bucket)
    rows = rows.withColumn("_bucket", F.explode(F.sequence(first, last)))
    return rows.withColumns({
        "fires_at": F.greatest("fires_at", F.col("_bucket") * bucket), "ends_at": F.least("ends_at", (F.col("_bucket") + 1) * bucket)})


def inhibited_time(stretches: DataFrame, end: Column, on: Sequence[str] = ("alertname",), bucket: int = 3600) -> DataFrame:
    """When warnings are hidden: each warning's stretch cut to the time in which a critical alert with equal `on` fires.

    The columns of the stretches; a hidden time may be several rows that touch, one a
    bucket. `end` is just behind the last time evaluated and closes open stretches. The join
    is by key and bucket, so a key that fires for long is spread over many buckets.
    """
    covers = _cut(joined_stretches(stretches.where("severity = 'critical'"), on), end, bucket).select(
        *[F.col(c).alias(f"_{c}") for c in on], F.col("_bucket").alias("_at"), F.col("fires_at").alias("_from"), F.col("ends_at").alias("_to"))
    warnings = _cut(stretches.where("severity = 'warning'"), end, bucket)
    same = [warnings[c].eqNullSafe(covers[f"_{c}"]) for c in on]
    meets = [warnings["_bucket"] == covers["_at"], warnings["fires_at"] < covers["_to"], covers["_from"] < warnings["ends_at"]]
    found = warnings.join(covers, [*same, *meets])
    shown = {"fires_at": F.greatest("fires_at", "_from"), "ends_at": F.least("ends_at", "_to")}
    return found.select(*[shown.get(c, F.col(c)).alias(c) for c in stretches.columns])


def shown_time(stretches: DataFrame, end: Column, on: Sequence[str] = ("alertname",), labels: Sequence[str] = ("alertname", "severity"),
               bucket: int = 3600) -> DataFrame:
    """The stretches without inhibited time: (labels, fires_at, ends_at), whole pieces, open ones closed at `end`."""
    pieces = written(_cut(stretches.select(*labels, "fires_at", "ends_at"), end, bucket), "pieces")
    hidden = inhibited_time(stretches.select(*labels, "fires_at", "ends_at"), end, on, bucket).withColumn(
        "_bucket", F.floor(F.col("fires_at") / bucket))
    cuts = hidden.groupBy(*labels, "_bucket").agg(F.sort_array(F.collect_list(F.struct("fires_at", "ends_at"))).alias("_cuts"))
    key = [F.struct(*labels, "_bucket").alias("_key")]
    cuts = cuts.select(*key, "_cuts")
    met = pieces.select("*", *key).join(cuts, "_key", "left")
    # what is left of a piece lies between the ends of its cuts; cuts of other pieces in the bucket have no part in it
    own = F.filter(F.coalesce("_cuts", F.array().cast("array<struct<fires_at:bigint,ends_at:bigint>>")),
                   lambda c: (c["fires_at"] < F.col("ends_at")) & (c["ends_at"] > F.col("fires_at")))
    froms = F.concat(F.array("fires_at"), F.transform(own, lambda c: c["ends_at"]))
    tos = F.concat(F.transform(own, lambda c: c["fires_at"]), F.array("ends_at"))
    left = F.filter(F.arrays_zip(froms.alias("f"), tos.alias("t")), lambda p: p["f"] < p["t"])
    parts = met.select(*labels, F.inline(left).alias("fires_at", "ends_at"))
    return joined_stretches(parts, labels)


class _Group:
    """The flushes of one group, from its first firing member on."""

    def __init__(self, wait: int, interval: int, repeat: int, end: int):
        self.wait, self.interval, self.repeat, self.end = wait, interval, repeat, end

    def run(self, rows: pd.DataFrame) -> list[tuple[int, str, list[str], list[str]]]:
        never = np.iinfo(np.int64).max
        far = rows["ends_at"].fillna(never).astype("int64")
        changes = sorted([*zip(rows["fires_at"], [1] * len(rows), rows["hidden"], rows["member"]), *zip(far, [-1] * len(rows), rows["hidden"], rows["member"])])
        starts = np.sort(rows.loc[~rows["hidden"], "fires_at"].to_numpy("int64"))
        firing, hidden, named, sent = set(), set(), set(), []
        at, last, k = int(starts[0]) + self.wait, None, 0
        while at <= self.end:
            while k < len(changes) and changes[k][0] <= at:
                _, step, is_hidden, member = changes[k]
                held = hidden if is_hidden else firing
                held.add(member) if step > 0 else held.discard(member)
                k += 1
            shown, gone = firing - hidden, named - firing
            if shown - named or gone or shown and last is not None and at - last >= self.repeat:
                sent.append((at, "firing" if shown else "resolved", sorted(shown), sorted(gone)))
                named, last = set(shown), at
            if firing:
                at += self.interval
                continue
            named, last = set(), None
            following = starts[np.searchsorted(starts, at, "right"):]
            if not len(following):
                break
            at = int(following[0]) + self.wait
        return sent


def group_notices(stretches: DataFrame, end: Column, hidden: DataFrame | None = None, group: Sequence[str] = ("alertname", "severity"),
                  wait: int = 30, interval: int = 300, repeat: int = 900) -> DataFrame:
    """(group, at_seconds, kind, firing, resolved): the notices of each group, with the members they name.

    A group begins when a member fires while there is none. It is flushed `wait` later and
    then every `interval`, until a flush at which no member fires ends it. A flush sends a
    notice if a member fires that the last notice did not name, if one that it named
    fires no more, or if members fire and the last notice is `repeat` old; else none, so a
    member that stops and fires again between two flushes is no change. Members are not
    named while `hidden` has them (stretches of the same columns), and nothing is sent for
    them; they keep their group alive. What fires and stops between flushes is never named.
    The kind is `firing` if the notice names a firing member, else `resolved`. Flushes
    end before `end`.

    Stretches have the group's columns, `member`, fires_at, ends_at in seconds. Groups
    that rest for longer than `wait` and `interval` are cut there, and the parts run side
    by side; a part holds its stretches and one set of members, and takes a step a flush.
    """
    keys = list(group)
    stretches = stretches.withColumn("member", F.coalesce("member", F.lit("")))
    alive = joined_stretches(stretches, keys, wait + interval).select(
        *[F.col(c).alias(f"_{c}") for c in keys], F.col("fires_at").alias("_start"), F.coalesce("ends_at", F.lit((1 << 62) - 1)).alias("_until"))
    rows = stretches.select(*keys, "member", "fires_at", "ends_at", F.lit(False).alias("hidden"))
    if hidden is not None:
        rows = rows.unionByName(hidden.select(*keys, F.coalesce("member", F.lit("")).alias("member"), "fires_at", "ends_at", F.lit(True).alias("hidden")))
    # the part of a row is the last one of its group that begins no later: running over parts and rows in one order
    both = rows.select("*", F.lit(None).cast("long").alias("_start"), F.lit(1).alias("_kind")).unionByName(
        alive.select(*[F.col(f"_{c}").alias(c) for c in keys], F.lit(None).cast("string").alias("member"), F.col("_start").alias("fires_at"),
                     F.lit(None).cast("long").alias("ends_at"), F.lit(False).alias("hidden"), "_start", F.lit(0).alias("_kind")))
    placed = running(written(both, "parts"), keys, ["fires_at", "_kind", "hidden", "member"], maxes={"_of": F.col("_start")})
    last = stretches.sparkSession.range(1).select(end.cast("long")).first()[0]
    machine = _Group(wait, interval, repeat, last - 1)
    names = {c: rows.schema[c].dataType.simpleString() for c in keys}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sent = machine.run(rows)
        columns = {c: [rows[c].iloc[0]] * len(sent) for c in keys}
        columns |= {c: [s[i] for s in sent] for i, c in enumerate(("at_seconds", "kind", "firing", "resolved"))}
        return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in columns.items()}).astype({"at_seconds": "int64"})

    parts = placed.where("_kind = 1 AND _of IS NOT NULL").select(*keys, "_of", "member", "fires_at", "ends_at", "hidden")
    return parts.groupBy(*keys, "_of").applyInPandas(run, f"{', '.join(f'{c} {k}' for c, k in names.items())}, {NOTICE}")
