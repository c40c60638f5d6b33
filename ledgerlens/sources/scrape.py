"""A stream of samples scraped from counter snapshots at a fixed cadence.

A target leaves its metrics as text files, `path/job=<job>/hour=<n>/<seconds>.prom`, where
n counts hours since 1970. A scrape takes place at every multiple of `interval` seconds and
reads the target's last snapshot since the scrape before. It gives a row for each sample,
and `up` = 1; a scrape that finds no snapshot gives `up` = 0, marked stale, and nothing else.
A target counts from its first snapshot on.

    spark.dataSource.register(ScrapeSource)
    spark.readStream.format("scrape").option("interval", 10).load(path)

Offsets of the stream are scrape times, so a query that starts again from its
checkpoint goes on with the scrape after its last one. A scrape is done once a snapshot of
that moment or later is there. The driver lists folders of hours; tasks read the files of
one target and some hours each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_HOUR = 3600
_SAMPLE = re.compile(r"^([A-Za-z_:][A-Za-z0-9_:]*)(\{.*\})?\s+(\S+)")


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _names(system: fs.FileSystem, path: str, pattern: str) -> dict:
    """Entries of a folder whose names match, by what the pattern's group holds."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    hits = ((re.fullmatch(pattern, info.base_name), info.path) for info in found)
    return {m.group(1): where for m, where in hits if m}


def _snapshots(system: fs.FileSystem, folder: str) -> dict[int, str]:
    return {int(s): where for s, where in _names(system, folder, r"(\d+)\.prom").items()}


def samples_of(text: str) -> Iterator[tuple[str, str, float]]:
    """(name, labels, value) of the lines of a snapshot; comments and what is no sample are passed over."""
    for line in text.splitlines():
        found = _SAMPLE.match(line)
        if found:
            try:
                yield found.group(1), (found.group(2) or "{}")[1:-1], float(found.group(3))
            except ValueError:
                continue


@dataclass
class _Scrapes(InputPartition):
    job: str
    path: str
    after: int
    upto: int


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, interval: int, hours: int):
        self.path, self.interval, self.hours = path, interval, hours

    def _jobs(self) -> tuple[fs.FileSystem, dict[str, str]]:
        system, path = place(self.path)
        return system, _names(system, path, "job=(.+)")

    def initialOffset(self) -> dict:
        system, jobs = self._jobs()
        hours = [int(h) for folder in jobs.values() for h in _names(system, folder, r"hour=(\d+)")]
        return {"at": min(hours, default=0) * _HOUR - 1}

    def latestOffset(self) -> dict:
        system, jobs = self._jobs()
        last = [self.initialOffset()["at"]]
        for folder in jobs.values():
            hours = _names(system, folder, r"hour=(\d+)")
            if hours:
                newest = _snapshots(system, hours[max(hours, key=int)])
                last += [max(newest, default=0) // self.interval * self.interval]
        return {"at": max(last)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        step = self.hours * _HOUR
        _, jobs = self._jobs()
        cuts = [start["at"], *range((start["at"] // step + 1) * step, end["at"], step), end["at"]]
        return [_Scrapes(job, folder, a, b) for job, folder in sorted(jobs.items()) for a, b in zip(cuts, cuts[1:]) if a < b]

    def read(self, partition: _Scrapes) -> Iterator[tuple]:
        system, _ = place(self.path)
        hours = {int(h): where for h, where in _names(system, partition.path, r"hour=(\d+)").items()}
        if not hours:
            return
        begins = min(_snapshots(system, hours[min(hours)]))
        first = (partition.after // self.interval + 1) * self.interval
        held: dict[int, str] = {}
        for h in range((first - self.interval) // _HOUR, partition.upto // _HOUR + 1):
            if h in hours:
                held |= _snapshots(system, hours[h])
        times, k = sorted(held), 0
        for at in range(first, partition.upto + 1, self.interval):
            last = None
            while k < len(times) and times[k] <= at:
                last = times[k] if times[k] > at - self.interval else None
                k += 1
            if at < begins:
                continue
            moment = datetime.fromtimestamp(at, timezone.utc)
            if last is None:
                yield partition.job, moment, "up", "", 0.0, True
                continue
            yield partition.job, moment, "up", "", 1.0, False
            with system.open_input_stream(held[last]) as file:
                for name, labels, value in samples_of(file.read().decode()):
                    yield partition.job, moment, name, labels, value, False


class ScrapeSource(DataSource):
    """`scrape`: path, `interval` in seconds (10), `hours` that a task reads at most (24)."""

    @classmethod
    def name(cls) -> str:
        return "scrape"

    def schema(self) -> str:
        return "job string, at timestamp, name string, labels string, value double, stale boolean"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("interval", 10)), int(self.options.get("hours", 24)))
