"""A table of gauges that pushes change: merge or replace on write, put together on read.

A push adds a delta folder of its own, named by its version, so it moves only its own rows
and a push that is run again overwrites itself. An entry merges (it sets its metric) or
replaces (it drops all metrics that its job had before its push). Entries are ordered by
version, then by time; among replacing ones of a version, each job's last push counts.

    path/delta/version=7/bucket=3      entries: job, metric, value, push_id, ts, event_id, mode
    path/base/upto=5/bucket=3          what is left of the entries up to version 5, by bucket
    path/commits                       one row for each version and each base that is complete

Compaction rewrites the buckets that a new delta has touched and leaves the others at the
base they have. Readers take each bucket's last complete base and the deltas after it; a
folder without a commit row is not read, so a push or compaction that fails halfway
changes nothing. Jobs are spread over buckets by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_ENTRY = "job string, metric string, value double, push_id bigint, ts timestamp_ntz, event_id bigint, mode string, version bigint, bucket int"
_COMMITS = "kind string, version bigint"


class GaugeTable:
    """Gauges of (job, metric) under a path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _commit(self, kind: str, version: int) -> None:
        self.spark.createDataFrame([(kind, version)], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _committed(self, kind: str) -> list[int]:
        """Versions are one for each push; the driver lists as many as there are folders."""
        try:
            rows = self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits").where(F.col("kind") == kind).select("version").distinct().collect()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted(r["version"] for r in rows)

    def push(self, rows: DataFrame, version: int, mode: str = "merge") -> None:
        """Add entries: job, metric, value, push_id, ts, event_id. With `replace`, every push of a job stands alone.

        A null value changes nothing when merged, and a replacing push may have a row with a null metric
        only: it leaves the job without metrics. Versions must rise from push to push.
        """
        if mode not in ("merge", "replace"):
            raise ValueError(f"mode is {mode}")
        if mode == "merge":
            rows = rows.where("value IS NOT NULL AND metric IS NOT NULL")
        entries = rows.select(
            "job", "metric", F.col("value").cast("double").alias("value"), F.col("push_id").cast("long").alias("push_id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
            F.col("event_id").cast("long").alias("event_id"), F.lit(mode).alias("mode"), F.pmod(F.xxhash64("job"), F.lit(self.buckets)).cast("int").alias("bucket"))
        entries.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/version={version}")
        self._commit("delta", version)

    def _deltas(self) -> DataFrame:
        versions = self._committed("delta")
        if not versions:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/delta").where(F.col("version").isin(versions))

    def _bases(self) -> DataFrame:
        """Entries of each bucket's last complete base, with `upto`."""
        bases = self._committed("base")
        if not bases:
            return self.spark.createDataFrame([], f"{_ENTRY}, upto bigint")
        rows = self.spark.read.schema(f"{_ENTRY}, upto bigint").parquet(f"{self.path}/base").where(F.col("upto").isin(bases))
        last = rows.groupBy("bucket").agg(F.max("upto").alias("_upto"))
        return rows.join(last, "bucket").where("upto = _upto").drop("_upto")

    def _entries(self) -> tuple[DataFrame, DataFrame]:
        """Entries that count: those of the bases, and those of deltas after the base of their bucket."""
        bases = self._bases()
        since = bases.groupBy("bucket").agg(F.max("upto").alias("_upto"))
        after = self._deltas().join(since, "bucket", "left").where("_upto IS NULL OR version > _upto").drop("_upto")
        return bases.drop("upto"), after

    @staticmethod
    def _left(entries: DataFrame) -> DataFrame:
        """Entries that no later one drops: of each job those from its last replacing push on, of each metric the last one.

        A job's last replacing push keeps a row without a metric, so that what it dropped stays dropped.
        """
        at: Column = F.struct("version", "push_id")
        replaced = entries.where("mode = 'replace'").groupBy(F.col("job").alias("_job")).agg(F.max(at).alias("_from"))
        kept = entries.join(replaced, F.col("job").eqNullSafe(F.col("_job")), "left").where(F.col("_from").isNull() | (at >= F.col("_from")))
        rest = [c for c in entries.columns if c not in ("job", "metric")]
        order = F.struct("version", "ts", "event_id")
        last = kept.where("metric IS NOT NULL").groupBy("job", "metric").agg(F.max_by(F.struct(*rest), order).alias("r")).select("job", "metric", "r.*")
        marks = entries.where("mode = 'replace'").groupBy("job").agg(F.max_by(F.struct(*rest), order).alias("r")).select(
            "job", F.lit(None).cast("string").alias("metric"), "r.*").withColumn("value", F.lit(None).cast("double"))
        return last.unionByName(marks).select(*entries.columns)

    def compact(self) -> list[int]:
        """Write new bases for the buckets that have entries after theirs; returns those buckets."""
        base, after = self._entries()
        upto = max(self._committed("delta"), default=-1)
        touched = sorted(r["bucket"] for r in after.select("bucket").distinct().collect())
        if touched:
            whole = base.where(F.col("bucket").isin(touched)).unionByName(after.select(base.columns))
            self._left(whole).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/upto={upto}")
            self._commit("base", upto)
        return touched

    def read(self) -> DataFrame:
        """(job, metric, value) after all pushes."""
        base, after = self._entries()
        return self._left(base.unionByName(after.select(base.columns))).where("metric IS NOT NULL").select("job", "metric", "value")
