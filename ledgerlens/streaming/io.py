"""Stream sources, and sinks that survive a replayed batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def stream_parquet(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
                   files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files in a folder, all or those whose name matches the pattern."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The files of the table `name`, which is one Parquet file or a folder of them.

    A path with a pattern may name either; without one, a stream takes folders only.
    """
    return spark.readStream.schema(schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Run `handle(batch, batch_id)` per micro-batch.

    Without `every` the query works off what is there and stops.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own folder; a replay overwrites the same folder."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return handle


def start_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    return start_batches(stream, batch_writer(path), checkpoint, mode, every)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All written rows with their `batch_id`."""
    return spark.read.parquet(path)


def latest_state(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of all updates the last one per key: the result table of an update stream."""
    rest = [c for c in batches.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), F.col("batch_id")).alias("_r")
    return batches.groupBy(*keys).agg(last).select(*keys, *[f"_r.{c}" for c in rest])
