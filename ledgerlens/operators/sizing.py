"""Materialise tables that are read several times or joined as a small side.

The plan-time estimate of an aggregated table is the size of its input, so a
join against ten label rows would shuffle the large side. Once written, such a
table reports its real size: below `spark.sql.autoBroadcastJoinThreshold` Spark
broadcasts it, above it the join is a shuffled one with skew handling. Nothing is
forced, nothing passes through the driver, and the path is the same at any size.
Writing also ends the lineage, so plans stay short and a lost executor costs no
recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.session import work_folder


def written(df: DataFrame, purpose: str = "table") -> DataFrame:
    """The table, written once to the shared working folder and read back."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> DataFrame:
    """A one-row result, such as an aggregate without keys, as a literal of the plan."""
    return df.sparkSession.createDataFrame(df.limit(1).toArrow(), schema=df.schema)
