"""Running aggregates over ordered series without one task per series.

A plain window with `partitionBy(series)` sorts a whole series in one task; a
series that holds a third of all rows would not finish. Here the rows are
partitioned by range of (series, order) once, so parts have about equal numbers
of rows whether they hold many series or a piece of one, and whatever the clock
says. The window runs inside (series, part); a small table of totals carries what
came before the part, which only concerns series that go on from the part before.
Sum, count and max compose this way, and `lag` is the max of (order, value) pairs
before the row.

Parts are written to the shared folder with their numbers, since a task that is
run again must find its rows where the totals saw them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerlens.operators.sizing import written

_PART = "_part"


def _slot(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Key columns without nulls, so that window and join share one partitioning.

    A null key becomes a default value and a flag.
    """
    out = {}
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        default = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind)
        out[f"_k{i}"] = F.coalesce(F.col(key), default)
        out[f"_n{i}"] = F.col(key).isNull()
    return out


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Add running sums, maxes and last non-null values per series.

    `order` must be unique inside a series for a defined result. With
    `include_current=False` the aggregates cover the rows strictly before each
    row. The input is computed twice, once to find the ranges; hand over a
    written table where it is costly.
    """
    sums, maxes, lasts = sums or {}, maxes or {}, lasts or {}
    place = F.struct(*order)
    series = _slot(df, keys)
    slot = [*series, _PART]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        df.withColumns(series).repartitionByRange(parts, *series, *order).withColumn(_PART, F.spark_partition_id()), "ranges")

    earlier = Window.partitionBy(*series).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        placed.groupBy(*slot).agg(
            *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()],
            *[F.max(c).alias(f"_t_{n}") for n, c in maxes.items()],
            *[F.max_by(c, F.when(c.isNotNull(), place)).alias(f"_t_{n}") for n, c in lasts.items()],
        )
        .select(
            *slot,
            *[F.sum(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in sums],
            *[F.max(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in maxes],
            *[F.last(f"_t_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in lasts],
            F.count("*").over(earlier).alias("_before"),
        )
        # a part has one series at most that began before it
        .where("_before > 0")
    )

    last = 0 if include_current else -1
    inside = Window.partitionBy(*slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    local = placed.select(
        "*",
        *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in sums.items()],
        *[F.max(c).over(inside).alias(f"_l_{n}") for n, c in maxes.items()],
        *[F.last(c, ignorenulls=True).over(inside).alias(f"_l_{n}") for n, c in lasts.items()],
    )
    return local.join(carry, slot, "left").select(
        *df.columns,
        *[
            (F.coalesce(f"_l_{n}", F.lit(0)) + F.coalesce(f"_c_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.greatest(f"_l_{n}", f"_c_{n}").alias(n) for n in maxes],
        *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in lasts],
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Add `prev_<column>`: the value of the row before, null on the first row."""
    packed = F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"v_{c}") for c in columns])
    out = running(df, keys, order, maxes={"_prev": packed}, include_current=False)
    return out.select(*df.columns, *[F.col(f"_prev.v_{c}").alias(f"prev_{c}") for c in columns])


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Add the dense 1-based position of each row inside its series."""
    return running(df, keys, order, sums={name: F.lit(1).cast("long")})


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    rows: int,
    name: str,
    chunk_rows: int = 50_000,
) -> DataFrame:
    """Mean of the last `rows` values per series, current row included.

    Rows get their position first; then a series is cut into chunks of
    `chunk_rows` and the last `rows - 1` rows of a chunk are repeated at the
    head of the next one. Each window task therefore sees a bounded number of
    rows however long a series is.
    """
    chunk_rows = max(chunk_rows, rows)
    placed = with_position(df.withColumn("_value", value), keys, order, "_pos")
    chunk = F.floor((F.col("_pos") - 1) / chunk_rows)
    offset = (F.col("_pos") - 1) % chunk_rows
    homes = F.when(offset >= chunk_rows - (rows - 1), F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = placed.withColumn("_own", chunk).withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumn(name, F.avg("_value").over(frame))
        .where(F.col("_own") == F.col("_chunk"))
        .select(*df.columns, name)
    )
