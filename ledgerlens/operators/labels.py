"""Label indices: build, apply, decode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.operators.profile import distinct_values
from ledgerlens.operators.sizing import written


def label_index(df: DataFrame, column: str = "category") -> DataFrame:
    """(label_idx, category): labels sorted by name, numbered from 0.

    The window covers the distinct labels only.
    """
    return written(number_labels(distinct_values(df, column), column))


def number_labels(labels: DataFrame, column: str = "category") -> DataFrame:
    """Number distinct labels by name, from 0."""
    return labels.select((F.row_number().over(Window.orderBy(column)) - 1).alias("label_idx"), column)


def encode_labels(df: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """Add `label_idx`; labels outside the index are dropped."""
    return df.join(labels.select(column, "label_idx"), column).select(*df.columns, "label_idx")


def decode_labels(df: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """Replace `label_idx` by the label name; unknown indices are dropped."""
    keep = [c for c in df.columns if c != "label_idx"]
    return df.join(labels.select("label_idx", column), "label_idx").select(column, *keep)


def decode_counts(counts: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """Shares of indexed counts under their label names.

    Undecodable indices vanish from the result but stay in the total.
    """
    total = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))
    shares = counts.withColumn("share", F.col("n") / total)
    return decode_labels(shares, labels, column)
