"""Counts, shares and profiles of labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.functions.numbers import safe_ratio
from ledgerlens.functions.text import strip, tokens
from ledgerlens.operators.sizing import written


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str = "category") -> DataFrame:
    """Rows per value, missing values left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def shares_of_counts(counts: DataFrame, count: str = "n", share: str = "share") -> DataFrame:
    """Add each count's share of the total. The input is a grouped table.

    An all-zero table gives shares of 0.
    """
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(share, safe_ratio(F.col(count), total))


def value_shares(df: DataFrame, column: str = "category") -> DataFrame:
    """Share of each value; rows without a value are not in the denominator."""
    return shares_of_counts(value_counts(df, column))


def mean_length(df: DataFrame, column: str = "description") -> DataFrame:
    return df.agg(F.avg(F.length(column)).alias("description_avg_length"))


def distinct_values(df: DataFrame, column: str = "category") -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def baseline_profile(df: DataFrame) -> DataFrame:
    """One row: total rows, rows per category as a map, mean text length.

    The large table is grouped once; the map and the totals come from the
    grouped rows.
    """
    grouped = df.groupBy("category").agg(
        F.count("*").alias("n"),
        F.sum(F.length("description")).alias("chars"),
        F.count("description").alias("texts"),
    )
    labelled = F.when(F.col("category").isNotNull(), F.struct("category", "n"))
    return grouped.agg(
        F.sum("n").alias("total_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(labelled))).alias("category_distribution"),
        F.try_divide(F.sum("chars").cast("double"), F.sum("texts").cast("double")).alias("description_avg_length"),
    )


def token_frequency(df: DataFrame, column: str = "description") -> DataFrame:
    """Occurrences of each word over all texts (counted per task first)."""
    return (
        df.select(F.explode(tokens(F.col(column))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def top_values(df: DataFrame, k: int = 3, column: str = "category") -> DataFrame:
    """The k most frequent values, ties by name."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def length_histogram(df: DataFrame, by: str = "split", column: str = "description", bins: int = 40) -> DataFrame:
    """Rows per equal-width length bin and split; all splits share the bins.

    Lengths are grouped first, so the bin edges and the counts come from one
    pass over the texts.
    """
    lengths = written(
        df.groupBy(by, F.length(column).alias("len")).agg(F.count("*").alias("n")).where("len IS NOT NULL"))
    edges = lengths.agg(F.min("len").alias("lo"), F.max("len").alias("hi"))
    low, high = edges.select("lo").scalar(), edges.select("hi").scalar()
    width = F.greatest((F.col("hi") - F.col("lo")) / F.lit(float(bins)), F.lit(1e-9))
    bin_no = F.least(F.floor((F.col("len") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    return (
        lengths.withColumn("lo", low).withColumn("hi", high)
        .groupBy(by, bin_no.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )


def label_fallback(df: DataFrame, actual: str = "actual_category", predicted: str = "predicted_category") -> DataFrame:
    """Rows with `label`: the actual category, else the predicted one.

    Empty text counts as missing; rows with neither are dropped.
    """
    def present(name):
        return F.nullif(F.col(name), F.lit(""))

    return df.withColumn("label", F.coalesce(present(actual), present(predicted))).where("label IS NOT NULL")


def feedback_label_counts(df: DataFrame) -> DataFrame:
    return label_fallback(df).groupBy("label").agg(F.count("*").alias("n"))


def non_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed lines without the blank ones."""
    return lines.select(strip(F.col(column)).alias("description")).where(F.length("description") > 0)
