"""Spend per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.functions.numbers import half_even
from ledgerlens.functions.text import money_text


def spend_by_category(df: DataFrame, category: str = "predicted_category", amount: str = "amount") -> DataFrame:
    return df.groupBy(F.col(category).alias("category")).agg(F.sum(amount).alias("amount"))


def with_percentage(spend: DataFrame) -> DataFrame:
    """Add each category's percentage of the total. The input has one row per category."""
    total = F.sum("amount").over(Window.partitionBy())
    return spend.withColumn("percentage", F.coalesce(F.try_divide(F.col("amount"), total) * 100, F.lit(0.0)))


def spend_summary(spend: DataFrame) -> DataFrame:
    """Display table, largest amount first."""
    ranked = with_percentage(spend).orderBy(F.desc("amount"), "category")
    return ranked.select(
        "category",
        money_text(F.col("amount")).alias("amount"),
        F.format_string("%.1f%%", half_even(F.col("percentage"), 1)).alias("percentage"),
    )
