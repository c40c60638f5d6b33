"""Data quality: schema checks, null handling, allow-lists, rule checks, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.config import MAX_DESCRIPTION_CHARS, REQUIRED_COLUMNS
from ledgerlens.functions.text import is_blank


def check_schema(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
                 strings_only: bool = True) -> list[str]:
    """Raise unless the required columns exist (as strings); return all names."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    if strings_only:
        for name in required:
            if not isinstance(df.schema[name].dataType, T.StringType):
                raise ValueError(f"Column '{name}' must be a string")
    return list(df.columns)


def null_counts(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row per column plus a `total` row, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    pairs.append(F.struct(F.lit("total").alias("column_name"), total.alias("nulls")))
    return counts.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")


def drop_nulls(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_blank(df: DataFrame, column: str = "description") -> DataFrame:
    """Keep rows whose text has something besides white space."""
    return df.where(~is_blank(F.col(column)))


def keep_allowed(df: DataFrame, allowed: Sequence[str] | DataFrame, column: str = "category") -> DataFrame:
    """Keep rows whose label is allowed.

    A Python list becomes a set test inside the scan stage; a one-column
    DataFrame becomes a semi join whose strategy Spark picks by size.
    """
    if isinstance(allowed, DataFrame):
        domain = allowed.select(F.col(allowed.columns[0]).alias(column))
        return df.join(domain, column, "left_semi")
    return df.where(F.col(column).isin(list(allowed)))


def unknown_labels(df: DataFrame, allowed: Sequence[str] | DataFrame, column: str = "category") -> DataFrame:
    """Distinct labels outside the allow-list (set difference)."""
    seen = df.select(column).where(F.col(column).isNotNull()).distinct()
    if isinstance(allowed, DataFrame):
        domain = allowed.select(F.col(allowed.columns[0]).alias(column))
        return seen.join(domain, column, "left_anti")
    return seen.where(~F.col(column).isin(list(allowed)))


def dedup_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest `order` value.

    This is an aggregate, not a window, so copies collapse on the map side and
    a text that makes up a third of the table reaches the shuffle as one row
    per task.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    if not rest:
        return df.groupBy(*keys).agg(F.min(order).alias(order)).select(*df.columns)
    first = F.min_by(F.struct(*[F.col(c) for c in [order, *rest]]), F.col(order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[
        F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns
    ])


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where only the keys are kept."""
    return df.select(*keys).distinct()


def require_rows(df: DataFrame, message: str = "No valid rows left") -> DataFrame:
    """Raise when the table is empty (an action that stops at the first row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def cleanup_funnel(df: DataFrame, allowed: Sequence[str], columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """How many rows each cleanup rule removes, from one pass over the table.

    Rows are tagged with the first rule they fail; kept rows are then counted
    with and without copies.
    """
    description, category = columns
    reason = (
        F.when(F.col(description).isNull() | F.col(category).isNull(), "null")
        .when(~F.col(category).isin(list(allowed)), "unknown_category")
        .otherwise("kept")
    )
    ok = F.col("_reason") == "kept"
    per_key = (
        df.withColumn("_reason", reason)
        .groupBy("_reason", F.when(ok, F.col(description)).alias("_d"), F.when(ok, F.col(category)).alias("_c"))
        .agg(F.count("*").alias("_n"))
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("original"),
        F.coalesce(F.sum(F.when(F.col("_reason") == "null", F.col("_n"))), F.lit(0)).alias("removed_null"),
        F.coalesce(F.sum(F.when(F.col("_reason") == "unknown_category", F.col("_n"))), F.lit(0)).alias("removed_unknown"),
        F.coalesce(F.sum(F.when(ok, F.col("_n") - 1)), F.lit(0)).alias("removed_duplicate"),
        F.count_if(ok).alias("retained"),
    )
    return totals.withColumn("removed", F.col("original") - F.col("retained"))


# --- Rule checks ------------------------------------------------------------
def _text_rule(name: str, limit: int | None = MAX_DESCRIPTION_CHARS) -> list[tuple[str, Column]]:
    c = F.col(name)
    rules = [(f"{name}_missing", c.isNull()), (f"{name}_empty", F.length(c) == 0)]
    if limit is not None:
        rules.append((f"{name}_too_long", F.length(c) > limit))
    return rules


def single_rules() -> list[tuple[str, Column]]:
    """A single description: 1 to 500 characters."""
    return _text_rule("description")


def feedback_rules() -> list[tuple[str, Column]]:
    """Feedback: a bounded description and two non-empty labels."""
    return [
        *_text_rule("description"),
        *_text_rule("predicted_category", None),
        *_text_rule("actual_category", None),
    ]


def batch_rules(limit: int) -> list[tuple[str, Column]]:
    """A batch of descriptions: 1 to `limit` items; items are not checked."""
    c = F.col("descriptions")
    return [
        ("descriptions_missing", c.isNull()),
        ("descriptions_empty", F.size(c) == 0),
        ("descriptions_too_many", F.size(c) > limit),
    ]


def run_id_rules() -> list[tuple[str, Column]]:
    return _text_rule("run_id", None)


def with_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add `reasons`: the names of the rules a row breaks."""
    broken = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules])
    return df.withColumn("reasons", F.filter(broken, lambda x: x.isNotNull()))


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy all rules, and the rejected rows with their reasons."""
    marked = with_reasons(df, rules)
    return (
        marked.where(F.size("reasons") == 0).drop("reasons"),
        marked.where(F.size("reasons") > 0),
    )
