"""Ingest job: check, clean, deduplicate, write, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlens.config import REQUIRED_COLUMNS, SPENDING_CATEGORIES
from ledgerlens.operators.profile import baseline_profile
from ledgerlens.operators.quality import check_schema, dedup_first, drop_nulls, keep_allowed, require_rows
from ledgerlens.sinks.writers import write_stats, write_table


def clean_transactions(raw: DataFrame, allowed: Sequence[str] = SPENDING_CATEGORIES,
                       order: str | None = None) -> DataFrame:
    """Schema check, null drop, allow-list, first of equal rows.

    With an `order` column the smallest row of equal ones stays, whole; without
    one any of them does.
    """
    check_schema(raw)
    rows = keep_allowed(drop_nulls(raw), allowed)
    if order is None:
        return rows.dropDuplicates(list(REQUIRED_COLUMNS))
    return dedup_first(rows, list(REQUIRED_COLUMNS), order)


def ingest(raw: DataFrame, path: str, allowed: Sequence[str] = SPENDING_CATEGORIES,
           order: str | None = None) -> DataFrame:
    """Write the cleaned rows and their baseline under `path`; return the written rows.

    The profile reads the written table, so the cleaning runs once.
    """
    write_table(clean_transactions(raw, allowed, order), f"{path}/transactions")
    rows = raw.sparkSession.read.parquet(f"{path}/transactions")
    require_rows(rows, "no valid rows after ingest checks")
    write_stats(baseline_profile(rows), f"{path}/baseline_stats")
    return rows
