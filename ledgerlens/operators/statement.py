"""Bank statement rows to clean debit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.numbers import to_number
from ledgerlens.functions.text import clean_narration, is_blank, is_date_shaped, strip


def resolve_columns(names: list[str]) -> dict[str, str]:
    """Find the narration, withdrawal and date columns among statement headers.

    Without a date column the first column serves for the date check.
    """
    def find(test):
        return next((n for n in names if test(n.strip().lower())), None)

    narration = find(lambda n: n == "narration")
    withdrawal = find(lambda n: "withdrawal" in n)
    if narration is None:
        raise ValueError(f"no 'Narration' column among {names}")
    if withdrawal is None:
        raise ValueError(f"no 'Withdrawal Amt.' column among {names}")
    return {"narration": narration, "withdrawal": withdrawal,
            "date": find(lambda n: n == "date") or names[0]}


def has_amount(text: Column) -> Column:
    """A debit cell: present, and neither blank nor written 'nan'."""
    return text.isNotNull() & ~strip(text).isin("", "nan", "NaN")


def amount_of(text: Column, commas: bool = False) -> Column:
    """The amount as a number; '1,200.00' is unreadable unless `commas` is set."""
    return to_number(F.replace(text, F.lit(","), F.lit("")) if commas else text)


def debit_rows(rows: DataFrame, date: str = "date", narration: str = "narration", withdrawal: str = "withdrawal",
               commas: bool = False, strict_codes: bool = False) -> DataFrame:
    """(…, description, amount) for dated rows with a readable debit amount."""
    keep = [c for c in rows.columns if c not in (date, narration, withdrawal)]
    number = amount_of(F.col(withdrawal), commas)
    # cleaning never blanks a text, so blank descriptions are those of blank narrations
    kept = rows.where(
        is_date_shaped(F.col(date)) & has_amount(F.col(withdrawal)) & ~is_blank(F.col(narration))
        & number.isNotNull() & ~F.isnan(number))
    return kept.select(
        *keep, clean_narration(strip(F.col(narration)), strict_codes).alias("description"), number.alias("amount"))
