"""Spend report: score debit rows, add up per category."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.operators.classifier import NaiveBayes, predict
from ledgerlens.operators.spend import spend_by_category, with_percentage


def score_debits(debits: DataFrame, model: NaiveBayes, row_id: str) -> DataFrame:
    """Debit rows with predicted category, confidence and scores."""
    carry = [c for c in debits.columns if c != row_id]
    return predict(debits, model, row_id, carry=carry)


def spend_report(debits: DataFrame, model: NaiveBayes, row_id: str) -> DataFrame:
    """(category, amount, percentage) of scored debit rows."""
    return with_percentage(spend_by_category(score_debits(debits, model, row_id)))
