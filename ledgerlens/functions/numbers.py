"""Number, time and array functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Digits with an optional sign, point and exponent, or the words for what is no finite number.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def to_number(text: Column) -> Column:
    """Parse a double; text that is no plain number gives null, never an error.

    A cast alone also takes type suffixes ('500D') and hexadecimal forms ('0x1p3').
    """
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def metric_or_null(value: Column) -> Column:
    """A metric as double, with NaN and unreadable text as null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def half_even(value: Column, digits: int) -> Column:
    """Round half to even, for display columns."""
    return F.bround(value, digits)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where the bottom is 0 or missing."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp, free of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts.cast("timestamp_ntz"))


def from_micros(micros: Column) -> Column:
    """Inverse of `epoch_micros`."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH))


def parse_event_time(text: Column) -> Column:
    """Epoch seconds ('1700000000.5') or ISO text to a timestamp, else null."""
    micros = F.round(to_number(text) * 1e6).try_cast("long")
    return F.coalesce(F.timestamp_micros(micros), F.try_to_timestamp(text))


def megabytes(size: Column) -> Column:
    return F.bround(size / F.lit(1024.0 * 1024.0), 1)


def count_non_pad(items: Column, pad: int = 0) -> Column:
    return F.size(F.filter(items, lambda x: x != pad))


def softmax(scores: Sequence[Column]) -> list[Column]:
    """Soft-max over columns of one row, shifted by the largest for stability."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return [part / total for part in parts]


def _bind(value: Column, body) -> Column:
    """Use a computed value several times in an expression but compute it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax_array(scores: Column) -> Column:
    """Soft-max over an array column."""
    powers = _bind(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp(x - top)))
    return _bind(powers, lambda items: _bind(
        F.aggregate(items, F.lit(0.0), lambda a, b: a + b),
        lambda total: F.transform(items, lambda x: x / total)))


def argmax(scores: Sequence[Column]) -> Column:
    """Zero-based position of the largest score, the first on ties."""
    items = F.array(*scores)
    return F.array_position(items, F.array_max(items)).cast("int") - 1


def ranked_scores(scores: Column) -> Column:
    """Entries of a label -> score map, best first, ties by label."""
    def order(a: Column, b: Column) -> Column:
        return (
            F.when(a["value"] > b["value"], -1)
            .when(a["value"] < b["value"], 1)
            .when(a["key"] < b["key"], -1)
            .when(a["key"] > b["key"], 1)
            .otherwise(0)
        )

    return F.array_sort(F.map_entries(scores), order)


def confidence_band(confidence: Column) -> Column:
    """Wording for a confidence, as the user guide gives it."""
    return (
        F.when(confidence >= 0.90, "very high")
        .when(confidence >= 0.70, "high")
        .when(confidence >= 0.50, "moderate")
        .otherwise("low")
    )


def map_text(value: Column, mapping: dict[str, str], default: str) -> Column:
    """Look a text up in a small constant table."""
    out = None
    for key, shown in mapping.items():
        out = F.when(value == key, shown) if out is None else out.when(value == key, shown)
    return F.lit(default) if out is None else out.otherwise(default)
