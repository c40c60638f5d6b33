"""Text functions on columns. All are built-in expressions, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that count as white space in Unicode text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Bank code prefixes, in the order they are tried. The separator
# is optional, so a short code also bites into a longer word ("TOLL" -> "LL").
NARRATION_CODES = (
    "UPI", "NEFT", "RTGS", "IMPS", "ACH", "ECS", "SI", "POS", "ATM", "CLG",
    "BIL", "NACH", "NACH D-", "DR", "TO",
)
DATE_SHAPE = r"^\d{1,2}/\d{1,2}/\d{2,4}$"


def strip(text: Column) -> Column:
    """Drop leading and trailing white space, Unicode kinds included."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return F.length(strip(text)) == 0


def tokens(text: Column) -> Column:
    """Lower-case words made of a-z and 0-9; everything else separates."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def first_tokens(text: Column, length: int) -> Column:
    """The first `length` words of the whole text.

    A possessive pattern takes the prefix that holds them, so that the words after
    it are not cut out.
    """
    held = F.regexp_extract(F.lower(text), f"^(?:[^a-z0-9]*+[a-z0-9]++){{0,{length}}}+", 0)
    return F.regexp_extract_all(held, F.lit("[a-z0-9]+"), 0)


def pad_right(items: Column, length: int, pad: int = 0) -> Column:
    """Bring an array to exactly `length` items: cut the tail or add `pad`."""
    return F.slice(F.concat(items, F.array_repeat(F.lit(pad), length)), 1, length)


def clean_narration(text: Column, strict: bool = False) -> Column:
    """Strip a bank code prefix and a leading reference number.

    `strict` asks for a separator after the code, so "TOLL PLAZA" keeps its
    first word. A text that would end up empty is returned as it was.
    """
    gap = r"(\s*/\s*|\s+)" if strict else r"\s*/?\s*"
    plain = strip(text)
    no_code = F.regexp_replace(plain, f"(?iU)^({'|'.join(NARRATION_CODES)}){gap}", "")
    no_ref = F.regexp_replace(no_code, r"(?U)^\d[\d/]*\s*", "")
    squeezed = strip(F.regexp_replace(no_ref, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(squeezed, F.lit("")), text)


def is_date_shaped(text: Column) -> Column:
    return text.rlike(DATE_SHAPE)


def same_text(left: Column, right: str) -> Column:
    """Case-insensitive equality after trimming."""
    return F.lower(strip(left)) == right.lower()


def metric_slug(label: Column) -> Column:
    """'Food & Dining' -> 'food_dining', for metric names."""
    joined = F.replace(label, F.lit(" & "), F.lit("_"))
    return F.lower(F.replace(joined, F.lit(" "), F.lit("_")))


def text_prefix(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def percent_text(share: Column, digits: int = 1) -> Column:
    """0.1234 -> '12.3%'; a tie goes to the even digit, as floats are printed."""
    return F.format_string(f"%.{digits}f%%", F.bround(share.cast("double") * 100, digits))


def thousands_text(number: Column) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(number, 0)


def money_text(amount: Column) -> Column:
    """1234.5 -> '1,234.50'."""
    return F.format_number(amount, 2)
