import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import numbers, text
from ledgerlens.functions.numbers import to_number
from ledgerlens.functions.text import first_tokens, percent_text, tokens
from ledgerlens.session import work_folder


def one(df, column):
    return df.select(column.alias("x")).collect()[0][0]


@pytest.mark.parametrize("given, want", [
    ("Zomato Payment", ["zomato", "payment"]),
    ("Zomato ₹350 payment", ["zomato", "350", "payment"]),
    ("", []),
    ("!!!@@@###", []),
    ("a\tb c", ["a", "b", "c"]),
])
def test_tokens(rows, given, want):
    assert one(rows([(given,)], "s string"), text.tokens(F.col("s"))) == want


@pytest.mark.parametrize("given, want", [
    ("UPI/ZOMATO/9148/FoodOrder", "ZOMATO/9148/FoodOrder"),
    ("TOLL PLAZA", "LL PLAZA"),
    ("DREAM11", "EAM11"),
    ("SIP 123", "P 123"),
    ("UPI-X", "-X"),
    ("NACH D-LOAN", "D-LOAN"),
    ("123/45 SHOP", "SHOP"),
    ("neft / salary   jan", "salary jan"),
    ("UPI", "UPI"),
    ("12/34", "12/34"),
])
def test_clean_narration(rows, given, want):
    assert one(rows([(given,)], "s string"), text.clean_narration(F.col("s"))) == want


def test_clean_narration_strict(rows):
    df = rows([("TOLL PLAZA",)], "s string")
    assert one(df, text.clean_narration(F.col("s"), strict=True)) == "TOLL PLAZA"


@pytest.mark.parametrize("given, want", [("  a b \t", "a b"), ("　x ", "x"), ("\x1c", ""), ("x", "x")])
def test_strip(rows, given, want):
    assert one(rows([(given,)], "s string"), text.strip(F.col("s"))) == want


@pytest.mark.parametrize("given, ok", [("1/2/23", True), ("01/02/2023", True), ("1-2-23", False), ("x 1/2/23", False), ("1/2/23 ", False)])
def test_date_shape(rows, given, ok):
    assert one(rows([(given,)], "s string"), text.is_date_shaped(F.col("s"))) is ok


def test_display_texts(rows):
    df = rows([(1234567, 0.1234, 1234.5)], "n long, p double, a double")
    assert one(df, text.thousands_text(F.col("n"))) == "1,234,567"
    assert one(df, text.percent_text(F.col("p"))) == "12.3%"
    assert one(df, text.money_text(F.col("a"))) == "1,234.50"
    assert one(df, text.metric_slug(F.lit("Food & Dining Out"))) == "food_dining_out"


@pytest.mark.parametrize("given, want", [("1.5", 1.5), ("1,200.00", None), ("", None), ("abc", None)])
def test_to_number(rows, given, want):
    assert one(rows([(given,)], "s string"), numbers.to_number(F.col("s"))) == want


@pytest.mark.parametrize("given, want", [("0.5", 0.5), ("NaN", None), ("n/a", None), (None, None)])
def test_metric_or_null(rows, given, want):
    assert one(rows([(given,)], "s string"), numbers.metric_or_null(F.col("s"))) == want


@pytest.mark.parametrize("given, micros", [
    ("1700000000.5", 1700000000500000), ("2023-11-14T22:13:20Z", 1700000000000000), ("soon", None), ("NaN", None)])
def test_event_time(rows, given, micros):
    assert one(rows([(given,)], "s string"), F.unix_micros(numbers.parse_event_time(F.col("s")))) == micros


def test_softmax_and_argmax(rows):
    df = rows([([1.0, 3.0, 3.0],)], "v array<double>")
    probs = one(df, numbers.softmax_array(F.col("v")))
    total = sum(math.exp(x) for x in (1, 3, 3))
    assert probs == pytest.approx([math.exp(x) / total for x in (1, 3, 3)])
    cols = [F.col("v")[i] for i in range(3)]
    assert one(df, numbers.argmax(cols)) == 1
    assert one(df, F.array(*numbers.softmax(cols))) == pytest.approx(probs)


def test_softmax_of_large_scores(rows):
    df = rows([([1000.0, 1000.0],)], "v array<double>")
    assert one(df, numbers.softmax_array(F.col("v"))) == pytest.approx([0.5, 0.5])


def test_ranked_scores(rows):
    df = rows([({"b": 0.4, "a": 0.4, "c": 0.2},)], "m map<string,double>")
    assert [e["key"] for e in one(df, numbers.ranked_scores(F.col("m")))] == ["a", "b", "c"]


@pytest.mark.parametrize("value, want", [(0.9, "very high"), (0.7, "high"), (0.5, "moderate"), (0.49, "low")])
def test_confidence_band(rows, value, want):
    assert one(rows([(value,)], "c double"), numbers.confidence_band(F.col("c"))) == want


def test_half_even(rows):
    df = rows([(0.5, 1.5, 2.5)], "a double, b double, c double")
    assert df.select(*[numbers.half_even(F.col(c), 0) for c in "abc"]).first()[:] == (0.0, 2.0, 2.0)


def test_pad_right(rows):
    df = rows([([1, 2],), ([1, 2, 3, 4],), ([],)], "a array<int>")
    assert [r[0] for r in df.select(text.pad_right(F.col("a"), 3)).collect()] == [[1, 2, 0], [1, 2, 3], [0, 0, 0]]


def test_megabytes(rows):
    assert one(rows([(172_000_000,)], "n long"), numbers.megabytes(F.col("n"))) == pytest.approx(164.0, abs=0.1)


def test_map_text(rows):
    df = rows([("success",), ("other",)], "s string")
    assert [r[0] for r in df.select(numbers.map_text(F.col("s"), {"success": "+"}, "?")).collect()] == ["+", "?"]


def test_plain_numbers_only(rows):
    cases = {"500D": None, "0x1p3": None, "12f": None, "1,200.00": None, "": None, "abc": None, " 12.5 ": 12.5, "-3": -3.0, "1e3": 1000.0, ".5": 0.5, "7.": 7.0}
    got = {r["t"]: r["n"] for r in rows([(k,) for k in cases], "t string").select("t", to_number(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_percent_ties_go_to_the_even_digit(rows):
    cases = [(0.1225, "12.2%"), (0.1235, "12.4%"), (0.1, "10.0%"), (1.0, "100.0%")]
    got = rows([(s,) for s, _ in cases], "s double").select(percent_text(F.col("s")).alias("p")).collect()
    assert [r["p"] for r in got] == [p for _, p in cases]


def test_first_words_of_a_prefix(rows):
    texts = ["", "!!!", "a b c d", "  A-b_c d", "é one two", "x" * 50 + " y", "one two"]
    got = rows([(t,) for t in texts], "t string").select(
        first_tokens(F.col("t"), 2).alias("a"), F.slice(tokens(F.col("t")), 1, 2).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_shared_folder_is_required_off_one_machine(spark):
    class Other:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: "spark://host:7077" if key == "spark.master" else default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Other, "x")
    assert work_folder(spark, "x") != work_folder(spark, "x")
