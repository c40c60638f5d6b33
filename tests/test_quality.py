import pytest
from pyspark.sql import functions as F

from ledgerlens.config import SPENDING_CATEGORIES
from ledgerlens.operators import profile, quality

TWO = "description string, category string"
VALID = [("Zomato payment", "Food & Dining"), ("Uber ride", "Transportation"), ("Netflix subscription", "Entertainment & Recreation")]


def test_schema_ok(rows):
    assert quality.check_schema(rows(VALID, TWO)) == ["description", "category"]


def test_schema_missing_column(rows):
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.check_schema(rows([("x",)], "description string"))


def test_schema_wrong_type(rows):
    with pytest.raises(ValueError):
        quality.check_schema(rows([(123, "Food & Dining")], "description int, category string"))


def test_nulls(rows):
    df = rows([("foo", "A"), (None, None)], TWO)
    assert {r["column_name"]: r["nulls"] for r in quality.null_counts(df).collect()} == {"description": 1, "category": 1, "total": 2}
    assert quality.drop_nulls(df).count() == 1


def test_categories(rows):
    df = rows([*VALID, ("Some transaction", "Unknown Category")], TWO)
    assert quality.keep_allowed(df, SPENDING_CATEGORIES).count() == 3
    assert [r[0] for r in quality.unknown_labels(df, SPENDING_CATEGORIES).collect()] == ["Unknown Category"]


def test_categories_by_table(rows):
    df = rows([*VALID, ("x", "Unknown")], TWO)
    domain = rows([(c,) for c in SPENDING_CATEGORIES], "name string")
    assert quality.keep_allowed(df, domain).count() == 3
    assert quality.unknown_labels(df, domain).count() == 1


def test_blank_rows(rows):
    assert quality.drop_blank(rows([("a",), (" \t",), (" ",)], "description string")).count() == 1


def test_dedup_keeps_first_whole_row(rows):
    df = rows([(2, "a", "x", "late"), (1, "a", "x", None), (3, "b", "x", "only")], "row_id long, description string, category string, note string")
    got = {r["row_id"]: r["note"] for r in quality.dedup_first(df, ["description", "category"], "row_id").collect()}
    assert got == {1: None, 3: "only"}


def test_dedup_of_one_hot_text(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("description"), F.lit("c").alias("category"))
    kept = quality.dedup_first(df, ["description", "category"], "row_id")
    assert kept.count() == 20_001
    assert kept.where("description = 'hot'").first()["row_id"] == 0


def test_require_rows(rows):
    with pytest.raises(ValueError):
        quality.require_rows(rows([], TWO))


@pytest.mark.parametrize("value, reasons", [
    ("ok", []), ("", ["description_empty"]), (None, ["description_missing"]), ("x" * 500, []), ("x" * 501, ["description_too_long"])])
def test_single_payload(rows, value, reasons):
    df = quality.with_reasons(rows([(value,)], "description string"), quality.single_rules())
    assert df.first()["reasons"] == reasons


def test_batch_payload(rows):
    df = rows([(["a", ""],), ([],), (None,), (["a"] * 501,)], "descriptions array<string>")
    valid, rejected = quality.split_valid(df, quality.batch_rules(500))
    assert valid.count() == 1 and rejected.count() == 3


def test_feedback_payload(rows):
    df = rows([("d", "A", "A", None), ("d", "A", "B", "t1"), ("", "A", "A", None), ("d", "", "A", None), ("d", "A", None, None)],
              "description string, predicted_category string, actual_category string, transaction_id string")
    valid, rejected = quality.split_valid(df, quality.feedback_rules())
    assert valid.count() == 2 and rejected.count() == 3


def test_run_id_payload(rows):
    valid, rejected = quality.split_valid(rows([("r1",), ("",), (None,)], "run_id string"), quality.run_id_rules())
    assert valid.count() == 1 and rejected.count() == 2


def test_funnel(rows):
    df = rows([("a", "x"), ("a", "x"), (None, "x"), ("b", "bad"), ("c", None)], TWO)
    got = quality.cleanup_funnel(df, ["x"]).first().asDict()
    assert got == {"original": 5, "removed_null": 2, "removed_unknown": 1, "removed_duplicate": 1, "retained": 1, "removed": 4}


def test_funnel_of_nothing(rows):
    assert quality.cleanup_funnel(rows([], TWO), ["x"]).first()["original"] == 0


def test_shares_ignore_nulls_and_sum_to_one(rows):
    got = {r["category"]: r["share"] for r in profile.value_shares(rows([("a",), ("a",), ("b",), (None,)], "category string")).collect()}
    assert got == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_shares_of_zero_counts(rows):
    assert [r["share"] for r in profile.shares_of_counts(rows([("a", 0)], "category string, n long")).collect()] == [0.0]


def test_baseline_profile(rows):
    row = profile.baseline_profile(rows([("ab", "x"), ("abcd", "x"), ("abc", "y")], TWO)).first()
    assert (row["total_rows"], row["category_distribution"], row["description_avg_length"]) == (3, {"x": 2, "y": 1}, 3.0)


def test_label_fallback(rows):
    df = rows([("A", "B"), ("", "B"), (None, "B"), ("", ""), (None, None)], "actual_category string, predicted_category string")
    assert {r["label"]: r["n"] for r in profile.feedback_label_counts(df).collect()} == {"A": 1, "B": 2}
