import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.config import FeatureParams
from ledgerlens.operators import classifier, evaluation, features, labels, sampling
from ledgerlens.plans.features import build_features, save_features
from ledgerlens.sources.files import baseline_label_counts, read_feature_baseline, read_features

TEXT = "row_id long, description string"


def texts(rows, *items):
    return rows(list(enumerate(items)), TEXT)


def vocab(rows, mapping):
    return rows(list(mapping.items()), "token string, idx int")


def seqs(df):
    return [r["seq"] for r in df.orderBy("row_id").collect()]


def test_vocabulary_min_freq(rows):
    got = features.build_vocabulary(texts(rows, "apple apple apple", "banana", "cherry"), 100, 2)
    assert [r["token"] for r in got.collect()] == ["apple"]


def test_vocabulary_specials(rows):
    got = features.with_special_tokens(features.build_vocabulary(texts(rows, "hello world", "foo bar"), 100, 1))
    found = {r["token"]: r["idx"] for r in got.collect()}
    assert found["<PAD>"] == 0 and found["<UNK>"] == 1
    assert sorted(found.values()) == list(range(6))


def test_vocabulary_cap(rows):
    got = features.build_vocabulary(texts(rows, *[f"word{i}" for i in range(200)]), 50, 1)
    assert got.count() == 50


def test_encode(rows):
    known = vocab(rows, {"hello": 2, "known": 2})
    assert seqs(features.encode_texts(texts(rows, "hello", "known unknown", "", "hello " * 9), known, "row_id", 5)) == [
        [2, 0, 0, 0, 0], [2, 1, 0, 0, 0], [0, 0, 0, 0, 0], [2, 2, 2, 2, 2]]


def test_encode_other_specials(rows):
    got = features.encode_texts(texts(rows, "a b"), vocab(rows, {"a": 7}), "row_id", 4, pad=100, unk=101)
    assert seqs(got) == [[7, 101, 100, 100]]


def test_label_index_and_decode(rows):
    index = labels.label_index(rows([("b",), ("a",), ("b",), (None,)], "category string"))
    assert {r["category"]: r["label_idx"] for r in index.collect()} == {"a": 0, "b": 1}
    got = labels.decode_counts(rows([(0, 30), (9, 70)], "label_idx int, n long"), index)
    assert [(r["category"], r["share"]) for r in got.collect()] == [("a", 0.3)]


def population(spark, n=4000):
    """One label holds a third of all rows."""
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("category"))


def test_stratified_sample_against_brute_force(spark):
    import hashlib

    df = population(spark)
    groups = {}
    for r in df.collect():
        groups.setdefault(r["category"], []).append(r["row_id"])
    want = set()
    for ids in groups.values():
        ids.sort(key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
        want.update(ids[: round(0.9 * len(ids))])
    got = {r["row_id"] for r in sampling.stratified_sample(df, "category", "row_id", 0.9, 42).collect()}
    assert got == want
    rest = {r["row_id"] for r in sampling.sample_rest(df, "category", "row_id", 0.9, 42).collect()}
    assert not (rest & want) and len(rest) + len(want) == 4000


def test_split_is_a_stratified_partition(spark):
    df = population(spark, 1000).unionByName(spark.sql("SELECT 5000L AS row_id, 'single' AS category"))
    got = sampling.train_val_test(df, "category", "row_id", 0.15, 0.15, 42).toPandas()
    assert len(got) == 1001 and got["row_id"].is_unique
    sizes = Counter(got["split"])
    assert sizes["test"] == math.ceil(0.15 * 1000)
    assert sizes["val"] == math.ceil(0.15 / 0.85 * (1000 - sizes["test"]))
    assert got[got.category == "single"]["split"].tolist() == ["train"]
    for _, part in got[got.category != "single"].groupby("category"):
        assert abs((part["split"] == "test").sum() - 0.15 * len(part)) < 1


def test_split_is_repeatable(spark):
    df = population(spark, 500)
    one, two = (sampling.train_val_test(df.repartition(k), "category", "row_id", 0.2, 0.1, 7) for k in (3, 11))
    assert one.exceptAll(two).isEmpty()


def test_draws_with_replacement(spark):
    got = sampling.draw_with_replacement(population(spark, 50), "row_id", 500, 1).toPandas()
    assert len(got) == 500 and got["row_id"].between(0, 49).all() and got["copy_no"].max() > 1


def test_draws_from_empty_pool(spark):
    assert sampling.draw_with_replacement(population(spark).where("row_id < 0"), "row_id", 5, 1).count() == 0


def test_sample_caps_at_what_is_there(spark):
    assert sampling.sample_rows(population(spark, 20), "row_id", 100, 1).count() == 20
    assert sampling.capped_per_group(population(spark, 100), "category", "row_id", 5, 1).groupBy("category").count().agg(F.max("count")).first()[0] == 5


def test_drift_split_sizes(spark):
    df = population(spark, 3000)
    base, drifted = sampling.drift_split(df, "row_id")
    rest = 3000 - base.count()
    top = [r["category"] for r in df.groupBy("category").count().orderBy(F.desc("count"), "category").limit(3).collect()]
    assert drifted.where(F.col("category").isin(top)).count() == math.floor(0.75 * rest)
    assert drifted.count() == rest
    assert base.join(drifted, "row_id", "left_semi").isEmpty()


def test_shuffled_is_a_permutation(spark):
    df = population(spark, 30)
    order = [r["row_id"] for r in sampling.shuffled(df, "row_id", 3).collect()]
    assert sorted(order) == list(range(30)) and order != sorted(order)


# --- Feature job, classifier, evaluation ------------------------------------
def hundred(rows):
    return rows([(i, f"merchant{i % 10} item{i} word{i % 5}", f"cat{i % 10}") for i in range(100)],
                "row_id long, description string, category string")


def test_feature_job(spark, rows, tmp_path):
    params = FeatureParams(max_vocab_size=500, min_freq=1, max_seq_len=10)
    made = build_features(hundred(rows), "row_id", params)
    save_features(made, str(tmp_path))
    parts = {s: read_features(spark, str(tmp_path), s) for s in ("train", "val", "test")}
    assert {s: d.count() for s, d in parts.items()} == {"train": 69, "val": 16, "test": 15}
    assert all(d.where(F.size("seq") != 10).isEmpty() for d in parts.values())
    train_words = {w for r in made.train_texts.collect() for w in r["description"].split()}
    assert {r["token"] for r in made.vocabulary.collect()} == train_words
    stored = read_feature_baseline(spark, f"{tmp_path}/feature_baseline")
    row = stored.first()
    assert (row["seq_nonzero_mean"], row["seq_nonzero_std"]) == (3.0, 0.0)
    assert baseline_label_counts(stored).agg(F.sum("n")).first()[0] == 69


def test_feature_baseline_std(rows):
    data = [(0, [1, 2, 0]), (0, [1, 0, 0]), (1, [3, 4, 5])]
    row = features.feature_baseline(rows(data, "label_idx int, seq array<int>")).first()
    assert row["seq_nonzero_mean"] == 2.0
    assert row["seq_nonzero_std"] == pytest.approx(np.std([2, 1, 3]))
    assert row["label_distribution"] == {"0": 2, "1": 1}


@pytest.fixture
def model(rows):
    train = rows([(0, "uber ride ride", 1), (1, "zomato food", 0), (2, "food order", 0)], "row_id long, description string, label_idx int")
    index = rows([(0, "Food"), (1, "Travel")], "label_idx int, category string")
    words = vocab(rows, {"uber": 2, "ride": 3, "zomato": 4, "food": 5})
    return classifier.fit(train, index, words, "row_id", 50)


def by_hand(words):
    """Scores of both classes with add-one smoothing over 5 words, the unknown one included."""
    counts = {0: Counter(["zomato", "food", "food", "?"]), 1: Counter(["uber", "ride", "ride"])}
    out = []
    for c, docs in ((0, 2), (1, 1)):
        total = sum(counts[c].values())
        out.append(math.log(docs / 3) + sum(math.log((counts[c][w] + 1) / (total + 5)) for w in words))
    top = max(out)
    parts = [math.exp(s - top) for s in out]
    return [p / sum(parts) for p in parts]


@pytest.mark.parametrize("given, words", [
    ("ride food", ["ride", "food"]), ("uber uber", ["uber", "uber"]), ("", []), ("never seen", ["?", "?"])])
def test_predict(rows, model, given, words):
    row = classifier.predict(texts(rows, given), model, "row_id").first()
    want = by_hand(words)
    assert [row["all_scores"]["Food"], row["all_scores"]["Travel"]] == pytest.approx(want)
    assert row["predicted_category"] == ("Food" if want[0] >= want[1] else "Travel")
    assert row["confidence"] == pytest.approx(max(want)) and 0 <= row["confidence"] <= 1


def test_tie_goes_to_the_first_label(rows):
    train = rows([(0, "a", 0), (1, "b", 1)], "row_id long, description string, label_idx int")
    index = rows([(0, "x"), (1, "y")], "label_idx int, category string")
    even = classifier.fit(train, index, vocab(rows, {"a": 2, "b": 3}), "row_id", 5)
    assert classifier.predict(texts(rows, "a b"), even, "row_id").first()["predicted_category"] == "x"


def test_merge_and_model_store(spark, rows, model, tmp_path):
    twice = classifier.merge(model, model, "twice")
    assert {r["n_docs"] for r in twice.classes.collect()} == {4, 2}
    classifier.save_model(model, str(tmp_path), "one")
    classifier.save_model(twice, str(tmp_path), "two")
    again = classifier.load_model(spark, str(tmp_path), "one")
    assert {r["n_docs"] for r in again.classes.collect()} == {2, 1}
    assert classifier.predict(texts(rows, "ride"), again, "row_id").first()["predicted_category"] == "Travel"
    with pytest.raises(LookupError):
        classifier.load_model(spark, str(tmp_path), "three")


def test_merge_needs_one_vocabulary(rows, model):
    import dataclasses

    with pytest.raises(ValueError):
        classifier.merge(model, dataclasses.replace(model, vocabulary_size=9), "x")


def pairs(rows):
    return rows([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("a", "a")], "actual string, predicted string")


def test_class_metrics(rows):
    got = {r["label"]: r for r in evaluation.class_metrics(evaluation.confusion(pairs(rows))).collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["f1"]) == pytest.approx((1.0, 2 / 3, 0.8))
    assert (got["b"]["precision"], got["b"]["recall"], got["b"]["f1"]) == pytest.approx((1 / 3, 1.0, 0.5))
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"], got["c"]["support"]) == (0.0, 0.0, 0.0, 1)


def test_summary_and_gate(rows):
    summary = evaluation.summary_metrics(evaluation.confusion(pairs(rows)))
    row = summary.first()
    assert row["accuracy"] == pytest.approx(0.6)
    assert row["f1_macro"] == pytest.approx((0.8 + 0.5 + 0.0) / 3)
    assert row["f1_weighted"] == pytest.approx((0.8 * 3 + 0.5) / 5)
    with pytest.raises(evaluation.BelowGate):
        evaluation.check_gate(summary, 0.7)
    assert evaluation.check_gate(summary, 0.4) == row["f1_macro"]


def test_confusion_export(rows):
    got = {r["actual"]: r["counts"] for r in evaluation.confusion_matrix_rows(evaluation.confusion(pairs(rows))).collect()}
    assert got == {"a": [2, 1, 0], "b": [0, 1, 0], "c": [0, 1, 0]}


def test_products_of_large_counts(rows):
    """Counts of 10^12 rows a label, and lengths over them, stay in range."""
    from ledgerlens.operators.features import feature_baseline
    from ledgerlens.operators.sampling import split_quotas

    n = 10**12
    quotas = {r["category"]: r for r in split_quotas(rows([("a", n), ("b", 3 * n)], "category string, n long"), "category", 0.15, 0.15).collect()}
    assert quotas["a"]["n_test"] + quotas["b"]["n_test"] == 6 * 10**11
    assert quotas["a"]["n_test"] == 15 * 10**10
    assert feature_baseline(rows([(0, [2, 3, 0]), (1, [2, 0, 0])], "label_idx int, seq array<int>")).first()["seq_nonzero_std"] == 0.5
