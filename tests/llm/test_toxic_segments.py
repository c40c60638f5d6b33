import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxic_segments as t
from tests.llm.conftest import ROWS


def brute_segments(scores):
    """Maximal segments by their definition: best segment first, then on both sides of it."""
    def best(a, b):
        found = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > 0 and (found is None or total > found[0]):
                    found = total, i, j
        return found

    def split(a, b):
        hit = best(a, b)
        if hit is None:
            return []
        total, i, j = hit
        return split(a, i) + [(i, j, total)] + split(j + 1, b)
    return split(0, len(scores))


@pytest.mark.parametrize("seed", range(40))
def test_segments_against_their_definition(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 1000 for _ in range(30)]
    running = np.concatenate([[0], np.cumsum(scores)])
    positive = [i for i, s in enumerate(scores) if s > 0]
    got = t.maximal_segments(positive, running[positive].tolist(), running[np.array(positive) + 1].tolist())
    want = brute_segments(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_decay_solves_its_equation():
    counts = np.array([[100, 900], [50, 50]])
    scores = np.array([2.0, -1.0])
    rate = t.decay(scores, counts[0])
    assert np.isclose(0.1 * np.exp(2 * rate) + 0.9 * np.exp(-rate), 1, atol=1e-6)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(1500):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = rng.choices(["fool,", "Rotten", "vile."], k=3)
        texts.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return (spark.createDataFrame(texts, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy_and_passages(corpus):
    texts, labels = corpus
    rows = t.score_texts(texts, labels, prior=500.0).collect()
    hits = [(r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in rows if r["held_out"]]
    assert np.mean(hits) > 0.97
    by_id = {r["doc_id"]: r for r in texts.collect()}
    for r in rows:
        for p in r["passages"]:
            words = by_id[r["doc_id"]]["text"].split()[p["first"]:p["last"] + 1]
            assert {"fool,", "Rotten", "vile."} & set(words)


def test_the_strongest_texts_keep_their_evidence(spark, corpus):
    """So many toxic words that the expected number of chance segments is 0 as a double."""
    texts, labels = corpus
    long = [(5001, "fool, Rotten vile. " * 1500), (5002, "w1 w2 w3 " * 200 + "vile. fool, " * 300), (5003, "w1 w2 w3 " * 1500)]
    rows = t.score_texts(texts.union(spark.createDataFrame(long, texts.schema)), labels, prior=500.0).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[5001] > 0.9 and score[5002] > 0.9 and score[5003] < 0.5


def test_surprise_in_bits(spark):
    logs = [-1e6, -800.0, -745.0, -27.0, -20.1, -19.9, -1.0, 0.0, 5.0, 800.0]
    rows = spark.createDataFrame([(x,) for x in logs], "x double").select("x", t.surprise(F.col("x")).alias("bits")).collect()
    for r in rows:
        chance = -math.expm1(-math.exp(min(r["x"], 700.0)))
        assert r["bits"] == pytest.approx(min(40.0, -math.log2(chance)) if chance > 0 else 40.0, rel=1e-6, abs=1e-9)


def test_held_out_labels_are_not_used(spark, corpus):
    texts, labels = corpus
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one = {r["doc_id"]: r["score"] for r in t.score_texts(texts, labels).collect()}
    assert {r["doc_id"]: r["score"] for r in t.score_texts(texts, other).collect()} == one


def test_odd_rows(spark, docs, no_docs, corpus):
    _, labels = corpus
    odd = labels.union(spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0)], labels.schema))
    rows = t.score_texts(docs, odd).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert t.score_texts(no_docs, odd).collect() == []
    assert {r["score"] for r in t.score_texts(docs, labels.where("false")).collect()} == {0.0}
