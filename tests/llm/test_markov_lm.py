import itertools
import math
import zlib
from collections import Counter

import numpy as np

from ledgerlens.llm import markov_lm as m
from tests.llm.conftest import ROWS
from tests.llm.test_contamination import LOW, W


def tokens(text):
    return W.findall((text or "").translate(LOW)) + ["\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_base_scores_against_counts(docs):
    rows = m.score_texts(docs, states=3, rounds=2, buckets=64).collect()
    count = Counter()
    for i, t, _ in ROWS:
        if not held(i):
            count.update(tokens(t))
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(i), held(i), len(w := tokens(t)), sum(count[x] > 0 for x in w), total,
                   round(sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w), 6)) for i, t, _ in ROWS)
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def random_model(states, symbols, seed):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return m.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def path_sums(model, symbols):
    """Probability of the symbols and expected counts, over all state paths."""
    states = len(model.start)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    total = 0.0
    for path in itertools.product(range(states), repeat=len(symbols)):
        p = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:]):
            p *= model.move[a, b] * model.emit[s, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for a, s in zip(path, symbols):
            emit[s, a] += p
    return total, start / total, move / total, emit / total


def test_recursions_against_all_paths():
    model = random_model(3, 5, 0)
    sequences = [[0, 1, 2, 4, 4], [3], [2, 2, 1], [4, 0]]
    flat, sizes = np.concatenate(sequences), np.array(list(map(len, sequences)))
    begins = np.cumsum(sizes) - sizes
    got = m.log_likelihood(flat, begins, sizes, model)
    want = [path_sums(model, s) for s in sequences]
    assert np.allclose(got, [math.log10(w[0]) for w in want])
    start, move, emit = m.expected_counts(flat, begins, sizes, model)
    for value, place in ((start, 1), (move, 2), (emit, 3)):
        assert np.allclose(value, sum(w[place] for w in want), atol=1e-5)


def test_training_raises_the_likelihood(spark):
    """Texts of two vocabularies; states that learn them beat one state."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * k * k + k) % 13}" for k in range(1, 150))) for i in range(80)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sums = {(s, r): sum(x["score"] for x in m.score_texts(table, states=s, rounds=r, buckets=256).collect()) for s, r in ((1, 1), (2, 1), (2, 4))}
    assert sums[2, 4] >= sums[2, 1] > sums[1, 1] + 100


def test_windows_cover_all_tokens():
    begins, sizes = m._windows(np.array([5, 1, 8, 4]), np.array([True, False, True, True]), 4)
    assert sorted(t for b, n in zip(begins, sizes) for t in range(b, b + n)) == [0, 1, 2, 3, 4, *range(6, 18)]


def test_words_of_a_bucket_add_up_to_one(docs):
    """The shares of a bucket's words and its unknown word come to one."""
    count = Counter(x for i, t, _ in ROWS if not held(i) for x in tokens(t))
    buckets = {}
    for w, c in count.items():
        if w != "\n":
            buckets.setdefault(zlib.crc32(w.encode()) % 64, []).append(c)
    for c in buckets.values():
        assert math.isclose(sum((x + 1) / (sum(c) + len(c) + 1) for x in c) + 1 / (sum(c) + len(c) + 1), 1)


def test_empty_table(no_docs):
    assert m.score_texts(no_docs).collect() == []
