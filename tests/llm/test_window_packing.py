import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import window_packing as w
from ledgerlens.operators.sizing import written
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(texts, end_id=0):
    return [LIBRARY.encode(t, add_special_tokens=False).ids + [end_id] for t in texts]


def one_by_one(counts, window):
    """Best-fit decreasing, a piece at a time: the room left in each window."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(window - length)
    return sorted(rooms)


def test_units_against_the_library():
    texts = ["  a", "a  b", "a   b", "a \n b", "a\n  b\n\n  \n c   ", "   ", "", "x \xa0 y", "x　 y   z", "abc,", "a,'s", "it's. don't",
             "a <|endoftext|>  b  <|endoftext|>", "\x01 a  b", " \t a", "a\x1c  b", "日本 語😀  👍🏽 日本,。", "\x0b  \x0c a \x85  b", "x" * 3000,
             "a b.\nc d\n\ne f,\ng.", "a x\ny z w", "a b\n", "a \nb c", "a 1\n2 c", "\na b\nc", " a.\n1,", " \x0b\nb", "naïve...### ²½,"]
    draw = random.Random(1)
    signs = ["a", " ", "\n", " ", "'s", "\xa0", " ", "é", "1", "!", "\t", "\x1d", "​", "\x85", "bc"]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randint(0, 14))) for _ in range(5000)]
    for width, kind in ((2, "<u2"), (4, "<u4")):
        got = [np.frombuffer(ids, kind).tolist() for ids in w.encode(pa.array([*texts, None]), PATH, 0, width)]
        assert got == library([*texts, ""])


def test_units_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(w, "_CACHED", 5)
    w._encoder.cache_clear()
    texts = [f"words like these {i} come and go, words go " for i in range(50)]
    assert [np.frombuffer(x, "<u4").tolist() for x in w.encode(pa.array(texts), PATH, 0)] == library(texts)
    w._encoder.cache_clear()


def test_tree_finds_the_tightest():
    tree, open_, draw = w.CapacityTree(37), set(), random.Random(2)
    for _ in range(2000):
        c = draw.randrange(38)
        tree.mark(c, c not in open_)
        open_ ^= {c}
        size = draw.randrange(1, 38)
        assert tree.tightest(size) == min((x for x in open_ if x >= size), default=None)


@pytest.mark.parametrize("lengths", [
    [random.Random(k).randint(1, 99) for _ in range(400)] for k in range(3)] + [[1] * 1000, [50] * 7 + [51] * 3, [99] * 20 + [1] * 5, [], [33] * 10 + [34] * 10])
def test_plan_against_one_by_one(lengths):
    counts = Counter(lengths)
    runs, windows = w.plan(counts, 100)
    held = defaultdict(list)
    for r in runs:
        for k in range(r.pieces):
            held[r.sequence + k // r.each].append((r.offset + k % r.each * r.length, r.length))
    for pieces in held.values():
        upto = 0
        for offset, length in sorted(pieces):
            assert offset == upto
            upto += length
    assert sorted(held) == list(range(windows))
    assert sorted(100 - sum(n for _, n in p) for p in held.values()) == one_by_one(counts, 100)
    for n in counts:
        ranks = sorted((r.rank, r.pieces) for r in runs if r.length == n)
        assert [a for a, _ in ranks] == [sum(p for _, p in ranks[:k]) for k in range(len(ranks))]
        assert sum(p for _, p in ranks) == counts[n]


def check(spark, table, texts, window):
    """Pieces cover each document once, sequences are gapless, padding is that of one global packing."""
    sequences = written(w.pack(table, window=window))
    pieces = w.read_pieces(sequences).collect()
    ids = defaultdict(list)
    for p in pieces:
        ids[p["doc_id"]].append((p["start"], p["doc_tokens"], np.frombuffer(p["ids"], "<u4").tolist()))
        assert p["length"] * 4 == len(p["ids"])
    want = defaultdict(list)
    for (i, text) in texts:
        want[i].append(library([text or ""])[0])
    for i, docs in want.items():
        made = sorted((start, total, part) for start, total, part in ids[i])
        cut = sorted((a, len(d), d[a:a + window]) for d in docs for a in range(0, len(d), window))
        assert made == cut
    assert sorted(ids, key=str) == sorted(want, key=str)
    rows = sequences.collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    for r in rows:
        upto = 0
        for p in r["pieces"]:
            assert p["offset"] == upto
            upto += p["length"]
        assert upto == r["n_tokens"] == len(r["ids"]) // r["id_bytes"] <= window
        assert r["padded"] == (upto if upto & (upto - 1) == 0 else window)
    rest = Counter(len(d) % window for docs in want.values() for d in docs if len(d) % window)
    rooms = sorted(window - r["n_tokens"] for r in rows)
    fulls = sum(len(d) // window for docs in want.values() for d in docs)
    assert rooms == sorted([0] * fulls + one_by_one(rest, window))


@pytest.mark.parametrize("window", [64, 1024])
def test_odd_rows(spark, docs, window):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    check(spark, docs, [(i, t) for i, t, _ in ROWS], window)


def test_a_third_of_equal_rows(spark):
    texts = [(None, "")] * 300 + [(7, "the same words again")] * 300 + [(i, "some words " * (i % 90)) for i in range(300)]
    check(spark, spark.createDataFrame(texts, "doc_id long, text string").repartition(6), texts, 100)


def test_empty_table(spark, no_docs):
    assert w.read_pieces(written(w.pack(no_docs))).collect() == []
