import re

from pyspark.sql import functions as F

from ledgerlens.llm import contamination as c
from tests.llm.conftest import CLASHES, ROWS, sentence

W = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = W.findall((text or "").translate(LOW))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs, items):
    found = set()
    for d, text in docs:
        mine = shingles(text)
        for i, item in items:
            want = shingles(item)
            if want and i is not None and 10 * len(want & mine) >= 8 * len(want):
                found.add((d, i, len(want), len(want & mine)))
    return found


def test_against_brute_force(spark, docs):
    items = [(k, sentence(50 + k, 8 + 9 * k)) for k in range(6)]
    items += [(20, "one two three"), (21, None), (22, ""), (23, "one two three"), (24, sentence(5, 300)), (None, "one two three"),
              (25, "word word word word word word word")]
    planted = []
    for n, (k, item) in enumerate(items[:6]):
        words = item.split()
        near = words[:-1] + ["changed"]
        far = words[:len(words) // 2] + ["gap"] * 40 + words[len(words) // 2:]
        for j, passage in enumerate((words, near, [w.upper() for w in words], words[: len(words) * 2 // 3], far)):
            planted.append((200 + 10 * n + j, sentence(90 + n, 700) + " " + " ".join(passage) + " " + sentence(70 + j, 300 * j)))
    extra = spark.createDataFrame(planted, "doc_id long, text string")
    got = c.contained_items(docs.select("doc_id", "text").union(extra), spark.createDataFrame(items, "item_id long, text string"))
    want = brute([(i, t) for i, t, _ in ROWS] + planted, items)
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got.collect()} == want
    assert len(want) > 20 and got.count() == len(want)


def test_clashes_and_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, sentence(1, 20))], "item_id long, text string").withColumns({x: F.lit(1) for x in CLASHES})
    assert {r["doc_id"] for r in c.contained_items(docs, items).collect()} == {1, 2, 3}
    assert c.contained_items(no_docs, items).collect() == []
    assert c.contained_items(docs, items.where("false")).collect() == []
