import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import combination_join as j
from ledgerlens.llm import components as c
from ledgerlens.llm.components import components
from tests.llm.conftest import ROWS, sentence
from tests.llm.test_contamination import shingles


def brute(rows):
    """(id, size, component) of every row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root(b) == root(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids) if ids else None))
    return sorted(out, key=str)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, docs, seed):
    rng = random.Random(seed)
    rows = [(i, t) for i, t, _ in ROWS]
    passage = sentence(33, 40)
    for g in range(14):
        base = sentence(100 + g, rng.choice([6, 12, 17, 33, 60, 150, 400])).split()
        for _ in range(rng.choice([2, 5, 30])):
            rows.append((1000 + len(rows), edited(base, rng, rng.randrange(0, 2 + len(base) // 40))))
    for _ in range(40):
        rows.append((1000 + len(rows), passage + " " + sentence(rng.randrange(10**4), rng.randrange(1, 60))))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = j.join_components(table, rounds=seed + 1).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("frequent", [0, 1000])
def test_linked_sets_share_a_signature(frequent):
    """With all tokens frequent, or none, for sizes around every size class."""
    rng = np.random.default_rng(7)
    for n in [1, 2, 3, 7, 8, 13, 15, 16, 17, 20, 31, 32, 40, 64, 100, 130, 257]:
        for _ in range(30):
            x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            y = np.unique(np.concatenate([rng.choice(x, max(1, int(n * rng.uniform(0.75, 1))), replace=False),
                                          rng.integers(0, 1 << 62, rng.integers(0, n // 5 + 1)).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                steps = lambda t: (t % np.uint64(7)).astype(np.uint8)
                limit = frequent if frequent else 3
                (mine, near), (other, other_near) = j.signatures(x, steps(x), limit), j.signatures(y, steps(y), limit)
                mine, other = mine[near | (len(x) > len(y))], other[other_near | (len(y) > len(x))]
                assert len(np.intersect1d(mine, other))


def test_keep_one(docs, no_docs):
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(i, c) for i, n, c in brute([(i, t) for i, t, _ in ROWS]) if i == c and n}
    rows = kept.collect()
    worded = [r["doc_id"] for r in rows if r["text"] and r["text"].strip()]
    assert set(worded) == {i for i, _ in want}
    assert len(worded) == len(want) + 1  # two unlike texts without an id
    assert len([r for r in rows if not (r["text"] and r["text"].strip())]) == 4
    assert j.keep_one(no_docs).collect() == [] and j.join_components(no_docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 501), (500, 501)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r["node"]: r["component"] for r in rows}
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(30)} == {100} and found[501] == 500
    assert len(found) == 41 + 30 + 2


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for n in [1, 2, 9, 31, 33, 100, 700]:
        for share in (0.8, 0.9, 1.0):
            x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            y = np.unique(np.concatenate([rng.choice(x, max(1, int(n * share)), replace=False), rng.integers(0, 1 << 62, n // 10).astype(np.uint64)]))
            apart = len(np.setxor1d(x, y))
            assert j._bits_apart(j._sketch(x), j._sketch(y)) <= apart


def test_many_rows_without_an_id(spark):
    """A set is fetched by id and text, so rows of one id or none bring their own sets only."""
    rows = [(None, sentence(k, 30)) for k in range(2000)] + [(7, sentence(k, 31)) for k in range(500)] + [(None, "the same words here again and again")] * 300
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = j.join_components(table)
    assert got.count() == len(rows)
    texts = {t for _, t in rows}
    assert got.select("key").distinct().count() == len(texts)
    keyed = table.select("text", j._key(table["doc_id"], table["text"]).alias("key"), table["doc_id"].alias("id"))
    first = j._first_pass(keyed, 5)
    nodes = first.where("node IS NOT NULL").select("node").distinct()
    sets = j._sets_of(keyed, nodes, first, 5)
    assert sets.select("node").distinct().count() == nodes.count() and sets.count() <= nodes.count() + 8


def test_candidates_go_nearest_first(spark):
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 2), (2, 3, 9), (4, 5, 1), (1, 5, 7)], "a long, b long, apart int")
    assert {tuple(r) for r in j._nearest(pairs, 1).collect()} == {(1, 3), (1, 2), (4, 5)}
    found = spark.createDataFrame([(1, 1), (3, 1), (4, 4), (5, 4)], "node long, component long")
    assert {(r["a"], r["b"]) for r in j._between(pairs, found).collect()} == {(1, 2), (2, 3), (1, 5)}


def test_decided_pairs_leave_their_groups(spark, monkeypatch):
    """Two texts of one signature that do not link are compared once; the last step never sees them."""
    seen = []
    monkeypatch.setattr(j, "_all_pairs_left", lambda groups, sets, least: seen.append(groups.count()) or groups.select(
        "node", "other").toDF("a", "b").withColumn("apart", F.lit(0)).limit(0))
    ids = np.arange(40, dtype=np.uint64)
    sets = spark.createDataFrame([(k, (ids + np.uint64(1000 * k)).tobytes(), j._sketch(ids + np.uint64(1000 * k))) for k in range(6)],
                                 "node long, tokens binary, sketch binary")
    members = [(100, 0), (100, 1), (200, 2), (200, 3), (200, 4)]
    groups = spark.createDataFrame([(s, n, 40, True) for s, n in members], "sig long, node long, size long, near boolean")
    assert j._link_components(groups, sets, 80, 1).count() == 0
    assert seen == [2]  # of the group of three, its two others
    seen.clear()
    assert j._link_components(groups, sets, 80, 2).count() == 0
    assert seen == []


def test_only_named_sets_are_compared(spark):
    ids = np.arange(40, dtype=np.uint64)
    sets = spark.createDataFrame([(k, (ids + np.uint64(k)).tobytes()) for k in range(50)], "node long, tokens binary")
    pairs = spark.createDataFrame([(1, 2), (3, 30), (7, 9)], "a long, b long")
    found = j._verified(pairs, sets, 80)
    assert {tuple(r) for r in found.collect()} == {(1, 2), (7, 9)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2


def test_signature_rows_are_dealt_as_they_come(spark):
    rows = [(k, sentence(k // 2, 60) + f" tail{k}") for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = j._signature_rows(table, 5, np.zeros(1 << j.BITS, np.uint8), 9, 80)
    assert made.columns == ["sig", "node", "info", "others"]
    got = j._groups(made, 80)
    assert got.columns == ["sig", "node", "size", "near"]
    want = set()
    for _, text in rows:
        (tokens,) = j._sets(pa.array([text]), 5)
        sigs, near = j.signatures(tokens, np.zeros(len(tokens), np.uint8), 9, 80)
        want |= {(int(s), j._node(tokens), len(tokens), bool(n)) for s, n in zip(sigs.astype(np.int64), near)}
    shared = {s for s, *_ in want if len({n for x, n, *_ in want if x == s}) > 1}
    assert {tuple(r) for r in got.collect()} <= {w for w in want if w[0] in shared} and got.count() > 20


def test_components_grow_with_further_links(spark, monkeypatch):
    """Links are merged into known components, and a long way costs few tables."""
    rng, tables, real = random.Random(3), [], c.written
    monkeypatch.setattr(c, "written", lambda df, purpose: tables.append(purpose) or real(df, purpose))
    nodes = rng.sample(range(10**6), 120)
    parts = [[(nodes[k], nodes[k + 1]) for k in range(0, 59)] + [(nodes[60], nodes[61])] * 2,
             [tuple(rng.sample(nodes[62:], 2)) for _ in range(30)] + [(nodes[118], nodes[118])],
             [(nodes[60], nodes[5]), (nodes[5], nodes[60]), (nodes[0], nodes[59])]]
    found, parent = None, {}
    for links in parts:
        found = components(spark.createDataFrame(links, "a long, b long").repartition(3), found)
        for a, b in links:
            a, b = parent.setdefault(a, a), parent.setdefault(b, b)
            parent.update({k: min(a, b) for k, v in parent.items() if v in (a, b)})
        rows = found.collect()
        assert {(r["node"], r["component"]) for r in rows} == set(parent.items()) and len(rows) == len(parent)
    assert len(tables) < 45
    path = components(spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long")).collect()
    assert len(path) == 201 and {r["component"] for r in path} == {0}


def test_few_candidates_left_go_in_one_turn(spark, monkeypatch):
    """No pair links: after the first turn what is left is decided at once, each pair once."""
    seen, real = [], j._verified
    monkeypatch.setattr(j, "_verified", lambda pairs, sets, least: seen.append(sorted(map(tuple, pairs.select("a", "b").collect()))) or real(pairs, sets, least))
    ids = np.arange(40, dtype=np.uint64)
    sets = spark.createDataFrame([(k, (ids + np.uint64(1000 * k)).tobytes()) for k in range(6)], "node long, tokens binary")
    pairs = [(a, b, 10 * a + b) for a in range(6) for b in range(a + 1, 6)]
    assert j._nearest_first(spark.createDataFrame(pairs[:13], "a long, b long, apart int"), sets, None, 80) is None
    assert len(seen) == 2 and sorted(seen[0] + seen[1]) == sorted((a, b) for a, b, _ in pairs[:13])


def test_kept_rows_move_once(spark, docs):
    """Whole rows are dealt out by key once; copies of id and text that differ in other columns leave one."""
    rows = [(k % 20, sentence(k % 20, 30), f"s{k}") for k in range(60)] + [(None, sentence(99, 30), "x"), (None, sentence(99, 30), "y")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = j.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # rows, and the winners
        assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted((k, sentence(k, 30)) for k in range(20))
        assert kept.where("doc_id IS NULL").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
