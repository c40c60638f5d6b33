import random
import zlib
from collections import Counter

from ledgerlens.llm.uniform_shards import communication_matrix, hypergeometric, read_shards, uniform_shards, write_shards
from tests.llm.conftest import ROWS


def check(rows, n, shards):
    counts = Counter(r["shard"] for r in rows)
    assert sum(counts.values()) == n
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_every_row_has_a_slot(docs):
    rows = uniform_shards(docs, shards=5).collect()
    check(rows, len(ROWS), 5)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_shards_hold_the_whole_rows(docs, tmp_path):
    """Every column of every row comes back from the shards' files; shards are folders of their own."""
    folder = str(tmp_path / "shards")
    write_shards(docs, folder, shards=5)
    rows = read_shards(docs, folder).collect()
    check(rows, len(ROWS), 5)
    assert Counter(tuple(r["row"]) for r in rows) == Counter(map(tuple, docs.collect()))
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} == {f"shard={s}" for s in range(5)}


def test_the_result_has_the_texts(docs):
    rows = uniform_shards(docs, shards=5).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((i, t) for i, t, _ in ROWS)
    assert all(r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in rows)


def test_same_rows_same_places(docs):
    one = uniform_shards(docs.repartition(1), shards=5).collect()
    two = uniform_shards(docs.repartition(7), shards=5).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, two))


def test_empty_table(no_docs):
    assert uniform_shards(no_docs).collect() == []


def test_matrix_sums():
    rows = [17, 0, 5, 100, 3]
    matrix = communication_matrix(rows, 7, 1)
    assert [sum(r) for r in matrix] == rows
    columns = [sum(c) for c in zip(*matrix)]
    assert sum(columns) == 125 and max(columns) - min(columns) <= 1


def test_hypergeometric_law():
    rng = random.Random(3)
    drawn = Counter(hypergeometric(rng, 6, 10, 5) for _ in range(40_000))
    from math import comb
    for k in range(6):
        want = comb(6, k) * comb(10, 5 - k) / comb(16, 5)
        assert abs(drawn[k] / 40_000 - want) < 0.01
    assert hypergeometric(rng, 0, 9, 4) == 0 and hypergeometric(rng, 9, 0, 4) == 4
    big = [hypergeometric(rng, 10**9, 23 * 10**9, 10**8) for _ in range(50)]
    assert abs(sum(big) / 50 - 10**8 / 24) < 3 * 2000


def test_uniform_over_places(spark):
    """Each row is in each shard about equally often over seeds."""
    table = spark.range(60).selectExpr("id AS doc_id", "'t' AS text")
    hits = Counter()
    for seed in range(30):
        rows = uniform_shards(table, shards=3, blocks=4, cells=2, seed=seed).collect()
        check(rows, 60, 3)
        hits.update((r["doc_id"] // 20, r["shard"]) for r in rows)
    assert all(abs(n - 200) < 60 for n in hits.values())
