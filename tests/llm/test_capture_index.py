import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import capture_index as c
from ledgerlens.llm import store
from ledgerlens.session import work_folder

BIG = "<p>é</p>" * 300
PAGES = [
    (1, "http://www.Example.com/a?b=1", BIG), (2, "https://user@example.com:80/", BIG), (5, "http://x.org", BIG),
    (3, "http://x.org", "short"), (4, "http://x.org", "short"), (6, None, None), (7, "no url", ""), (8, "line\nbreak\t", "x" * 5000),
    (None, "http://nobody.net/", BIG), (None, "http://nobody.net/", "y" * 2000), (9, "http://nine.net/", "z" * 2000), (9, "http://nine.net/", "z" * 2000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns(
        {n: F.lit("clash") for n in ("id", "payload", "same", "first", "kind", "key", "file", "offset")}).repartition(3)


def written(spark, pages, lines=2):
    captures = c.write_archives(pages, work_folder(spark, "w"))
    return captures, c.write_index(captures, work_folder(spark, "i"), lines)


def test_records_come_back(spark, pages):
    _, shards = written(spark, pages)
    rows = c.read_records(c.lookup(pages, shards)).collect()
    got = sorted((r["id"] or -1, r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"] or -1) for r in rows)
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        ids = [j for j, _, h in PAGES if (h or "") == (html or "")]
        known = [j for j in ids if j is not None]
        first = max(known) if len(raw) >= 1000 and len(ids) > 1 and known else None
        revisit = first is not None and i != first
        want.append((i or -1, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else -1))
    assert got == sorted(want)
    payloads = {r["id"]: r["payload"] for r in rows if r["kind"] == "response"}
    assert bytes(payloads[5]).decode() == BIG


def test_lookup_finds_one_url(spark, pages):
    captures, shards = written(spark, pages)
    ask = spark.createDataFrame([("http://x.org",), ("http://absent.org/",), ("http://x.org",)], "url string")
    assert sorted(r["id"] for r in c.lookup(ask, shards).collect()) == [3, 4, 5]
    assert captures.count() == len(PAGES)
    assert [s.first for s in shards] == sorted(s.first for s in shards)


def test_hot_key_over_many_blocks(spark):
    table = spark.range(500).selectExpr("id AS page_id", "IF(id < 400, 'http://hot.com/', concat('http://h', id, '.com/')) AS url", "'h' AS html")
    _, shards = written(spark, table, 7)
    rows = c.read_records(c.lookup(table, shards)).collect()
    assert sorted(r["id"] for r in rows) == list(range(500))


def test_archives_are_gzip_members(spark, pages):
    captures, _ = written(spark, pages)
    for file in {r["file"] for r in captures.collect()}:
        with store.reader(file) as f:
            text = gzip.decompress(f.read()).decode()
        assert text.count("WARC/1.1\r\n") == captures.where(F.col("file") == file).count()


def test_keys_reverse_the_host(spark):
    urls = ["http://www.Example.com/a?b=1", "https://user@example.com:80/", "no url", None, "//a.b/c"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(c.url_key(F.col("url")).alias("k")).collect()
    assert [r["k"] for r in rows] == ["com,example,www)/a?b=1", "com:80,example)/", "no url", "", "b,a)/c"]


def test_empty_table(spark, pages):
    none = pages.where("false")
    _, shards = written(spark, none)
    assert c.read_records(c.lookup(pages, shards)).collect() == []
