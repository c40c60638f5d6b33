import hashlib
import re

from pyspark.sql import functions as F

from ledgerlens.llm import blob_ledger as b
from ledgerlens.session import work_folder
from tests.llm.conftest import ROWS

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
TRICKY = [
    "token=short token: token: abcdefgh", "PASSWORD='a1b2c3d4'", "secret = secret=abcdefgh12", "apikey:12345678 api_key=1234567",
    "AKIA1234", "AKIAAKIAAKIAAKIAAK", "x" + "0a" * 16 + "g" + "0" * 31, "é😀 passwd: abcdefgh-é token=zzzzzzzz", "",
]


def brute(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def base(row):
    return sorted(tuple(s) for s in row["spans"] if s["kind"] in ("assign", "access", "hex"))


def test_spans_against_brute_force(spark, docs):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    rows = b.scan(docs.select("doc_id", "text").union(extra), work_folder(spark, "l")).collect()
    texts = [t for _, t, _ in ROWS] + TRICKY
    got = sorted((r["blob"], base(r)) for r in rows)
    assert got == sorted((hashlib.sha256((t or "").encode()).digest(), brute(t)) for t in texts)


def test_clashing_columns_and_empty_table(spark, docs, no_docs):
    ledger = work_folder(spark, "l")
    assert b.scan(no_docs, ledger).collect() == []
    assert b.scan(docs, ledger).count() == len(ROWS)


def test_only_unseen_pairs_are_scanned(spark):
    ledger = work_folder(spark, "l")
    first = spark.createDataFrame([("a.txt", "token=abcdefgh"), ("b.txt", "nothing")], "path string, text string")
    b.scan(first, ledger, "path")
    before = b.read_ledger(spark, ledger).count()
    assert before == 2 * len(b.RULES)
    again = spark.createDataFrame([("c.txt", "token=abcdefgh"), ("a.txt", "token=abcdefgh")], "path string, text string")
    rows = b.scan(again, ledger, "path").collect()
    assert b.read_ledger(spark, ledger).count() == before
    assert {r["path"]: [s["kind"] for s in r["spans"]] for r in rows} == {"a.txt": ["assign"], "c.txt": ["assign"]}
    newer = (*b.RULES[1:], b.Rule("assign", "nothing", version=2))
    rows = b.scan(first, ledger, "path", rules=newer).collect()
    assert b.read_ledger(spark, ledger).count() == before + 2
    assert {r["path"]: len(r["spans"]) for r in rows} == {"a.txt": 0, "b.txt": 1}


def test_mask(spark):
    text = 'é😀 api_key = "abcdefgh1234" tail token=zzzzzzzzz'
    row = b.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), work_folder(spark, "l"))
    masked = row.select(b.mask(F.lit(text), F.col("spans")).alias("m")).first()["m"]
    assert masked == 'é😀 [secret]" tail [secret]'
