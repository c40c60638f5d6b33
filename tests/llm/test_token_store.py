import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerlens.llm import token_store as t
from ledgerlens.session import work_folder
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    return [e.ids + [1] for e in Tokenizer.from_file(PATH).encode_batch(list(texts), add_special_tokens=False)]


def test_files_give_back_the_ids(spark, docs):
    made = t.write_tokens(docs, work_folder(spark, "t"))
    rows = t.read_tokens(spark, made).collect()
    want = defaultdict(list)
    for (i, text, _), ids in zip(ROWS, library(x or "" for _, x, _ in ROWS)):
        want[i].append(np.array(ids, "<u4").tobytes())
    got = defaultdict(list)
    for r in rows:
        got[r["id"]].append(bytes(r["ids"]))
        assert r["n_tokens"] * 4 == len(r["ids"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0, *[r["n_tokens"] for r in ordered]])[:-1].tolist()
    keys = [-1 << 63 if r["id"] is None else r["id"] for r in ordered]
    assert keys == sorted(keys)


def test_one_document(spark, docs):
    made = t.write_tokens(docs, work_folder(spark, "t"))
    files = [r["file"] for r in spark.read.parquet(made.manifest).collect()]
    hits = [x for x in (t.fetch(made, f, 9) for f in files) if x is not None]
    assert [h.tolist() for h in hits] == library(["one two three"])
    assert all(t.fetch(made, f, 12345) is None for f in files)


def test_empty_table(spark, no_docs):
    assert t.read_tokens(spark, t.write_tokens(no_docs, work_folder(spark, "t"))).collect() == []


def test_words_against_the_library():
    texts = ["It's DON'T we'll 12 3a4 x² ½ naïve ÀÉß", "<|startoftext|>a<|endoftext|>", "Áé ﬁ Ǆ İ ς Σ",
             "a b c‍d", "###!!!$$$ ... 日本語 한국어 😀👍🏽", "\x01\x02 \x7f", "x" * 3000, ""]
    ids, offsets = t.encode(pa.array(texts), PATH, 1)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == library(texts)
    assert t.crc32(b"abc") == zlib.crc32(b"abc")
