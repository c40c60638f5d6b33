import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm import fertility as f
from tests.llm.conftest import CLASHES, ROWS, sentence

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, seen, again = W.findall(text), set(), 0
    for line in text.split("\n"):
        if W.search(line):
            again += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit)


def test_counts_against_brute_force(docs):
    rows = f.judge(docs).collect()
    got = Counter((r["doc_id"], r["lang"], *[r[c] for c in f.COUNTS[:5]]) for r in rows)
    assert got == Counter((i, lang, *brute(t)) for i, t, lang in ROWS)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_kept_rows_keep_their_columns(docs, no_docs):
    kept = f.kept_rows(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, 3, None}
    assert all(r[c] == "clash" for r in kept.collect() for c in CLASHES)
    assert f.kept_rows(no_docs).collect() == [] and f.judge(no_docs).collect() == []


def test_odd_texts_fall_outside_the_band(spark):
    good = [(i, sentence(i, 300), "en") for i in range(60)]
    odd = [(100, " ".join(chr(0x16A0 + (i * 7 + k) % 80) for i in range(40) for k in range(5)) + " x" * 20, "en"),
           (101, " ".join(f"%%{c}$$#" for c in sentence(3, 300).split()), "en")]
    rows = f.judge(spark.createDataFrame(good + odd, "doc_id long, text string, lang string")).where(~F.col("base_failed"))
    kept = {r["doc_id"]: r["kept"] for r in rows.collect()}
    assert all(kept[i] for i in kept if i < 100)
    assert not kept.get(100, False) and not kept[101]


#: Syllables of four languages, so that texts of a language are alike in how often a vocabulary splits their words.
SYLLABLES = {
    "en": "the and ing ion er re an st ble sh th on es in ha".split(),
    "de": "der und ein ge be ver ung heit ich sch en er lich auf zu".split(),
    "fr": "le la que eau tion elle re en eux ier oi on au ment é".split(),
    "es": "el la que ción ado os as re men te lo un ía ó do".split()}


def prose(rng, lang, n):
    return ["".join(rng.choices(SYLLABLES[lang], k=rng.choice([1, 1, 2, 2, 3]))) for _ in range(n)]


def test_littered_texts_of_every_language_and_length(spark):
    """Signs after every word fail, short or long; clean texts, also with one long secret, pass."""
    rng, rows, odd = random.Random(4), [], set()
    for lang in SYLLABLES:
        for i in range(150):
            rows.append((len(rows), " ".join(prose(rng, lang, rng.choice([60, 100, 300, 800]))), lang))
        for n in (60, 100, 300, 2000):
            odd.add(len(rows))
            rows.append((len(rows), " ".join(w + rng.choice(["&&&", "$$$", "%%%", "***"]) for w in prose(rng, lang, n)), lang))
            secret = "".join(rng.choices("0123456789abcdef", k=40))
            rows.append((len(rows), " ".join([*prose(rng, lang, n), secret]), lang))
    got = f.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where(~F.col("base_failed")).collect()
    assert odd <= {r["doc_id"] for r in got}
    assert [r["doc_id"] for r in got if r["kept"] and r["doc_id"] in odd] == []
    wrong = [r["doc_id"] for r in got if not r["kept"] and r["doc_id"] not in odd]
    assert len(wrong) <= 0.02 * len(got)


def test_standard_errors():
    words = arrays.split(pa.array(["a bb ccc", "", "a a a"]))
    sizes = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    value, err = f.ratio(words, sizes, np.ones(len(sizes), np.int64))
    assert np.allclose(value, [2, 0, 1]) and np.allclose(err, [np.sqrt(2) / 3, 0, 0])


def test_workers_get_a_text_once(docs, monkeypatch):
    made = []
    written = f.written
    monkeypatch.setattr(f, "written", lambda df, purpose: made.append(df) or written(df, purpose))
    kept = f.kept_rows(docs)
    assert list(made[0]._jdf.queryExecution().analyzed().children().head().schema().fieldNames()) == ["row", "lang"]
    judged = {(r["doc_id"], r["lang"], r["kept"]) for r in f.judge(docs).collect()}
    assert {(r["doc_id"], r["lang"], True) for r in kept.collect()} <= judged


def test_an_encoder_remembers_few_words():
    path = f.public_tokenizers.path("word_bpe_49k.json")
    small, large = f.WordEncoder(path, 50), f.WordEncoder(path)
    for k in range(4):
        vocab = pa.array(sorted({w + str(k) for w in sentence(k, 400).split()} | {f"strange{i}x" for i in range(40 * k)}))
        for a, b in zip(small(vocab), large(vocab)):
            assert a.tolist() == b.tolist()
    assert len(small.words) <= 50 and len(small.older) <= 50 < len(large.words)
    assert f._encoder(path).cached == f.CACHED
