import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from ledgerlens.llm import viterbi_pieces as v
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b   c ", "x\ny\n\n z", "日本 語😀 \x01", "é <s> </s> <0x41>", "  \t tab\r\n", "aaaaaaaaaaaaaaaaaaaa",
       "internationalisation", "The theThe,the.", "=====----====", "x" * 5000]


def test_ids_are_the_librarys():
    texts = ODD + [t or "" for _, t, _ in ROWS]
    ids, offsets = v.encode_batch(pa.array(texts), PATH)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == model.encode(texts)
    assert v.decode_batch(ids, offsets, PATH) == texts


def test_rows_come_back(spark, docs, no_docs):
    rows = v.decode(v.encode(docs, PATH), PATH).collect()
    assert sorted(r["decoded"] for r in rows) == sorted(t or "" for _, t, _ in ROWS)
    assert all(r["size"] == "clash" and len(bytes(r["ids"])) % 4 == 0 for r in rows)
    both = v.round_trip(docs, PATH).collect()
    assert sorted((bytes(r["ids"]), r["decoded"]) for r in both) == sorted((bytes(r["ids"]), r["decoded"]) for r in rows)
    assert v.decode(v.encode(no_docs, PATH), PATH).collect() == []


def test_unigram_paths_against_brute_force():
    """The best sum over all segmentations of short words."""
    p = v.Pieces(PATH, "unigram")
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def best(word):
        if not word:
            return 0.0
        return max(score[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in score)

    words = [v.SPACE + w for w in ["the", "theory", "ended", "nation", "a", "shing"]]
    ids, starts, lengths = p.search(words)
    for w, a, n in zip(words, starts, lengths):
        pieces = [model.id_to_piece(int(i)) for i in ids[a:a + n]]
        assert "".join(pieces) == w and np.isclose(sum(score[x] for x in pieces), best(w))
