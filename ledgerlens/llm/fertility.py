r"""Quality rules on tokeniser fertility.

Two public vocabularies read every text; texts they split oddly are odd. Numbers:

* characters a token: code points in words over pieces of the words, under each;
* pieces a word, under each;
* byte-fallback share: pieces that stand for single bytes, over all pieces of the first;
* token entropy: bits a token of the text's own piece counts, over the most that
  its number of pieces allows, so that short and long texts compare.

Words are `[^\x20\x09-\x0D]+`. Each distinct word of a piece of text is encoded
once by each library, in the first vocabulary with the space that precedes a word.

Rejection bands are set for each language or script (`lang_col`) from all rows: the
quartiles of a number, stretched by `reach` times their distance on either side, and
by at least a floor, so that a narrow language does not reject its own tail. All
numbers but entropy are ratios of sums over words, whose sampling error follows from
the text's own words. The distance of the quartiles holds the error of a typical
text; that is taken out and the text's own put in. So texts that are short, or have a
few long words among ordinary ones, get just the room that chance needs.
Quartiles come from `percentile_approx`, whose state is bounded. Texts with fewer
than `least_tokens` pieces have no fertility verdict and leave the bands alone.

Base rules: fewer than `least_words` words, or more than half of the words lie in
three-word windows that occur twice or more.

Null texts have no words and fail the base rules; a null language is a language of
its own. Repeated rows each get their row. An empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.token_store import WordEncoder
from ledgerlens.operators.sizing import written

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: The least stretch beyond a quartile, for all numbers that have a band.
FLOORS = {"chars_per_token": 0.05, "byte_share": 0.02, "entropy": 0.06,
          "pieces_per_word": 0.1, "second_chars_per_token": 0.05, "second_pieces_per_word": 0.1}
#: Bytes of text that are measured at once, and words that an encoder remembers: workers of several tasks share a machine's memory.
PIECE_BYTES = 2 << 20
CACHED = 150_000
#: The distance of the quartiles of a normal law, in standard deviations.
QUARTILES = 1.349


@lru_cache(maxsize=2)
def _model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path, CACHED)


def ratio(words: arrays.Words, top: np.ndarray, bottom: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the sum of `top` over that of `bottom`, numbers of the vocabulary's words, and its standard error."""
    below = np.maximum(words.total(bottom), 1)
    value = words.total(top) / below
    rest = words.total(top * top) - 2 * value * words.total(top * bottom) + value ** 2 * words.total(bottom * bottom)
    return value, np.sqrt(np.maximum(rest, 0)) / below


def repeated_windows(words: arrays.Words, width: int = 3) -> np.ndarray:
    """For each text, the words in `width`-word windows that it has twice or more."""
    n, owner = len(words.ids), words.owner
    if n < width:
        return np.zeros(len(words.counts), np.int64)
    key = owner[:n - width + 1].astype(np.uint64)
    for k in range(width):
        key = arrays.mixed(key * np.uint64(0x9E3779B97F4A7C15) + words.ids[k:n - width + 1 + k].astype(np.uint64))
    whole = np.flatnonzero(owner[:n - width + 1] == owner[width - 1:])
    _, which, count = np.unique(key[whole], return_inverse=True, return_counts=True)
    begins = whole[count[which] > 1]
    hit = np.zeros(n, np.int64)
    for k in range(width):
        hit[begins + k] = 1
    return arrays.sums(hit, words.offsets)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line of it."""
    lists = pc.split_pattern(texts, "\n")
    coded = lists.flatten().dictionary_encode()
    lines = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    keep = worded[lines]
    lines, owner = lines[keep], owner[keep]
    first = np.unique(owner * len(coded.dictionary) + lines, return_index=True)[1]
    return np.bincount(owner, minlength=len(texts)) - np.bincount(owner[first], minlength=len(texts))


def measure(texts: pa.Array, path: str, second: str) -> dict[str, np.ndarray]:
    """All counts and fertility numbers of a piece of texts, and the standard errors (`_err`) of the numbers."""
    texts = arrays.whole(texts)
    words = arrays.split(texts)
    raw, ends = arrays.bytes_of(texts)
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    model, is_byte = _model(path)
    names = words.vocab.to_pylist()
    pieces = model.encode(names, num_threads=1) if names else []
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = np.fromiter((i for p in pieces for i in p), np.int64, int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    bytes_in = arrays.sums(is_byte[flat].astype(np.int64), np.append(starts, len(flat)))

    n_tokens = words.total(lengths)
    tokens = flat[arrays.gather(starts[words.ids], lengths[words.ids])]
    owner = np.repeat(np.arange(len(texts)), n_tokens)
    pairs, count = np.unique(owner * len(is_byte) + tokens, return_counts=True)
    of = pairs // len(is_byte)
    surprise = np.bincount(of, count * np.log2(count), len(texts))
    most = np.maximum(n_tokens, 2)
    chars = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    again = _encoder(second)(words.vocab)[1]
    one = np.ones(len(names), np.int64)
    ratios = {
        "chars_per_token": (chars, lengths), "byte_share": (bytes_in, lengths), "pieces_per_word": (lengths, one),
        "second_chars_per_token": (chars, again), "second_pieces_per_word": (again, one)}
    numbers = {"entropy": (np.log2(most) - surprise / most) / np.log2(most), "entropy_err": np.zeros(len(texts))}
    for name, (top, bottom) in ratios.items():
        numbers[name], numbers[f"{name}_err"] = ratio(words, top, bottom)
    return {
        "n_words": words.counts, "word_chars": words.total(chars),
        "n_symbols": arrays.sums(marks[raw].astype(np.int64), ends),
        "n_dup_lines": repeated_lines(texts), "n_repeat_words": repeated_windows(words),
        "n_tokens": n_tokens} | numbers


def bands(numbers: DataFrame, lang_col: str, reach: float, least_tokens: int) -> DataFrame:
    """Quartiles of every number for each language, and the square of the stretch that is not sampling error."""
    def edges(name: str) -> list[Column]:
        quartiles = F.percentile_approx(name, [0.25, 0.75], 10_000)
        chance = QUARTILES * F.percentile_approx(f"{name}_err", 0.5, 10_000)
        beyond = F.pow(quartiles[1] - quartiles[0], F.lit(2)) - F.pow(chance, F.lit(2))
        wide = reach ** 2 * F.greatest(F.lit(0.0), beyond)
        return [quartiles[0].alias(f"{name}_low"), quartiles[1].alias(f"{name}_high"), wide.alias(f"{name}_wide")]

    long_enough = numbers.where(F.col("n_tokens") >= least_tokens)
    return long_enough.groupBy(lang_col).agg(*[e for name in FLOORS for e in edges(name)])


def _judged(docs: DataFrame, keep: tuple[str, ...], text_col: str, lang_col: str, path: str, second: str, reach: float,
            least_tokens: int, least_words: int) -> DataFrame:
    """`row` (a struct of the columns to keep) with counts, fertility numbers, `base_failed` and `kept`."""
    lang_kind = docs.schema[lang_col].dataType.simpleString()

    inside_row = text_col in keep  # then the text goes to the workers once

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("text", pc.struct_field(batch.column("row"), [keep.index(text_col)])) if inside_row else batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(texts(batches), "text", PIECE_BYTES):
            yield pa.RecordBatch.from_pydict(
                {"row": piece.column("row"), "lang": piece.column("lang")} | measure(piece.column("text"), path, second))

    text = [] if inside_row else [F.col(text_col).alias("text")]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(lang_col).alias("lang"), *text)
    fields = [f"row {rows.schema['row'].dataType.simpleString()}", f"lang {lang_kind}"]
    numbers = rows.mapInArrow(
        run, ", ".join([*fields, *[f"{c} long" for c in COUNTS], *[f"{m} double, {m}_err double" for m in FLOORS]]))
    numbers = written(numbers, "fertility")
    # a row for each language; written, its size is known and the texts need no shuffle
    edges = written(bands(numbers, "lang", reach, least_tokens).withColumnRenamed("lang", "band"), "bands")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.lit(True)
    for name, floor in FLOORS.items():
        chance = reach * QUARTILES * F.col(f"{name}_err")
        wide = F.greatest(F.lit(floor), F.sqrt(F.col(f"{name}_wide") + chance * chance))
        inside &= F.col(name).between(F.col(f"{name}_low") - wide, F.col(f"{name}_high") + wide)
    short = F.col("n_tokens") < least_tokens
    return numbers.join(edges, F.col("lang").eqNullSafe(F.col("band")), "left").select(
        "row", "lang", *COUNTS, *MEASURES, failed.alias("base_failed"),
        (~failed & (short | F.coalesce(inside, F.lit(True)))).alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          vocabulary: str | None = None, reach: float = 2.5, least_tokens: int = 50,
          least_words: int = 50, second: str | None = None) -> DataFrame:
    """Counts, fertility numbers, `base_failed` and `kept` of every row."""
    path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    second = second or public_tokenizers.path("word_bpe_49k.json")
    out = _judged(docs, (id_col,), text_col, lang_col, path, second, reach, least_tokens, least_words)
    return out.select(F.col("row")[id_col].alias(id_col), F.col("lang").alias(lang_col), *COUNTS, *MEASURES, "base_failed", "kept")


def kept_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", vocabulary: str | None = None,
              reach: float = 2.5, least_tokens: int = 50, least_words: int = 50, second: str | None = None) -> DataFrame:
    """The rows that pass, with their columns as they came."""
    path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    second = second or public_tokenizers.path("word_bpe_49k.json")
    out = _judged(docs, tuple(docs.columns), text_col, lang_col, path, second, reach, least_tokens, least_words)
    return out.where("kept").select("row.*")
