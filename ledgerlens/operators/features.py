"""Vocabulary and fixed-length encoding of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.config import FIRST_WORD_INDEX, PAD_INDEX, UNK_INDEX
from ledgerlens.functions.numbers import count_non_pad
from ledgerlens.functions.text import first_tokens, pad_right
from ledgerlens.operators.lookup import word_indices
from ledgerlens.operators.profile import token_frequency
from ledgerlens.operators.sizing import written


def build_vocabulary(df: DataFrame, max_size: int, min_freq: int, column: str = "description") -> DataFrame:
    """(token, idx): the most frequent words, numbered from 2, ties by word.

    Words are counted with a partial aggregate and cut by a top-k sort, so the
    numbering window sees at most `max_size` rows.
    """
    kept = (
        token_frequency(df, column)
        .where(F.col("n") >= min_freq)
        .orderBy(F.desc("n"), "token")
        .limit(max_size)
    )
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return written(kept.select("token", (rank + (FIRST_WORD_INDEX - 1)).alias("idx")))


def with_special_tokens(vocabulary: DataFrame, pad: int = PAD_INDEX, unk: int = UNK_INDEX) -> DataFrame:
    """The vocabulary with its padding and unknown-word entries."""
    spark = vocabulary.sparkSession
    extra = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit("<PAD>").alias("token"), F.lit(pad).alias("idx")),
        F.struct(F.lit("<UNK>").alias("token"), F.lit(unk).alias("idx")),
    )).alias("x")).select("x.*")
    return extra.unionByName(vocabulary)


def text_indices(vocabulary: DataFrame, length: int, column: str = "description", unk: int = UNK_INDEX) -> Column:
    """The vocabulary numbers of the first `length` words of a text; looked up in the row, see `operators.lookup`."""
    return word_indices(first_tokens(F.col(column), length), vocabulary, unk)


def token_indices(df: DataFrame, vocabulary: DataFrame, row_id: str, length: int,
                  column: str = "description", carry: Sequence[str] = (), unk: int = UNK_INDEX) -> DataFrame:
    """One row per word position below `length` with its vocabulary number, `unk` for words outside it.

    An empty text keeps one row with nulls.
    """
    return df.select(row_id, *carry, F.posexplode_outer(text_indices(vocabulary, length, column, unk)).alias("pos", "idx"))


def sequence_words(pad: int = PAD_INDEX) -> Column:
    """The word numbers of an encoded sequence."""
    return F.filter("seq", lambda x: x != pad)


def encode_texts(df: DataFrame, vocabulary: DataFrame, row_id: str, length: int,
                 column: str = "description", carry: Sequence[str] = (),
                 pad: int = PAD_INDEX, unk: int = UNK_INDEX) -> DataFrame:
    """(row_id, carry…, seq): every text as exactly `length` word numbers, row for row."""
    found = F.coalesce(text_indices(vocabulary, length, column, unk), F.array().cast("array<int>"))
    return df.select(row_id, *carry, pad_right(found, length, pad).alias("seq"))


def _wide(column: str) -> Column:
    """A sum of longs whose products fit."""
    return F.sum(column).cast("decimal(19,0)")


def feature_baseline(features: DataFrame, pad: int = PAD_INDEX) -> DataFrame:
    """One row: mean and population deviation of the text lengths in words, rows per label."""
    grouped = features.groupBy("label_idx", count_non_pad(F.col("seq"), pad).alias("len")).agg(F.count("*").alias("n"))
    by_label = grouped.groupBy("label_idx").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("len")).alias("s1"),
        F.sum(F.col("n") * F.col("len") * F.col("len")).alias("s2"),
    )
    mean = F.sum("s1") / F.sum("n")
    return by_label.agg(
        mean.alias("seq_nonzero_mean"),
        # integer sums make the variance exact up to the last division
        (F.sqrt((_wide("n") * _wide("s2") - _wide("s1") * _wide("s1")).cast("double")) / F.sum("n")).alias("seq_nonzero_std"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("label_idx").cast("string"), "n")))).alias("label_distribution"),
    )


def label_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy("label_idx").agg(F.count("*").alias("n"))
