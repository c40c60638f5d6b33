"""Words looked up in the row: a vocabulary and its class weights go to the tasks, no row leaves its task.

Both are small by construction: a vocabulary has at most the words that
`build_vocabulary` was asked for, and the weights have one row for each of those
and one column a label. They travel with the code; Arrow batches hold nothing but the
words of each row, so carried columns never pass through Python. One row comes out
for one row in, without an exchange, and equal rows stay apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Vocabulary:
    """Words and their numbers, in one order."""

    words: pa.Array
    numbers: np.ndarray

    def indices(self, flat: pa.Array, unk: int) -> np.ndarray:
        """The number of each word, spelled out against the vocabulary; `unk` for words outside it."""
        place = pc.index_in(flat, value_set=self.words)
        found = pc.fill_null(place, len(self.numbers)).to_numpy(zero_copy_only=False)
        return np.append(self.numbers, np.int32(unk))[found]


def _lists(rows: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Items of all lists in a row, where each list begins and ends, and which lists are null."""
    lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return rows.flatten(), np.concatenate([[0], np.cumsum(lengths)]), rows.is_null()


def load_vocabulary(vocabulary: DataFrame) -> Vocabulary:
    table = vocabulary.select("token", F.col("idx").cast("int").alias("idx")).toArrow()
    words = table.column("token").combine_chunks()
    return Vocabulary(words.cast(pa.string()), table.column("idx").to_numpy().astype(np.int32))


def word_indices(words: Column, vocabulary: DataFrame, unk: int) -> Column:
    """Lists of words as lists of vocabulary numbers; null stays null."""
    known = load_vocabulary(vocabulary)

    @F.arrow_udf("array<int>")
    def look_up(rows: pa.Array) -> pa.Array:
        flat, offsets, nulls = _lists(rows)
        found = pa.array(known.indices(flat.cast(pa.string()), unk), pa.int32())
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, mask=nulls)

    return look_up(words)


def weight_sums(indices: Column, numbers: np.ndarray, weights: np.ndarray) -> Column:
    """For each list of numbers how many it has, and the sum of their weights in each class.

    `numbers` are those that have weights, rising; others weigh 0. An empty or null list
    gives zeros.
    """
    table = np.vstack([weights, np.zeros((1, weights.shape[1]))])

    @F.arrow_udf("array<double>")
    def add_up(rows: pa.Array) -> pa.Array:
        flat, offsets, _ = _lists(rows)
        items = flat.to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(numbers, items), max(len(numbers) - 1, 0))
        hit = numbers[place] == items if len(numbers) else np.zeros(len(items), bool)
        each = table[np.where(hit, place, len(numbers))]
        out = np.zeros((len(rows), weights.shape[1] + 1))
        out[:, 0] = np.diff(offsets)
        filled = np.flatnonzero(out[:, 0])
        if len(filled):
            out[filled, 1:] = np.add.reduceat(each, offsets[filled], axis=0)
        ends = np.arange(len(rows) + 1) * out.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out.ravel()))

    return add_up(indices)
