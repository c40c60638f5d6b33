r"""Hashes of word shingles: `width` consecutive words `[^\x20\x09-\x0D]+`, A-Z lower-cased.

A text with fewer words is one shingle; one without words, or a null, has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlens.llm import arrays

_GOLD = 0x9E3779B97F4A7C15


class Shingled:
    """Hashes of the shingles of all texts in a row, with the words to spell them."""

    def __init__(self, texts: pa.Array, width: int):
        self.words = arrays.split(pc.ascii_lower(arrays.whole(texts)))
        self.width = width
        counts, ids = self.words.counts, self.words.ids
        hashes = word_hashes(self.words.vocab)[ids]
        sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.first = arrays.gather(self.words.offsets[:-1], sizes)
        padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        left = self.words.offsets[1:][owner] - self.first
        out = np.zeros(len(self.first), np.uint64)
        for k in range(width):
            out = np.where(left > k, out * np.uint64(_GOLD) + padded[self.first + k], out)
        self.hashes = arrays.mixed(out)
        self.owner = owner

    def text(self, place: int) -> str:
        """The shingle at a place, its words joined by spaces."""
        begin = int(self.first[place])
        end = min(begin + self.width, int(self.words.offsets[self.owner[place] + 1]))
        return " ".join(self.words.vocab[int(i)].as_py() for i in self.words.ids[begin:end])


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """A 64-bit polynomial of each word's bytes."""
    raw, ends = arrays.bytes_of(vocab)
    sizes = np.diff(ends)
    out = np.zeros(len(sizes), np.uint64)
    order = np.argsort(-sizes, kind="stable")
    sorted_sizes = -sizes[order]
    for k in range(int(sizes.max()) if len(sizes) else 0):
        live = order[:np.searchsorted(sorted_sizes, -k, "left")]
        out[live] = out[live] * np.uint64(_GOLD) + raw[ends[live] + k] + np.uint64(1)
    return arrays.mixed(out)
