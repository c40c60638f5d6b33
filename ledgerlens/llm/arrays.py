"""Words of text batches as NumPy arrays, and ragged gathers over them.

Operators that run in tasks on Arrow batches share these: a batch is cut into
pieces of bounded size, its words become indexes into the piece's own vocabulary,
work is done once for each word of that vocabulary, and results are gathered back
to the documents.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 4 << 20


def give_back() -> None:
    """Return freed memory to the system, where the C library can: idle workers stay beside the JVM that started them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, begin = np.cumsum(sizes, dtype=np.int64), 0
        while begin < batch.num_rows:
            before = int(upto[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
        give_back()


def whole(texts: pa.Array) -> pa.Array:
    """The texts with empty ones for nulls."""
    return pc.fill_null(texts, "")


@dataclass
class Words:
    """Words of all texts in a row: `ids` index `vocab`, text i has ids[offsets[i]:offsets[i + 1]]."""
    ids: np.ndarray
    offsets: np.ndarray
    vocab: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def total(self, of_word: np.ndarray) -> np.ndarray:
        """Sum over each text of a number that each word of the vocabulary has."""
        return sums(of_word[self.ids], self.offsets)


def split(texts: pa.Array) -> Words:
    r"""Words `[^\x20\x09-\x0D]+`; empty strings between separators do not count."""
    lists = pc.ascii_split_whitespace(whole(texts))
    coded = lists.flatten().dictionary_encode()
    ids, vocab = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    blank = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
    if blank >= 0:
        keep = ids != blank
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        ids = ids[keep]
    return Words(ids, offsets, vocab)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for each i."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    upto = np.concatenate([np.zeros(1, kind), np.cumsum(values, dtype=kind)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], ..., starts[i] + lengths[i] - 1 for each i, in a row."""
    upto = np.cumsum(lengths)
    total = int(upto[-1]) if len(upto) else 0
    return np.repeat(starts - (upto - lengths), lengths) + np.arange(total)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts in a row, and where each text begins and ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, different for different x."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
