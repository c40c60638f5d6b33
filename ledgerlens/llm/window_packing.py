"""Documents packed into windows of a fixed number of tokens by best-fit decreasing.

Each document is its token ids and an end id. A document longer than a window is first
cut into full windows; those are sequences as they are. What is left of each document,
shorter than a window, stays whole and goes, longest first, into the open window with the
least room that holds it. A segment tree over the remaining capacities finds that window
in logarithmic time; a window is opened only when none fits.

Best-fit decreasing depends on the pieces' lengths alone, so the plan is made for counts:
the driver gets one number for each length below the window (a bounded table), and the
tree's leaves hold classes of windows with equal content. A class takes as many pieces of
a length as it has room for at once, which is where pieces of equal length would go one by
one. The result is a list of runs: pieces of one length, from rank a to b, lie in windows
from s on, q in each, at an offset. Its size depends on the window only (the runs of a
window of 1024 are some thousands). Ranks of pieces of a length are counted in the tasks that encode,
and a table of one row for each task and length carries what came before. So the packing
is that of all documents at once, and neither a task nor the driver holds them.

Sequences are rows (sequence_id, n_tokens, padded, id_bytes, ids, pieces). Every one is
padded to the window, except those whose length is a power of two, which stay as they are:
`padded` is the length with padding, which `ids` does not hold. Ids are little-endian
unsigned integers of `id_bytes` bytes.

Texts are encoded by the library once for each distinct unit of a task: a unit begins at
a space that has something else than white space before or after it, where the vocabulary's
own splitting always cuts. Null texts count as empty and have the end id. Null and repeated
ids and repeated rows are kept, each with pieces of its own. An empty table gives no
sequences. Only the two named columns are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import arrays
from ledgerlens.operators.sizing import written

_CACHED = 400_000
_LONGEST_CACHED = 64
_PIECE_BYTES = 4 << 20
#: Signs that form a part of their own at the end of a unit, after a letter or a number.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: White space as the vocabulary's splitting pattern knows it (fixed values of Unicode).
_SPACE = "\t-\r \x85\xa0  -     　"
#: A space inside or at the end of a run of white space: no unit begins there.
_INNER = re.compile(f"(?<=[{_SPACE}]) (?=[{_SPACE}]|\\Z)")
#: Texts that may have one, for a search in bulk.
_HAS_INNER = r"[\s\v\x{85}\p{Z}] ([\s\v\x{85}\p{Z}]|\z)"
_MARK = "\x01"
#: Lines without white space: each line feed between them is a part of its own.
_LINES = re.compile(f"[^{_SPACE}{_MARK}]+(\n[^{_SPACE}{_MARK}]+)+\\Z")


def _byte_letters() -> dict[int, int]:
    """Bytes as letters of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD]
    return {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(printable)))}


class UnitEncoder:
    """Ids of texts under a byte-level BPE tokenizer whose words keep the space before them.

    A unit of letters is one part for the vocabulary's splitting, so it goes straight to
    the library's BPE model, and so do the signs after it and a line feed between two such
    units; any other unit goes through the
    library's whole pipeline, and so do whole texts with a special token or the mark in them.
    Units met lately are kept: the old half goes when the new one is full, and what is
    used of it comes over.
    """

    def __init__(self, path: str, width: int):
        self.kind = {2: "H", 4: "I"}[width]
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = chr(self.letters[ord(" ")])
        self.whole = [_MARK, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.line = self._library("\n")

    def _library(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, space: str, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array(self.kind, [t.id for t in self.model.tokenize(space + letters)]).tobytes()

    def _keep(self, unit: str, ids: bytes) -> bytes:
        if len(unit) <= _LONGEST_CACHED:
            if len(self.new) >= _CACHED:
                self.old, self.new = self.new, {}
            self.new[unit] = ids
        return ids

    def _after_space(self, unit: str) -> bytes:
        """Ids of a unit and the space before it."""
        for found in (self.new.get(unit), self.old.get(unit)):
            if found is not None:
                return self._keep(unit, found)
        stem = unit.rstrip(_SIGNS)
        if stem.isalpha():
            return self._keep(unit, self._part(self.space, unit) if stem == unit else self._after_space(stem) + self._after_word(unit[len(stem):]))
        if _LINES.match(unit):
            first, *lines = unit.split("\n")
            return self.line.join([self._after_space(first), *map(self._bare, lines)])
        return self._keep(unit, self._library(" " + unit.replace(_MARK, " ")))

    def _after_word(self, signs: str) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            ids = self._part("", signs)
            if len(self.signs) < _CACHED and len(signs) <= _LONGEST_CACHED:
                self.signs[signs] = ids
        return ids

    def _bare(self, unit: str) -> bytes:
        """Ids of a unit without a space before it."""
        stem = unit.rstrip(_SIGNS)
        if not stem.isalpha():
            return self._library(unit.replace(_MARK, " "))
        ids = self._part("", stem)
        return ids if stem == unit else ids + self._after_word(unit[len(stem):])

    def _text(self, text: str) -> bytes:
        units = text.split(" ")
        found = list(map(self.new.get, units))
        found[0] = self._bare(units[0])
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._after_space(units[k])
        return b"".join(found)

    def __call__(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Ids of each text, with `end_id` after them."""
        texts = arrays.whole(texts)
        alone = pc.match_substring(texts, self.whole[0])
        for content in self.whole[1:]:
            alone = pc.or_(alone, pc.match_substring(texts, content))
        inner = pc.match_substring_regex(texts, _HAS_INNER)
        end = array(self.kind, [end_id]).tobytes()
        out = []
        for text, as_is, spaces in zip(texts.to_pylist(), alone.to_pylist(), inner.to_pylist()):
            out.append((self._library(text) if as_is else self._text(_INNER.sub(_MARK, text) if spaces else text)) + end)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, width: int) -> UnitEncoder:
    return UnitEncoder(path, width)


def encode(texts: pa.Array, path: str, end_id: int, width: int = 4) -> list[bytes]:
    """Ids of each text with `end_id` after them, little-endian, `width` bytes an id."""
    return _encoder(path, width)(texts, end_id)


class CapacityTree:
    """A segment tree over capacities: which is the least one, at least some size, that a window has?"""

    def __init__(self, most: int):
        self.width = 1 << (most + 1).bit_length()
        self.open = np.zeros(2 * self.width, bool)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.width
        self.open[node] = is_open
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """Up to the first subtree on the right that has an open leaf, then down to its leftmost one."""
        node = size + self.width
        if self.open[node]:
            return size
        while node > 1 and not (node % 2 == 0 and self.open[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.width:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.width


@dataclass(frozen=True)
class Run:
    """Pieces of one length from `rank` on, `pieces` in number: `each` in a window from `sequence` on, from `offset` on."""
    length: int
    rank: int
    pieces: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], window: int) -> tuple[list[Run], int]:
    """Best-fit decreasing for so many pieces of each length: where they lie, and the number of windows.

    Equal to placing the pieces one by one: a window that took a piece is tighter than
    before, so it takes the next one of the same length while it can.
    """
    tree = CapacityTree(window)
    classes: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]  # by room left: (first window, windows)
    runs, opened = [], 0

    def put(room: int, first: int, windows: int) -> None:
        if windows and room:
            classes[room].append((first, windows))
            tree.mark(room, True)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, windows = window, opened, -(-left // (window // length))
                opened += windows
            else:
                first, windows = classes[room].pop()
                if not classes[room]:
                    tree.mark(room, False)
            each = room // length
            taken = min(left, each * windows)
            runs.append(Run(length, rank, taken, each, first, window - room))
            full, rest = divmod(taken, each)
            put(room - each * length, first, full)
            put(room - rest * length, first + full, 1 if rest else 0)
            put(room, first + full + bool(rest), windows - full - bool(rest))
            left, rank = left - taken, rank + taken
    return runs, opened


def _cut(docs: DataFrame, path: str, end_id: int, window: int, width: int) -> DataFrame:
    """Pieces of all documents: full windows, and what is left; `nth` counts those of a length in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for piece in arrays.pieces(batches, "text", _PIECE_BYTES):
            encoded = encode(piece.column("text"), path, end_id, width)
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // width
            parts = -(-sizes // window)
            owner = np.repeat(np.arange(len(sizes)), parts)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            length = np.minimum(sizes[owner] - start, window)
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            heads = np.searchsorted(ranked, ranked)
            nth = np.empty(len(owner), np.int64)
            nth[order] = np.arange(len(owner)) - heads + seen[ranked]
            seen += np.bincount(length, minlength=window + 1)
            # pieces of a document lie side by side, and so do documents, so the pieces' ids are the ids in a row
            upto = np.concatenate([[0], np.cumsum(length)]) * width
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id").take(pa.array(owner)), "start": pa.array(start),
                "length": pa.array(length.astype(np.int32)), "doc_tokens": pa.array(sizes[owner]),
                "task": pa.array(np.full(len(owner), task, np.int32)), "nth": pa.array(nth),
                "ids": pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(b"".join(encoded))])})
    return docs.mapInArrow(run, "doc_id long, start long, length int, doc_tokens long, task int, nth long, ids binary")


def _runs_table(docs: DataFrame, runs: list[Run]) -> DataFrame:
    """The plan as rows of one length: its runs in order of rank, for a search in the row."""
    by_length: dict[int, list[tuple]] = {}
    for r in runs:
        by_length.setdefault(r.length, []).append((r.rank, r.each, r.sequence, r.offset))
    return docs.sparkSession.createDataFrame(
        [(n, found) for n, found in by_length.items()],
        "length int, runs array<struct<first:long,each:long,sequence:long,offset:int>>")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         end_id: int = 0, window: int = 1024) -> DataFrame:
    """Sequences: sequence_id, n_tokens, padded, ids, pieces (offset, doc_id, start, length, doc_tokens)."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    width = 2 if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else 4
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(_cut(docs, path, end_id, window, width), "pieces")

    counts = written(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("task")
    counts = written(counts.select("task", "length", "n", (F.sum("n").over(before) - F.col("n")).alias("shift")), "shifts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = totals.pop(window, 0)
    runs, windows = plan(totals, window)

    shifts = counts.select(F.col("task").alias("_task"), F.col("length").alias("_length"), "shift")
    ranked = pieces.join(shifts, (pieces["task"] == shifts["_task"]) & (pieces["length"] == shifts["_length"])).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("nth") + F.col("shift")).alias("rank"))
    piece = F.struct("offset", "doc_id", "start", "length", "doc_tokens", "ids").alias("piece")

    whole = ranked.where(F.col("length") == window).withColumn("offset", F.lit(0)).select(
        (F.col("rank") + windows).alias("sequence_id"), F.array(piece).alias("pieces"))
    placed = ranked.where(F.col("length") < window).join(_runs_table(docs, runs), "length")
    run = F.expr("runs[cast(aggregate(runs, -1, (n, r) -> if(r.first <= rank, n + 1, n)) as int)]")
    placed = placed.select(
        "doc_id", "start", "length", "doc_tokens", "ids", "rank", run.alias("run")).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        F.expr("run.sequence + (rank - run.first) div run.each").alias("sequence_id"),
        F.expr("cast(run.offset + (rank - run.first) % run.each * length as int)").alias("offset"))
    packed = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))

    wide = whole.unionByName(packed)
    n = F.aggregate("pieces", F.lit(0), lambda s, p: s + p["length"])
    ids = F.expr("aggregate(pieces, X'', (s, p) -> concat(s, p.ids))")
    fields = ("offset", "doc_id", "start", "length", "doc_tokens")
    kept = F.transform("pieces", lambda p: F.struct(*[p[c].alias(c) for c in fields]))
    rows = wide.select("sequence_id", n.alias("n_tokens"), ids.alias("ids"), kept.alias("pieces"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return rows.select("sequence_id", "n_tokens", F.when(power, F.col("n_tokens")).otherwise(window).alias("padded"),
                       F.lit(width).alias("id_bytes"), "ids", "pieces")


def read_pieces(sequences: DataFrame) -> DataFrame:
    """One row a piece: its place in document and sequence, and its ids (little-endian unsigned 32-bit) as the sequence holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            pieces = lists.flatten()
            owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            if not len(owner):
                continue
            width = batch.column("id_bytes")[0].as_py()
            raw, upto = arrays.bytes_of(batch.column("ids"))
            ids = np.ascontiguousarray(raw).view(f"<u{width}").astype("<u4")
            offset, length = (pieces.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("offset", "length"))
            places = np.concatenate([[0], np.cumsum(length)])
            own = ids[arrays.gather(upto[owner] // width + offset, length)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pieces.field("doc_id"), "start": pieces.field("start"), "length": pa.array(length),
                "doc_tokens": pieces.field("doc_tokens"), "sequence_id": batch.column("sequence_id").take(pa.array(owner)),
                "offset": pa.array(offset),
                "ids": pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer((places * 4).astype(np.int32)), pa.py_buffer(own)])})
    return sequences.select("sequence_id", "id_bytes", "ids", "pieces").mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
