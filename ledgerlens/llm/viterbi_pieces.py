"""SentencePiece encoding and decoding by a batched Viterbi search in NumPy.

Words of one length form a matrix of code points and advance together. At each end
position the hashes of all substrings that end there are probed in the sorted
hashes of the pieces; the best last piece and its length are stored as backpointers
for all words at once. A character that no piece covers is spelled in byte pieces.

Two kinds of model differ in what a path may do:

* `merges` (the default): scores are merge ranks. A piece may follow another only
  if no merge across their border would have come before theirs; under that rule
  every prefix of a word has exactly one path, and it is the one that merging finds.
  `fits` checks the rule for all words at once by undoing the later of the two
  last merges until single characters meet.
* `unigram`: scores are log probabilities and the best sum wins; of equal sums,
  the longest last piece. An uncovered character costs the lowest score less ten.

A text is cut before each run of spaces, which no piece crosses, so each distinct
word is searched once for a piece of text. Words that begin with two spaces or more
are rare, and their pieces have tied ranks: the library encodes those. Decoding
joins the pieces' bytes and drops the space that encoding put in front; a text
without U+2581 comes back exactly.

Null texts count as empty and have no ids. Repeated rows are kept. All columns of
the input stay; one of the new column's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from ledgerlens.llm import arrays

SPACE = "▁"
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_TABLE_BITS = 21
_STEP = 4096
_PIECE_BYTES = 8 << 20


class Pieces:
    """The pieces of a model in the forms that search and decoding need."""

    def __init__(self, path: str, kind: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = kind
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (
            model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        names = {i: model.id_to_piece(i) for i in plain}
        spelled = [names[i].replace(SPACE, " ").encode() if i in names else b"" for i in range(size)]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        for b, i in enumerate(self.byte_ids):
            spelled[i] = bytes([b])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.fromiter(map(len, spelled), np.int64, size)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

        # Runs of spaces are left to the library. Characters come first, then pieces in the order of merging.
        names = {i: n for i, n in names.items() if n == SPACE or set(n) != {SPACE}}
        order = sorted(names, key=lambda i: (len(names[i]) > 1, -model.get_score(i)))
        texts = [names[i] for i in order]
        rank = np.array([i if len(t) > 1 else -1 for i, t in enumerate(texts)])
        scores = np.array([model.get_score(i) for i in order])
        left, right = self._splits(texts, rank) if kind == "merges" else (rank, rank)
        self.longest = max(map(len, texts))
        self.powers = np.array([pow(_BASE, k, 1 << 64) for k in range(self.longest + 1)], np.uint64)

        keys = np.array([self._key(t) for t in texts], np.uint64)
        by_key = np.argsort(keys)
        usable = left[by_key] != -2
        self.keys, self.at = keys[by_key][usable], by_key[usable]
        self.likely = self._table(self.keys)
        none = len(texts)  # stands for any character without a piece
        self.ids = np.append(order, -1)
        self.rank, self.left, self.right = (np.append(x, -1) for x in (rank, left, right))
        self.scores, self.unknown_score = scores, scores.min() - 10
        self.none = none
        pairs = np.flatnonzero(left >= 0) if kind == "merges" else np.zeros(0, np.int64)
        codes = (left[pairs] * (none + 1) + right[pairs]).astype(np.uint64)
        by_code = np.argsort(codes)
        self.codes, self.merged = codes[by_code], pairs[by_code]
        self.likely_code = self._table(self.codes)

    @staticmethod
    def _splits(texts: list[str], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last merge of each piece; -1 for characters, -2 for pieces that merging never makes."""
        where = {t: i for i, t in enumerate(texts)}
        left, right = np.full(len(texts), -1), np.full(len(texts), -1)
        for i, text in enumerate(texts):
            parts = list(text)
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda k: where.get(parts[k] + parts[k + 1], len(texts)))
                if where.get(parts[best] + parts[best + 1], len(texts)) >= i:
                    break
                parts[best:best + 2] = [parts[best] + parts[best + 1]]
            if len(parts) == 2:
                left[i], right[i] = (where.get(x, -2) for x in parts)
            if len(parts) > 2 or min(left[i], right[i]) == -2:
                left[i] = right[i] = -2
        return left, right

    @staticmethod
    def _key(name: str) -> int:
        h = 0
        for c in name:
            h = (h * _BASE + ord(c) + 1) & _MASK
        return h

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (arrays.mixed(keys) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def _table(self, keys: np.ndarray) -> np.ndarray:
        """Marks for keys that may be there, to probe only those."""
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[self._slot(keys)] = True
        return table

    def _find(self, keys: np.ndarray, likely: np.ndarray, ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1)
        some = np.flatnonzero(likely[self._slot(keys)])
        if len(some) and len(ordered):
            at = np.minimum(np.searchsorted(ordered, keys[some]), len(ordered) - 1)
            out[some] = np.where(ordered[at] == keys[some], values[at], -1)
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each substring hash, or -1."""
        return self._find(keys, self.likely, self.keys, self.at)

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging would leave a border between pieces a and b."""
        good, rows = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), len(self.ids))
        while len(rows):
            across = self._find((a * (self.none + 1) + b).astype(np.uint64), self.likely_code, self.codes, self.merged)
            bad = (across >= 0) & (across < limit)
            good[rows[bad]] = False
            first, second = self.rank[a], self.rank[b]
            go = ~bad & ((first >= 0) | (second >= 0))
            rows, a, b, first, second = rows[go], a[go], b[go], first[go], second[go]
            undo_a = first > second
            limit = np.where(undo_a, first, second + 1)  # at equal rank the left merge comes first
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def advance(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last piece and its length for each end position (a row) and word (a column)."""
        n, length = codes.shape
        hashes = np.zeros((length + 1, n), np.uint64)
        for e in range(length):
            hashes[e + 1] = hashes[e] * np.uint64(_BASE) + codes[:, e].astype(np.uint64) + np.uint64(1)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        last = np.full((length + 1, n), self.none)
        step = np.ones((length + 1, n), np.int64)
        for e in range(1, length + 1):
            for m in range(min(e, self.longest), 0, -1):
                at = self.find(hashes[e] - hashes[e - m] * self.powers[m])
                if self.kind == "unigram":
                    score = np.where(at >= 0, self.scores[at], self.unknown_score if m == 1 else -np.inf) + best[e - m]
                else:  # the first that fits is the only one
                    score = np.full(n, -np.inf)
                    open_ = np.flatnonzero((at >= 0) & (best[e] < 0))
                    score[open_[self.fits(last[e - m][open_], at[open_])] if m < e else open_] = 0
                    score[(at < 0) & (m == 1)] = 0
                better = score > best[e]
                best[e] = np.where(better, score, best[e])
                last[e] = np.where(better, np.where(at >= 0, at, self.none), last[e])
                step[e] = np.where(better, m, step[e])
        return last, step

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, and where each word's ids begin and how many they are. A word begins with U+2581."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        flat, total = [], 0
        spaced = [i for i, w in enumerate(words) if w.startswith(SPACE * 2) or w == SPACE]
        for i in spaced:
            ids = self.model.encode(words[i][1:].replace(SPACE, " ")) or [self.model.piece_to_id(SPACE)]
            starts[i], lengths[i] = total, len(ids)
            flat.append(np.array(ids, np.int64))
            total += len(ids)
        sizes[spaced] = 0
        order = np.argsort(sizes, kind="stable")[len(spaced):]
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
            length = int(sizes[group[0]])
            rows = max(1, _STEP * 16 // max(16, length))
            for a in range(0, len(group), rows):
                members = group[a:a + rows]
                text = "".join([words[i] for i in members])
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(members), length)
                ids, counts = self._walk_back(codes)
                lengths[members] = counts
                starts[members] = total + np.cumsum(counts) - counts
                flat.append(ids)
                total += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.int64), starts, lengths

    def _walk_back(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of one length in a row, and how many each has."""
        n, length = codes.shape
        last, step = self.advance(codes)
        rows, at = np.arange(n), np.full(n, length)
        out, begin = np.full((n, length), self.none), np.full((n, length), -1)
        for k in range(length - 1, -1, -1):
            if not len(rows):
                break
            out[rows, k] = last[at, rows]
            at = at - step[at, rows]
            begin[rows, k] = at
            rows, at = rows[at > 0], at[at > 0]
        used = begin >= 0
        counts, places = used.sum(1), out[used]
        ids = self.ids[places]
        blank = np.flatnonzero(places == self.none)
        if len(blank):
            owner = np.repeat(np.arange(n), counts)
            first = begin[used]
            spelled = [chr(codes[owner[i], first[i]]).encode("utf-8", "surrogatepass") for i in blank]
            extra = np.fromiter(map(len, spelled), np.int64, len(blank))
            width = np.ones(len(ids), np.int64)
            width[blank] = extra
            ids = np.repeat(ids, width)
            ids[np.repeat(places == self.none, width)] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
            counts = counts + np.bincount(owner[blank], extra - 1, n).astype(np.int64)
        return ids, counts


@lru_cache(maxsize=2)
def pieces_of(path: str, kind: str = "merges") -> Pieces:
    return Pieces(path, kind)


def _segments(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words with the space before them, the words of all texts, and where each text begins and ends."""
    odd = pc.or_(pc.match_substring_regex(texts, "  |^ | $"), pc.match_substring(texts, SPACE))
    simple = pc.if_else(odd, "", texts)
    lists = pc.split_pattern(simple, " ")
    coded = lists.flatten().dictionary_encode()
    words = [SPACE + w for w in coded.dictionary.to_pylist()]
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    counts = np.diff(offsets)
    empty = pc.equal(simple, "").to_numpy(zero_copy_only=False)
    if empty.any():
        known: dict[str, int] = {}
        extra: dict[int, list[int]] = {}
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            text = SPACE + texts[int(i)].as_py().replace(" ", SPACE)
            extra[i] = [known.setdefault(w, len(known) + len(words))
                        for w in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", text)]
        parts = np.split(ids, offsets[1:-1])
        for i in np.flatnonzero(empty):
            parts[i] = np.array(extra.get(i, []), np.int64)
        words += list(known)
        ids, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    return words, ids, np.concatenate([[0], np.cumsum(counts)])


def encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text begins and ends."""
    texts = arrays.whole(texts)
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    words, ids, offsets = _segments(texts)
    flat, starts, lengths = pieces_of(path).search(words)
    out = flat[arrays.gather(starts[ids], lengths[ids])]
    return out, np.concatenate([[0], np.cumsum(arrays.sums(lengths[ids], offsets))])


def decode_batch(ids: np.ndarray, offsets: np.ndarray, path: str) -> list[str]:
    """The texts of the ids."""
    p = pieces_of(path)
    lengths = p.spelled_length[ids]
    raw = p.spelled[arrays.gather(p.spelled_start[ids], lengths)].tobytes()
    ends = np.concatenate([[0], np.cumsum(arrays.sums(lengths, offsets))]).tolist()
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        text = raw[a:b].decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def _as_bytes(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = memoryview(ids.astype("<u4").tobytes())
    return pa.array([raw[4 * a:4 * b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary())


def _with_columns(docs: DataFrame, new: dict[str, str], column: str, fill) -> DataFrame:
    """The rows with new columns made of one column, in one pass."""
    kept = [f for f in docs.schema if f.name.lower() not in new or f.name == column]
    names = [f.name for f in kept if f.name not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, column, _PIECE_BYTES):
            columns = [piece.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, *fill(piece.column(column))], [*names, *new])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept if f.name not in new]
    fields += [f"{name} {kind}" for name, kind in new.items()]
    return docs.select([f.name for f in kept]).mapInArrow(run, ", ".join(fields))


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The rows with `ids`, the ids as little-endian unsigned 32-bit integers in a binary."""
    return _with_columns(docs, {"ids": "binary"}, text_col, lambda texts: [_as_bytes(*encode_batch(texts, path))])


def decode(docs: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with `decoded`, the text that the ids spell."""
    def fill(ids: pa.Array) -> list[pa.Array]:
        raw = [x or b"" for x in ids.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw], dtype=np.int64)])
        return [pa.array(decode_batch(np.frombuffer(b"".join(raw), "<u4").astype(np.int64), offsets, path), pa.string())]
    return _with_columns(docs, {"decoded": "string"}, ids_col, fill)


def round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The rows with `ids` and with `decoded`, the text that the ids spell, in one pass."""
    def fill(texts: pa.Array) -> list[pa.Array]:
        ids, offsets = encode_batch(texts, path)
        return [_as_bytes(ids, offsets), pa.array(decode_batch(ids, offsets, path), pa.string())]
    return _with_columns(docs, {"ids": "binary", "decoded": "string"}, text_col, fill)
