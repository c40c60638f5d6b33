"""Token ids in binary files: each document compressed on its own with a shared dictionary.

A file holds frames in ascending id order, then an offset index and a footer:

    magic, bytes of an id, SHA-256 of the dictionary
    frame, frame, ...           one zstandard frame a document
    index                       24 bytes a document: id, offset, ids, 1 if the id is null
    offset of the index, documents, magic

The dictionary is trained on the serialised ids of a bounded sample (`sample`
documents, those whose ids have the smallest hashes). A short document costs one
read of its frame: the index tells where it lies.

Encoding splits a text at ASCII white space, which the tokenizer drops, and
encodes each distinct word once; `tests/llm` holds this against whole texts.

Null texts count as empty and still have the end id. Null ids come first. Repeated
rows are kept. An empty table gives no files and no rows. Only the two named
columns are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import arrays, store
from ledgerlens.operators.sizing import written
from ledgerlens.session import work_folder

MAGIC = b"TOKENS01"
_INDEX = np.dtype([("id", "<i8"), ("offset", "<u8"), ("count", "<u4"), ("null", "<u4")])
_FOOTER = "<QQ8s"
_FOOTER_SIZE = struct.calcsize(_FOOTER)
_CACHED = 300_000
_LONGEST_CACHED = 64
_PIECE_BYTES = 8 << 20
_PLAIN = "^[\\x21-\\x7eÀ-ÖØ-öø-ÿ]*$"
_PARTS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"


def _byte_letters() -> dict[int, int]:
    """Bytes as the letters of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of words under a lower-casing byte-level BPE tokenizer.

    Words met lately are looked up whole. New ones of ASCII and accented Latin letters are
    lower-cased and cut in bulk, and their parts go straight to the library's BPE model;
    any other word, and any that may hold a special token, goes through the library's whole
    pipeline. A cache holds `cached` words; when it is full, its older half goes.
    """

    def __init__(self, path: str, cached: int = _CACHED):
        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, part: str) -> bytes:
        if part.startswith("\x01"):
            ids = self.tokenizer.encode(part[1:], add_special_tokens=False).ids
        else:
            if not part.isascii():
                part = part.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(part)]
        return np.array(ids, "<u4").tobytes()

    def __call__(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        names = vocab.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, names))
        missing = []
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._kept(names[k], self.older.get(names[k]))
                if found[k] is None:
                    missing.append(k)
        if missing:
            ids, lengths = self._encoded(vocab.take(pa.array(missing)))
            raw, ends = ids.tobytes(), (np.cumsum(lengths) * 4).tolist()
            for k, a, b in zip(missing, [0, *ends], ends):
                found[k] = self._kept(names[k], raw[a:b])
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4"), lengths

    def _kept(self, word: str, ids: bytes | None) -> bytes | None:
        if ids is not None and len(word) <= _LONGEST_CACHED:
            if len(self.words) >= self.cached:
                self.older, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _encoded(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_(pc.match_substring_regex(vocab, _PLAIN), pc.invert(pc.match_substring(vocab, "<|")))
        parts = pc.replace_substring_regex(pc.utf8_lower(vocab), _PARTS, r"\1 ")
        parts = pc.if_else(plain, parts, pc.binary_join_element_wise("\x01", vocab, ""))
        cut = arrays.split(parts)
        names = cut.vocab.to_pylist()
        if len(self.known) > self.cached:
            self.known.clear()
        known = self.known
        found = [known.get(n) for n in names]
        for i, hit in enumerate(found):
            if hit is None:
                found[i] = known[names[i]] = self._ids(names[i]) if names[i] else b""
        flat = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        ids = flat[arrays.gather(starts[cut.ids], lengths[cut.ids])]
        return ids, arrays.sums(lengths[cut.ids], cut.offsets)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each with `end_id` after it, and where each text begins and ends."""
    words = arrays.split(texts)
    ids, lengths = _encoder(path)(words.vocab)
    starts = np.cumsum(lengths) - lengths
    body = ids[arrays.gather(starts[words.ids], lengths[words.ids])]
    counts = words.total(lengths)
    offsets = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(offsets[-1], end_id, "<u4")
    inside = np.ones(offsets[-1], bool)
    inside[offsets[1:] - 1] = False
    out[inside] = body
    return out, offsets


@dataclass(frozen=True)
class TokenStore:
    """Where the files lie, their order and the dictionary."""
    manifest: str
    dictionary: bytes
    width: int


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or, where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _zstd(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _serialised(docs: DataFrame, path: str, end_id: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text", _PIECE_BYTES):
            ids, offsets = encode(piece.column("text"), path, end_id)
            raw = ids.astype(f"<u{width}")
            yield pa.RecordBatch.from_pydict({
                "ids": pa.array([raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())})
    return docs.select("text").mapInArrow(run, "ids binary")


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = 1, sample: int = 1000,
                 dictionary_bytes: int = 64 << 10, level: int = 1) -> TokenStore:
    """Encode all texts and write them in ascending id order under `folder`."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    width = 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id) < 1 << 16 else 4
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    drawn = docs.select(F.xxhash64("id", F.lit(1)).alias("h"), "id").orderBy("h", "id").limit(sample).select("id").distinct()
    samples = _serialised(docs.join(F.broadcast(drawn), "id", "left_semi"), path, end_id, width).limit(2 * sample)
    dictionary = _dictionary([r["ids"] for r in samples.collect()], dictionary_bytes)
    name = hashlib.sha256(dictionary).digest()
    store.make_folder(folder)
    store.write(f"{folder}/{name.hex()}.dict", [dictionary])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level, dict_data=_zstd(dictionary), write_dict_id=False).compress
        part = TaskContext.get().partitionId()
        index, total, at = [], 0, len(MAGIC) + 1 + len(name)
        uri = store.fresh(folder, part, "tokens")

        def frames() -> Iterator[bytes]:
            nonlocal at, total
            yield MAGIC + bytes([width]) + name
            for piece in arrays.pieces(batches, "text", _PIECE_BYTES):
                ids, offsets = encode(piece.column("text"), path, end_id)
                raw = memoryview(ids.astype(f"<u{width}").tobytes())
                packed = [pack(raw[a * width:b * width]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                entry = np.zeros(len(packed), _INDEX)
                key = piece.column("id")
                entry["id"] = pc.fill_null(key, 0).to_numpy(zero_copy_only=False)
                entry["null"] = key.is_null().to_numpy(zero_copy_only=False)
                sizes = np.fromiter(map(len, packed), np.int64, len(packed))
                entry["offset"] = at + np.cumsum(sizes) - sizes
                entry["count"] = np.diff(offsets)
                index.append(entry)
                at += int(sizes.sum())
                total += len(ids)
                yield b"".join(packed)
            entries = np.concatenate(index) if index else np.zeros(0, _INDEX)
            yield entries.tobytes()
            yield struct.pack(_FOOTER, at, len(entries), MAGIC)

        store.write(uri, frames())
        rows = sum(map(len, index))
        if rows:
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [uri], "documents": [rows], "tokens": [total]})

    ordered = docs.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id")
    manifest = work_folder(docs.sparkSession, "token-files")
    ordered.mapInArrow(run, "part long, file string, documents long, tokens long").write.parquet(manifest)
    return TokenStore(manifest, dictionary, width)


def _index(file: pa.NativeFile) -> tuple[np.ndarray, int]:
    """The offset index of a file and where the frames end."""
    size = file.size()
    at, n, magic = struct.unpack(_FOOTER, store.read_range(file, size - _FOOTER_SIZE, _FOOTER_SIZE))
    assert magic == MAGIC
    return np.frombuffer(store.read_range(file, at, n * _INDEX.itemsize), _INDEX), at


def read_tokens(spark: SparkSession, tokens: TokenStore) -> DataFrame:
    """id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the files."""
    files = spark.read.schema("part long, file string, documents long, tokens long").parquet(tokens.manifest)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    name, dictionary = hashlib.sha256(tokens.dictionary).digest(), tokens.dictionary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_zstd(dictionary)).decompress
        for batch in batches:
            for uri, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                with store.reader(uri) as file:
                    head = store.read_range(file, 0, len(MAGIC) + 1 + len(name))
                    assert head[len(MAGIC) + 1:] == name, "another dictionary"
                    width = head[len(MAGIC)]
                    index, frames_end = _index(file)
                    ends = np.append(index["offset"][1:], frames_end).astype(np.int64)
                    starts = first + np.cumsum(index["count"], dtype=np.int64) - index["count"]
                    for a in range(0, len(index), 1000):
                        part, base = index[a:a + 1000], int(index["offset"][a])
                        raw = memoryview(store.read_range(file, base, int(ends[a:a + 1000][-1]) - base))
                        cuts = zip((part["offset"].astype(np.int64) - base).tolist(), (ends[a:a + 1000] - base).tolist())
                        ids = [np.frombuffer(unpack(raw[x:y]), f"<u{width}").astype("<u4").tobytes() for x, y in cuts]
                        yield pa.RecordBatch.from_pydict({
                            "id": pa.array(part["id"], pa.int64(), mask=part["null"] == 1),
                            "start": pa.array(starts[a:a + 1000], pa.int64()),
                            "n_tokens": pa.array(part["count"].astype(np.int64)),
                            "ids": pa.array(ids, pa.binary())})

    return files.select("file", "first").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(
        run, "id long, start long, n_tokens long, ids binary")


def fetch(tokens: TokenStore, file_uri: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document of a file: one read of the index, one of the frame."""
    with store.reader(file_uri) as file:
        index, end = _index(file)
        here = index[index["null"] == 0]
        i = int(np.searchsorted(here["id"], doc_id))
        if i == len(here) or here["id"][i] != doc_id:
            return None
        i += len(index) - len(here)
        at, upto = int(index["offset"][i]), int(index["offset"][i + 1]) if i + 1 < len(index) else end
        raw = zstandard.ZstdDecompressor(dict_data=_zstd(tokens.dictionary)).decompress(store.read_range(file, at, upto - at))
        return np.frombuffer(raw, f"<u{tokens.width}")


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
