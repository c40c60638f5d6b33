r"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents. Items are partitioned by the
size of their shingle sets into classes with an upper bound U (a power of two).
For each class a document is read in windows of 2U shingles that advance by U, so a
passage of an item's length lies whole in some window, and the Jaccard similarity
of an item with that window is bounded from below by its containment whatever the
document's length. Each of `hashes` MinHash values is a band of its own: a window
and an item that agree in one are a candidate. Contained to 0.8 in a window, an
item is missed with a chance under (1 - 0.36) ** hashes, 6e-7 for 32.

A window minimum is a minimum over blocks of the least U, so each hash function
costs one pass over the shingles, whatever the number of classes.

Most windows match nothing. A bitmap of fixed size, made from all items' MinHash
values, keeps those in the task; survivors are joined with the items' values on
(class, function, value). A second bitmap, of the items' shingles, keeps a
candidate document's possible shared shingles, which are joined with the items'
shingles by their text. A pair counts if the item's share of shingles that the whole
document has is `least` or more; that check is exact.

Shingles are `width` consecutive words `[^\x20\x09-\x0D]+`, A-Z lower-cased; a text
with fewer words is one shingle, a text without words has none and matches nothing.
Null texts have no words. Repeated documents and items each count. An empty table
on either side gives no pairs. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.shingles import Shingled
from ledgerlens.operators.sizing import written

_MASK = (1 << 64) - 1
BITMAP_BITS = 24


def _functions(hashes: int) -> list[tuple[np.uint64, np.uint64]]:
    """Odd multipliers and offsets of the hash functions."""
    rng = np.random.default_rng(5)
    return [(np.uint64(int(a) | 1), np.uint64(int(b)))
            for a, b in rng.integers(0, _MASK, (hashes, 2), np.uint64, endpoint=True)]


def _permuted(x: np.ndarray, function: tuple[np.uint64, np.uint64]) -> np.ndarray:
    y = x * function[0] + function[1]
    return y ^ (y >> np.uint64(32))


def _slots(upper: int, function: int, values: np.ndarray) -> np.ndarray:
    return (arrays.mixed(values + np.uint64((upper * 1009 + function) * 2654435761 & _MASK)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _classes(sizes: np.ndarray) -> np.ndarray:
    """The least power of two, 8 or more, that is not below the size."""
    return np.maximum(8, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))


def _item_rows(items: DataFrame, id_col: str, text_col: str, width: int, hashes: int) -> DataFrame:
    """A row for each item shingle (function -1) and each item MinHash value."""
    functions = _functions(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text", 1 << 20):
            s = Shingled(piece.column("text"), width)
            ids = piece.column("id").to_pylist()
            rows = []
            for i, item in enumerate(ids):
                a, b = s.offsets[i], s.offsets[i + 1]
                if a == b:
                    continue
                values, places = np.unique(s.hashes[a:b], return_index=True)
                upper = int(_classes(np.array([len(values)]))[0])
                rows += [(item, len(values), upper, -1, int(v.astype(np.int64)), s.text(a + p)) for v, p in zip(values, places)]
                rows += [(item, len(values), upper, k, int(_permuted(values, f).min().astype(np.int64)), None)
                         for k, f in enumerate(functions)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["item", "n_item", "upper", "function", "value", "shingle"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)

    return items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "item long, n_item long, upper long, function long, value long, shingle string")


def _bitmaps(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Marks of the items' MinHash values, of their shingles, and the classes in use.

    Tasks hand over the slots they set; slots are distinct after the shuffle, and
    there are no more than the bitmaps have bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper, function = (batch.column(c).to_numpy() for c in ("upper", "function"))
            values = batch.column("value").to_numpy().astype(np.uint64)
            slots = np.zeros(len(values), np.int64)
            for u, f in set(zip(upper.tolist(), function.tolist())):
                own = (upper == u) & (function == f)
                slots[own] = _slots(0, -1, values[own]) if f < 0 else _slots(u, f, values[own])
            yield pa.RecordBatch.from_pydict({"shared": pa.array(function < 0), "slot": pa.array(slots)})

    minima, shared = np.zeros(1 << BITMAP_BITS, bool), np.zeros(1 << BITMAP_BITS, bool)
    slots = rows.mapInArrow(run, "shared boolean, slot long").distinct().toArrow()
    which, slot = slots.column("shared").to_numpy(), slots.column("slot").to_numpy()
    shared[slot[which]], minima[slot[~which]] = True, True
    return minima, shared, sorted(r["upper"] for r in rows.select("upper").distinct().collect())


def _suspects(docs: DataFrame, minima: np.ndarray, shared: np.ndarray, uppers: list[int], width: int, hashes: int) -> DataFrame:
    """Documents with a marked window: its MinHash hits and the document's marked shingles."""
    functions, least = _functions(hashes), uppers[0]
    packed = np.packbits(minima), np.packbits(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_minima, in_shared = (np.unpackbits(p).astype(bool) for p in packed)
        for piece in arrays.pieces(batches, "text"):
            s = Shingled(piece.column("text"), width)
            sizes = np.diff(s.offsets)
            blocks = -(-sizes // least)
            of_block = np.repeat(np.arange(len(sizes)), blocks)
            if not len(of_block):
                continue
            number = arrays.gather(np.zeros(len(blocks), np.int64), blocks)
            begins = s.offsets[:-1][of_block] + number * least
            # A window of class U is two runs of U / least blocks, the second one empty at a document's end.
            runs = {}
            for u in uppers:
                step = u // least
                heads = np.flatnonzero(number % step == 0)
                following = np.append(heads[1:], len(of_block))
                has_next = np.append(of_block[heads[1:]] == of_block[heads[:-1]], False)
                runs[u] = heads, following, has_next
            hits: dict[int, list[tuple[int, int, int]]] = {}
            for k, f in enumerate(functions):
                block_least = np.minimum.reduceat(_permuted(s.hashes, f), begins)
                for u, (heads, _, has_next) in runs.items():
                    window = np.minimum.reduceat(block_least, heads)
                    window[:-1] = np.where(has_next[:-1], np.minimum(window[:-1], window[1:]), window[:-1])
                    for w in np.flatnonzero(in_minima[_slots(u, k, window)]):
                        hits.setdefault(int(of_block[heads[w]]), []).append((u, k, int(window[w].astype(np.int64))))
            if not hits:
                continue
            keys = piece.column("id").to_pylist()
            found = []
            for d, own in hits.items():
                a, b = s.offsets[d], s.offsets[d + 1]
                marked = a + np.flatnonzero(in_shared[_slots(0, -1, s.hashes[a:b])])
                marked = marked[np.unique(s.hashes[marked], return_index=True)[1]]
                own = sorted(set(own))
                found.append({"id": keys[d], "upper": [x[0] for x in own], "function": [x[1] for x in own],
                              "value": [x[2] for x in own], "shingles": [s.text(p) for p in marked]})
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([
                ("id", pa.int64()), ("upper", pa.list_(pa.int64())), ("function", pa.list_(pa.int64())),
                ("value", pa.list_(pa.int64())), ("shingles", pa.list_(pa.string()))]))

    return docs.mapInArrow(
        run, "id long, upper array<long>, function array<long>, value array<long>, shingles array<string>")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", least: float = 0.8, width: int = 5,
                    hashes: int = 32) -> DataFrame:
    """Pairs of a document and an item it contains: id, item, n_item, n_shared.

    Documents with equal ids give a pair for each id and item, with the larger share.
    """
    rows = written(_item_rows(items, item_col, item_text_col, width, hashes), "items")
    minima, shared, uppers = _bitmaps(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    suspects = written(
        _suspects(texts, minima, shared, uppers or [8], width, hashes)
        .withColumn("row", F.monotonically_increasing_id()), "suspects")

    hits = suspects.select("row", F.inline(F.arrays_zip("upper", "function", "value")))
    candidates = hits.join(rows.where("function >= 0").select("upper", "function", "value", "item"),
                           ["upper", "function", "value"]).select("row", "item").distinct()
    shingles = rows.where("function < 0").select("item", "n_item", "shingle").distinct()
    counted = (
        suspects.select("row", "id", F.explode("shingles").alias("shingle")).join(shingles, "shingle")
        .groupBy("row", "id", "item", "n_item").agg(F.count("*").alias("n_shared"))
        .where(F.col("n_shared") >= least * F.col("n_item")))
    return (
        counted.join(candidates, ["row", "item"], "left_semi")
        .groupBy("id", "item", "n_item").agg(F.max("n_shared").alias("n_shared"))
        .withColumnsRenamed({"id": id_col, "item": item_col}))
