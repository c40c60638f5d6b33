"""WARC archives with a two-level capture index.

Writing. Every row becomes a gzip member of its own in a WARC file of its task. Of
rows with equal payloads of at least `least` bytes the one with the largest id is a
response and the others revisit it.

Index. Captures are sorted by key, the URL with its host reversed
(`com,example,www)/path`), and written in shards of compressed blocks of `lines`
captures. A shard ends with a sparse directory: the first key and place of each
block. The list of shards (first key, last key, file) has one row a shard.

Lookup. A key finds its shards by binary search in the list, its blocks by binary
search in the shard's directory, its captures by binary search in the block. Only
that directory and those blocks are read, by range. Records are read by range too;
ranges of one file that lie close together are read at once.

Sorting is by key and id, so one hot key spreads over many shards, and each of its
shards is looked up by a task of its own.

Null payloads count as empty; null URLs have an empty key; a null id sorts below
all others, and a row of a null id revisits the largest id if there is one. Rows
that share the largest id and the payload are all responses. An empty table gives
empty files and lookups without rows. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import urllib.parse
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import arrays, store
from ledgerlens.operators.sizing import written

_FOOTER = "<QQ8s"
_FOOTER_SIZE = struct.calcsize(_FOOTER)
_MAGIC = b"CAPTURE1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, id long, file string, offset long, length long"
_NEAR, _MOST = 64 << 10, 4 << 20


def url_key(url: Column) -> Column:
    """The URL without scheme and user, its host in lower case and reversed by label."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)(.*)$"
    host = F.lower(F.regexp_extract(url, parts, 1))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, parts, 2))
    return F.coalesce(F.when(url.rlike(parts), key).otherwise(url), F.lit(""))


def with_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """id, url, payload, digest (SHA-1), kind and refers_to."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.unhex(F.sha2("payload", 256))).withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.where(F.octet_length("payload") >= least).groupBy("same")
        .agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(repeated, "same", "left").select(
        "id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def _header_text(value: str | None) -> str:
    """A value without line breaks or other controls."""
    return "".join(urllib.parse.quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def _name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record as a gzip member; a revisit has the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page)}",
             f"WARC-Target-URI: {_header_text(url)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    gzip = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gzip.compress(raw) + gzip.flush()


def parse(member: bytes) -> dict:
    """The parts of a record that the reader gives back."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().rpartition("Content-Length: ")[2].split("\r\n")[0])
    page = lambda name: int(name[10:-1]) if len(name) > 11 else None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return {"id": page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "kind": kind,
            "refers_to": page(fields.get("WARC-Refers-To", "")), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write WARC files under `folder`; gives one capture (key, id, file, offset, length) a row."""
    store.make_folder(folder)
    rows = with_types(pages, id_col, url_col, payload_col, least).withColumn("key", url_key(F.col("url")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, at = store.fresh(folder, TaskContext.get().partitionId(), "warc.gz"), 0
        system, path = store.place(uri)
        out = None
        for piece in arrays.pieces(batches, "payload", 4 << 20):
            out = out or system.open_output_stream(path, compression=None)
            cols = [piece.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to")]
            members = [record(*row, date) for row in zip(*cols)]
            out.write(b"".join(members))
            lengths = [len(m) for m in members]
            offsets = [at + n for n in [0, *accumulate(lengths)][:-1]]
            at += sum(lengths)
            yield pa.RecordBatch.from_pydict({
                "key": piece.column("key"), "id": piece.column("id"), "file": pa.array([uri] * len(members), pa.string()),
                "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())})
        if out:
            out.close()

    return written(rows.mapInArrow(run, _CAPTURE), "captures")


@dataclass(frozen=True)
class Shard:
    first: str
    last: str
    file: str


def write_index(captures: DataFrame, folder: str, lines: int = 3000) -> list[Shard]:
    """Write the shards of the index; the list has a row for each."""
    store.make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        uri, at, directory, last = store.fresh(folder, part, "captures"), 0, [], ""
        waiting: list[tuple] = []

        def block(rows: list[tuple]) -> bytes:
            nonlocal at, last
            packed = zlib.compress("\n".join(map(json.dumps, rows)).encode(), 6)
            directory.append((rows[0][0], at, len(packed)))
            at, last = at + len(packed), rows[-1][0]
            return packed

        def content() -> Iterator[bytes]:
            nonlocal waiting
            for batch in batches:
                waiting += zip(*[c.to_pylist() for c in batch.columns])
                while len(waiting) >= lines:
                    yield block(waiting[:lines])
                    waiting = waiting[lines:]
            if waiting:
                yield block(waiting)
            listed = zlib.compress(json.dumps(directory).encode())
            yield listed
            yield struct.pack(_FOOTER, at, len(listed), _MAGIC)

        store.write(uri, content())
        if directory:
            yield pa.RecordBatch.from_pydict({"part": [part], "first": [directory[0][0]], "last": [last], "file": [uri]})

    ordered = captures.repartitionByRange("key", "id", "file", "offset").sortWithinPartitions("key", "id", "file", "offset")
    shards = written(ordered.mapInArrow(run, "part long, first string, last string, file string"), "shards")
    return [Shard(r["first"], r["last"], r["file"]) for r in shards.orderBy("part").collect()]


class _Shards:
    """Shards that a task has open: their directories and the blocks read last."""

    def __init__(self, keep: int = 8):
        self.keep = keep
        self.files: OrderedDict = OrderedDict()
        self.blocks: OrderedDict = OrderedDict()

    def _directory(self, uri: str) -> tuple:
        if uri not in self.files:
            file = store.reader(uri)
            size = file.size()
            at, length, magic = struct.unpack(_FOOTER, store.read_range(file, size - _FOOTER_SIZE, _FOOTER_SIZE))
            assert magic == _MAGIC
            entries = json.loads(zlib.decompress(store.read_range(file, at, length)))
            self.files[uri] = file, [e[0] for e in entries], entries
            if len(self.files) > self.keep:
                self.files.popitem(last=False)[1][0].close()
        return self.files[uri]

    def _block(self, uri: str, number: int) -> tuple[list[str], list[list]]:
        if (uri, number) not in self.blocks:
            file, _, entries = self._directory(uri)
            _, at, length = entries[number]
            rows = [json.loads(x) for x in zlib.decompress(store.read_range(file, at, length)).decode().split("\n")]
            self.blocks[uri, number] = [r[0] for r in rows], rows
            if len(self.blocks) > self.keep:
                self.blocks.popitem(last=False)
        return self.blocks[uri, number]

    def find(self, uri: str, key: str) -> Iterator[list[list]]:
        """Captures of a key in a shard, block after block."""
        _, firsts, _ = self._directory(uri)
        number = max(0, bisect.bisect_left(firsts, key) - 1)
        while number < len(firsts) and firsts[number] <= key:
            keys, rows = self._block(uri, number)
            hit = rows[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]
            if hit:
                yield hit
            number += 1


def lookup(queries: DataFrame, shards: list[Shard], url_col: str = "url") -> DataFrame:
    """All captures of the distinct URLs' keys, through the index."""
    keys = queries.select(url_key(F.col(url_col)).alias("key")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = [s.first for s in shards], [s.last for s in shards]
        for batch in batches:
            found = [(k, n) for k in batch.column("key").to_pylist()
                     for n in range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k))]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([k for k, _ in found], pa.string()), "shard": pa.array([n for _, n in found], pa.int64())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Shards()
        for batch in batches:
            rows: list[list] = []
            for key, n in zip(batch.column("key").to_pylist(), batch.column("shard").to_pylist()):
                for hit in opened.find(shards[n].file, key):
                    rows += hit
                    if len(rows) >= 5000:
                        yield _captures(rows)
                        rows = []
            if rows:
                yield _captures(rows)

    routed = keys.mapInArrow(route, "key string, shard long")
    placed = routed.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return placed.mapInArrow(search, _CAPTURE)


def _captures(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ("key", "id", "file", "offset", "length")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def read_records(captures: DataFrame) -> DataFrame:
    """The records of captures, by range reads in file order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]))
            while rows:
                uri, begin, length = rows[0]
                n, end = 1, begin + length
                while n < len(rows) and rows[n][0] == uri and rows[n][1] - end <= _NEAR and rows[n][1] + rows[n][2] - begin <= _MOST:
                    end = max(end, rows[n][1] + rows[n][2])
                    n += 1
                if uri != name:
                    if file:
                        file.close()
                    name, file = uri, store.reader(uri)
                raw = store.read_range(file, begin, end - begin)
                found = [parse(raw[a - begin:a - begin + size]) for _, a, size in rows[:n]]
                yield pa.RecordBatch.from_pylist(found, schema=_RECORD)
                rows = rows[n:]
        if file:
            file.close()

    near = F.floor(F.col("offset") / (16 << 20))
    placed = captures.withColumn("zone", near).repartition("file", "zone").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, "id long, url string, kind string, refers_to long, payload_bytes long, "
                                  "payload_digest string, payload binary")


_RECORD = pa.schema([("id", pa.int64()), ("url", pa.string()), ("kind", pa.string()), ("refers_to", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
