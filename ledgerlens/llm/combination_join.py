r"""N-gram Jaccard join with token-combination prefixes.

The tokens of a document are the distinct hashes of its word shingles, in a global
order from rare to frequent. If two documents have a Jaccard similarity of 80 % or
more, at most t = n - ceil(0.8 n) tokens of either are missing in the other.

* Rare tokens are signatures on their own, frequent ones only in pairs: frequent
  tokens fall into groups by hash, and a signature is a pair from one group.
* The prefix is extended until rare tokens, plus frequent ones less one for each
  group, come to t + 1. Were no signature shared, more than t tokens would be missing,
  so documents that link share a signature (the usual argument for prefixes in a
  global order, with one common token a group not enough).
* The number of groups depends on the size class of a document (powers of two). A
  document writes the pairs of its own class and of the class of n / 0.8 (`least` as
  a share), so two documents that link have a class in common. Classes of small
  documents have singles only.
* Of two documents that link, the smaller misses at most n - ceil(1.6 n / 1.8) of its
  tokens, so the shared signature lies in its short prefix, made for that number.

Frequencies are counts of hash buckets over all documents; they only set the order,
so a collision costs time, never a link.

Equal sets are one node. Nodes of a signature are not paired all with all:

1. in a round, every node is verified against one leader of its signature's group,
   links are merged into components, and groups within one component are done;
2. further rounds take other leaders for what is left;
3. after `rounds` rounds, all pairs of a group whose nodes are in different components
   are candidates. In turns, each node has its nearest ones verified, by the distance of
   sketches; components grow, and pairs that come to lie within one drop out.

Step 3 ends when no pair is left, so components are exact. Pairs are ruled out by sizes and
by sketches of parity bits, which differ in no more bits than the sets in tokens;
what remains is verified by the sets themselves, with integers:
100 * intersection >= 80 * union.

Tasks put one row for each signature and piece of texts into the shuffle that finds
shared signatures, so a signature that a third of all documents have is as many
rows as there are pieces.

Shingles: five consecutive words `[^\x20\x09-\x0D]+`, A-Z lower-cased; with fewer
words, all of them; without words or text, none, and no links. Sets are compared by
64-bit hashes of shingles. Repeated rows are linked like copies. Rows of one id with
different texts are documents of their own. A null id never names a component unless
all its ids are null. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.components import components
from ledgerlens.llm.shingles import Shingled
from ledgerlens.operators.sizing import written

BITS = 24
_SLICE = 1 << 16
_BLOCK = 500
_SINGLES_BELOW = 4  # size classes of up to 15 tokens have singles only


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    s = Shingled(texts, width)
    for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist()):
        yield np.unique(s.hashes[a:b])


def _node(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    name = xxhash.xxh64_intdigest(tokens.tobytes())
    return name - (1 << 64) if name >> 63 else name


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BITS)).astype(np.int64)


def _key(id_: Column, text: Column) -> Column:
    """Which rows are alike in id and text; a collision brings a row that its set's name rules out."""
    return F.xxhash64(id_.cast("long"), text)


def _first_pass(docs: DataFrame, width: int) -> DataFrame:
    """Rows of documents (id, key, size, node) and rows of bucket counts (slice, counts)."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("size", pa.int64()), ("node", pa.int64()),
                        ("slice", pa.int64()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.uint16)  # a task counts a bucket up to 65,535, which is frequent anyway
        for piece in arrays.pieces(batches, "text", 2 << 20):
            sets = list(_sets(piece.column("text"), width))
            every = _bucket(np.concatenate(sets))
            hit, times = np.unique(every, return_counts=True)
            total[hit] = np.minimum(total[hit] + times, 65_535)
            n = len(sets)
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), piece.column("key"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([_node(x) if len(x) else None for x in sets], pa.int64()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=schema)
        for at in range(0, 1 << BITS, _SLICE):
            part = total[at:at + _SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    *[pa.nulls(1, pa.int64())] * 4,
                    pa.array([at // _SLICE], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], schema=schema)

    return written(docs.mapInArrow(run, "id long, key long, size long, node long, slice long, counts binary"), "sets")


def _frequencies(first: DataFrame) -> tuple[np.ndarray, int]:
    """Bucket counts on a logarithmic scale of a byte, and the step from which tokens are frequent.

    The driver gets `2 ** BITS` bytes, however many documents there are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(_SLICE, np.int64)

        def row() -> pa.RecordBatch:
            steps = np.minimum(255, np.round(8 * np.log2(total + 1))).astype(np.uint8)
            return pa.RecordBatch.from_pydict({"slice": [now], "n": [int(total.sum())], "steps": pa.array([steps.tobytes()], pa.binary())})

        for batch in batches:
            for slice_, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                if now is not None and slice_ != now:
                    yield row()
                    total[:] = 0
                now = slice_
                total += np.frombuffer(zlib.decompress(raw), np.uint16)
        if now is not None:
            yield row()

    parts = first.where("slice IS NOT NULL").select("slice", "counts").repartition("slice").sortWithinPartitions("slice")
    table, tokens = np.zeros(1 << BITS, np.uint8), 0
    for r in parts.mapInArrow(run, "slice long, n long, steps binary").collect():
        table[r["slice"] * _SLICE:(r["slice"] + 1) * _SLICE] = np.frombuffer(r["steps"], np.uint8)
        tokens += r["n"]
    return table, int(8 * np.log2(17 + 4 * tokens / (1 << BITS)))


def _pairs_of_groups(tokens: np.ndarray, groups: np.ndarray, size_class: int) -> np.ndarray:
    """A hash for each pair of tokens of one group."""
    order = np.lexsort((tokens, groups))
    tokens, groups, out, apart = tokens[order], groups[order], [], 1
    while apart < len(tokens):
        same = groups[apart:] == groups[:-apart]
        if not same.any():
            break
        out.append(arrays.mixed(tokens[:-apart][same] * np.uint64(0x9E3779B97F4A7C15) + tokens[apart:][same] + np.uint64(size_class)))
        apart += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures(tokens: np.ndarray, steps: np.ndarray, frequent: int, least: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set, ascending, and which of them the short prefix has too."""
    n = len(tokens)
    order = np.lexsort((tokens, steps))
    tokens, n_rare = tokens[order], int((steps < frequent).sum())

    def of_prefix(need: int) -> list[np.ndarray]:
        if n_rare >= need:
            return [tokens[:need]]
        out = []
        for size_class in {n.bit_length() - 1, (n * 100 // least).bit_length() - 1}:
            if size_class < _SINGLES_BELOW:
                out.append(tokens[:need])
                continue
            rest = tokens[n_rare:]
            groups = (arrays.mixed(rest) % np.uint64(1 << size_class - 2)).astype(np.int64)
            first = np.zeros(len(rest), bool)
            first[np.unique(groups, return_index=True)[1]] = True
            upto = int(np.searchsorted(np.cumsum(~first), need - n_rare)) + 1
            out += [tokens[:n_rare], _pairs_of_groups(rest[:upto], groups[:upto], size_class)]
        return out

    long = np.unique(np.concatenate(of_prefix(n - -(-least * n // 100) + 1)))
    short = np.concatenate(of_prefix(n - -(-2 * least * n // (100 + least)) + 1))
    return long, np.isin(long, short)


#: `info` is twice the size, and one more if the short prefix has the signature; it packs better than two columns.
_MEMBER = "struct<node:long,info:long>"


def _signature_rows(docs: DataFrame, width: int, table: np.ndarray, frequent: int, least: int) -> DataFrame:
    """A row for each signature and piece of texts: one node, and the others of the piece."""
    member = pa.struct([("node", pa.int64()), ("info", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text", 2 << 20):
            seen: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
            for tokens in _sets(piece.column("text"), width):
                if len(tokens) and (node := _node(tokens)) not in seen:
                    seen[node] = len(tokens), *signatures(tokens, table[_bucket(tokens)], frequent, least)
            if not seen:
                continue
            counts = [len(s) for _, s, _ in seen.values()]
            sigs = np.concatenate([s for _, s, _ in seen.values()])
            columns = {"sig": sigs.astype(np.int64), "node": np.repeat(np.fromiter(seen, np.int64, len(seen)), counts),
                       "info": 2 * np.repeat([n for n, *_ in seen.values()], counts) + np.concatenate([n for *_, n in seen.values()])}
            order = np.argsort(sigs, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(sigs[order]) != 0))
            alone = np.diff(np.append(heads, len(sigs))) == 1
            first = order[heads]
            others: list = [None] * len(heads)
            for h in np.flatnonzero(~alone):
                rest = order[heads[h] + 1:heads[h + 1] if h + 1 < len(heads) else len(sigs)]
                others[h] = [{"node": int(columns["node"][i]), "info": int(columns["info"][i])} for i in rest]
            back = np.argsort(first, kind="stable")  # rows of one document stay together and pack well
            yield pa.RecordBatch.from_pydict(
                {k: v[first[back]] for k, v in columns.items()} | {"others": pa.array([others[i] for i in back], pa.list_(member))})

    return docs.select("text").mapInArrow(run, f"sig long, node long, info long, others array<{_MEMBER}>")


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """sig, node, size and near of signatures by which two nodes may link.

    Rows are dealt out as they come from the tasks; members are unpacked after that.
    """
    rows, same = rows.repartition("sig"), Window.partitionBy("sig")
    packed = F.concat(F.array(F.struct("node", "info")), F.coalesce("others", F.array().cast(f"array<{_MEMBER}>")))
    members = F.transform(packed, lambda m: F.struct(
        m["node"].alias("node"), F.shiftright(m["info"], 1).alias("size"), (m["info"] % 2 == 1).alias("near")))
    sizes = F.transform("members", lambda m: m["size"])
    n = F.sum(F.size("members")).over(same)
    several = (F.min("node").over(same) != F.max("node").over(same)) | (F.max(F.size("members")).over(same) > 1)
    near = F.max(F.exists("members", lambda m: m["near"])).over(same)
    close = 100 * F.min(F.array_min(sizes)).over(same) >= least * F.max(F.array_max(sizes)).over(same)
    shared = rows.withColumn("members", members).withColumn("shared", several & near & (close | (n > 2))).where("shared")
    return written(shared.select("sig", F.inline("members")).distinct(), "groups")


def _sets_of(docs: DataFrame, nodes: DataFrame, first: DataFrame, width: int) -> DataFrame:
    """node and its set, for the given nodes, each from rows of one id and text.

    Rows are found by a hash of id and text, so rows that share an id, or have none, meet
    their own sets only. Repeated rows give their set once in a task.
    """
    chosen = first.where("node IS NOT NULL").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for piece in arrays.pieces(batches, "text", 2 << 20):
            fresh = [i for i, w in enumerate(piece.column("node").to_pylist()) if w not in done]
            piece = piece.take(pa.array(fresh, pa.int64()))
            hits = []
            for w, x in zip(piece.column("node").to_pylist(), _sets(piece.column("text"), width)):
                if w not in done and len(x) and _node(x) == w:
                    done.add(w)
                    hits.append((w, x.tobytes(), _sketch(x)))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([h[0] for h in hits], pa.int64()), "tokens": pa.array([h[1] for h in hits], pa.binary()),
                "sketch": pa.array([h[2] for h in hits], pa.binary())})

    texts = docs.join(chosen, F.col("key") == F.col("of")).select("node", "text")
    return written(texts.mapInArrow(run, "node long, tokens binary, sketch binary"), "token-sets")


def _sketch(tokens: np.ndarray) -> bytes:
    """A parity bit for each of 2 to 4 slots a token: two sets differ in at least as many tokens as their sketches in bits."""
    slots = 1 << max(6, (len(tokens) - 1).bit_length() + 1)
    parity = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the shorter."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        half = len(x) // 2
        x = (int.from_bytes(x[:half], "little") ^ int.from_bytes(x[half:], "little")).to_bytes(half, "little")
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # only sets that a pair names are moved: there are few pairs, and sets are the bulk of the data
    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")).join(pairs.select("a"), "a", "left_semi")
    two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")).join(pairs.select("b"), "b", "left_semi")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _not_far(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b, size, other_size) that their sketches do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (batch.column("size").to_numpy() + batch.column("other_size").to_numpy()) * (100 - least)
            apart = [_bits_apart(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            keep = np.array(apart, np.int64) * (100 + least) <= both
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "size", "other_size", "x", "y").mapInArrow(run, "a long, b long")


def _all_pairs_left(groups: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of a signature's nodes in different components that sizes and sketches do not rule out.

    A group of `members` nodes is cut into blocks of about `_BLOCK`, and a task gets two blocks,
    so no task holds a whole group; what leaves a task are pairs that must be verified.
    """
    def pairs_of(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        block, node, size, near, component = (np.array(c) for c in list(zip(*rows))[:5])
        sketches = [r[5] for r in rows]
        x, y = np.triu_indices(len(rows), 1)
        smaller, larger = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
        fine = (component[x] != component[y]) & (100 * smaller >= least * larger)
        fine &= (near[x] | (size[x] > size[y])) & (near[y] | (size[y] > size[x]))
        if block.min() != block.max():
            fine &= block[x] != block[y]
        for i, j in zip(x[fine].tolist(), y[fine].tolist()):
            apart = _bits_apart(sketches[i], sketches[j])
            if apart * (100 + least) <= int(size[i] + size[j]) * (100 - least):
                yield int(min(node[i], node[j])), int(max(node[i], node[j])), 1000 * apart // int(size[i] + size[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> pa.RecordBatch:
            found = list(pairs_of(rows)) if len(rows) > 1 else []
            return pa.RecordBatch.from_pydict({
                "a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64()),
                "apart": pa.array([f[2] for f in found], pa.int32())})

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("sig", "i", "j")])
            members = zip(*[batch.column(c).to_pylist() for c in ("block", "node", "size", "near", "component", "sketch")])
            for key, member in zip(keys, members):
                if key != now:
                    if len(rows) > 1:
                        yield flush()
                    now, rows = key, []
                rows.append(member)
        if len(rows) > 1:
            yield flush()

    cut = groups.withColumn("blocks", F.ceil(F.col("members") / _BLOCK).cast("int"))
    placed = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    spread = placed.select("sig", "block", "node", "size", "near", "component", F.inline(both))
    # sketches are the widest column: they come last and move once
    sketched = spread.join(sets.select("node", "sketch").dropDuplicates(["node"]), "node")
    dealt = sketched.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return dealt.mapInArrow(run, "a long, b long, apart int").dropDuplicates(["a", "b"])


def _nearest(candidates: DataFrame, each: int) -> DataFrame:
    """Of the pairs (a, b, apart) for each node the nearest in each of `each` random parts of its pairs."""
    ends = candidates.select("a", "b", "apart", F.pmod(F.xxhash64("a", "b"), F.lit(each)).alias("part"), F.explode(F.array("a", "b")).alias("node"))
    best = ends.groupBy("node", "part").agg(F.min(F.struct("apart", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def _between(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """The pairs whose nodes are in different components so far."""
    if found is None:
        return pairs
    one = found.select(F.col("node").alias("_a"), F.col("component").alias("_p"))
    two = found.select(F.col("node").alias("_b"), F.col("component").alias("_q"))
    placed = pairs.join(one, F.col("a") == F.col("_a"), "left").join(two, F.col("b") == F.col("_b"), "left")
    return placed.where(F.coalesce("_p", "a") != F.coalesce("_q", "b")).select(*pairs.columns)


def _may_link(least: int) -> Column:
    """Sizes are close, and the signature lies in the smaller set's short prefix."""
    close = 100 * F.least("size", "other_size") >= least * F.greatest("size", "other_size")
    return close & (F.col("near") | (F.col("size") > F.col("other_size"))) & (F.col("other_near") | (F.col("size") < F.col("other_size")))


def _nearest_first(candidates: DataFrame, sets: DataFrame, found: DataFrame | None, least: int) -> DataFrame | None:
    """Components when every candidate pair is decided: verified, or within one component by then.

    In each turn every node has its nearest pairs verified, one at first and four times as
    many in each further turn, and the links join components. Near copies link to their
    nearest ones, so a family is soon one component, and its other pairs need no look at sets.
    What is left goes in one turn when it is at most twice as many pairs as the first turn had.
    """
    left, each, few = written(candidates, "candidates"), 1, 0
    while n := left.count():
        last = n <= few
        chosen = left.select("a", "b") if last else written(_nearest(left, each), "pairs")
        found = _joined(written(_verified(chosen, sets, least), "found"), found)
        if last:
            break
        few = few or 2 * chosen.count()
        left = written(_between(left.join(chosen, ["a", "b"], "left_anti"), found), "candidates")
        each *= 4
    return found


def _joined(links: DataFrame, found: DataFrame | None) -> DataFrame | None:
    """The components after further links; none as long as there is no link."""
    return found if links.isEmpty() else components(links, found)


def _link_components(groups: DataFrame, sets: DataFrame, least: int, rounds: int) -> DataFrame:
    """node and component of all nodes that have a link."""
    spark = groups.sparkSession
    checked, found = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")), None
    for r in range(rounds + 1):
        if found is None:
            placed = groups.withColumn("component", F.col("node"))
        else:
            placed = groups.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        leaders = placed.groupBy("sig").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"),
            F.min_by(F.struct("node", "size", "near", "component"), F.xxhash64("node", F.lit(r))).alias("l"))
        leaders = leaders.where("low <> high").select(
            "sig", "members", F.col("l.node").alias("other"), F.col("l.size").alias("other_size"),
            F.col("l.near").alias("other_near"), F.col("l.component").alias("c"))
        groups = written(placed.join(leaders, "sig"), "groups")
        if groups.isEmpty():
            break
        if r == rounds:
            found = _nearest_first(_all_pairs_left(groups, sets, least).join(checked, ["a", "b"], "left_anti"), sets, found, least)
            break
        pairs = groups.where((F.col("component") != F.col("c")) & _may_link(least))
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "size", "other_size")
        fresh = pairs.dropDuplicates(["a", "b"]).join(checked, ["a", "b"], "left_anti")
        pairs = written(_not_far(fresh, sets, least), "pairs")
        checked = checked.union(pairs)
        found = _joined(written(_verified(pairs, sets, least), "found"), found)
        # all pairs with the leader are decided, so it leaves the group; a group of two nodes is done
        groups = groups.where(F.col("node") != F.col("other")).select("sig", "node", "size", "near")
    return found if found is not None else spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: int = 80,
             rounds: int = 2) -> DataFrame:
    """The rows with one left of each component: that of the least id and, among its texts, the least set name.

    Rows without words are in no component and all stay.
    """
    found = join_components(docs, id_col, text_col, width, least, rounds).where("node IS NOT NULL")
    winners = found.groupBy("component").agg(F.min(F.struct(F.col(id_col).cast("long").alias("id"), "node", "key")).alias("w"))
    winners = written(winners.select(F.col("w.key").alias("of"), "w.node"), "winners")
    names = docs.columns

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("text", pc.struct_field(batch.column("row"), [names.index(text_col)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(texts(batches), "text", 2 << 20):
            sets = _sets(piece.column("text"), width)
            mine = [len(x) > 0 and _node(x) == n for x, n in zip(sets, piece.column("node").to_pylist())]
            yield piece.select(["row"]).filter(pa.array(mine, pa.bool_()))

    rows = docs.select(F.struct(*names).alias("row"), _key(F.col(id_col), F.col(text_col)).alias("key"))
    own = rows.join(winners, F.col("key") == F.col("of")).select("row", "of", "node", F.col("row")[text_col].alias("text"))
    # repeated rows go where the join by key has brought them together, so whole rows move once
    shape = rows.schema["row"].dataType.simpleString()
    kept = own.dropDuplicates(["of", "node", "text"]).select("row", "node").mapInArrow(run, f"row {shape}").select("row.*")
    return kept.union(docs.where(~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    least: int = 80, rounds: int = 2) -> DataFrame:
    """id, n_shingles, node (name of the set), component, component_id (its least id) and key (hash of id and text) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _key(F.col(id_col), F.col(text_col)).alias("key"))
    first = _first_pass(rows, width)
    table, frequent = _frequencies(first)
    groups = _groups(_signature_rows(rows, width, table, frequent, least), least)
    sets = _sets_of(rows, groups.select("node").distinct(), first, width)
    found = _link_components(groups, sets, least, rounds)

    named = first.where("slice IS NULL").join(found, "node", "left").withColumn("class", F.coalesce("component", "node"))
    named = written(named.select("id", "key", "size", "node", "class"), "classes")
    least_id = named.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least_id"))
    return named.join(least_id, "class", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "node", F.col("class").alias("component"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least_id")).alias("component_id"), "key")
