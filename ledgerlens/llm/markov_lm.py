r"""A hidden Markov language model trained by Baum-Welch over partitions.

Texts become tokens: A-Z lower-cased, words `[^\x20\x09-\x0D]+`, then one end.
The model walks over latent states; a state emits a bucket of words (`buckets` hash
buckets and one for the end), and a bucket emits a word by its smoothed share of
the bucket's training tokens:

    p(word | bucket) = (c + 1) / (C + V + 1)

with c the word's training count and C, V the bucket's tokens and distinct words;
all unknown words of a bucket share the one extra place. So the latent model has a
fixed size however many words there are, and a text's likelihood is exact.

* Counting. Tasks cut their rows into chunks, number each chunk's distinct words
  and count them there. One shuffle by word sums the counts and hands each chunk the
  corpus counts of its own words, so no task holds the corpus vocabulary. A common
  word is one row a chunk.
* Training. Each round runs the scaled forward and backward recursions over all
  training tokens, in windows of `window` tokens; expected counts are summed over
  partitions (buckets x states numbers) and the driver takes the quotients. States
  start from the most different ones of `seeds` training documents.
* Scoring. The scaled forward recursion runs over each whole text, all texts of a
  chunk side by side.

Sums of doubles are rounded to six places, so that the order in which tasks end
does not show.

Null texts have only the end token. A row with a null id is a training row.
Repeated rows all count and all get a score. An empty table gives no rows; without
a training row the model is uniform. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.operators.sizing import written

END = "\n"
BUCKETS = 8192
_PIECE_BYTES = 8 << 20  # the larger, the fewer words come up in several chunks
_CHUNK = "chunk long, ids array<long>, held array<boolean>, sizes binary, seq binary, buckets binary, words array<string>, counts array<long>"


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # a row for each bucket, a column for each state


def held_out(id_col: str, by: int, remainder: int):
    """Whether crc32(id as text) leaves the remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % by == remainder, F.lit(False))


def _chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """A row for each chunk of texts: its words, their training counts, and the texts as word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=1).compress
        for piece in arrays.pieces(batches, "text", _PIECE_BYTES):
            words = arrays.split(pc.ascii_lower(arrays.whole(piece.column("text"))))
            held = piece.column("held").to_numpy(zero_copy_only=False)
            counts = words.counts
            count = np.bincount(words.ids, np.repeat(~held, counts), len(words.vocab)).astype(np.int64)
            used = np.bincount(words.ids, minlength=len(words.vocab)) > 0
            order = np.argsort(-np.bincount(words.ids, minlength=len(words.vocab)), kind="stable")[:int(used.sum())]
            rank = np.zeros(len(used), np.int64)
            rank[order] = np.arange(len(order))
            names = words.vocab.take(pa.array(order)).to_pylist()
            sizes = counts + 1
            seq = np.full(int(sizes.sum()), len(names), "<u4")
            inside = np.ones(len(seq), bool)
            inside[np.cumsum(sizes) - 1] = False
            seq[inside] = rank[words.ids]
            bucket = np.array([*(zlib.crc32(n.encode()) % buckets for n in names), buckets], "<u2")
            yield pa.RecordBatch.from_pylist([{
                "chunk": part << 32 | number, "ids": piece.column("id").to_pylist(), "held": held.tolist(),
                "sizes": sizes.astype("<u4").tobytes(), "seq": pack(seq.tobytes()), "buckets": bucket.tobytes(),
                "words": [*names, END], "counts": [*count[order].tolist(), int((~held).sum())]}],
                schema=pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                                  ("sizes", pa.binary()), ("seq", pa.binary()), ("buckets", pa.binary()),
                                  ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]))
            number += 1

    return written(docs.mapInArrow(run, _CHUNK), "chunks")


def _corpus_counts(chunks: DataFrame, buckets: int) -> DataFrame:
    """For each chunk the corpus counts of its words, and the bucket sums of the words that are first met in it."""
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "x")).select(
        F.col("x.words").alias("word"), F.col("x.counts").alias("n"), "chunk", "pos")
    same = Window.partitionBy("word")
    bucket = F.when(F.col("word") == END, buckets).otherwise(F.crc32(F.col("word").cast("binary")) % buckets)
    counted = rows.select(
        "chunk", "pos", F.sum("n").over(same).alias("c"), bucket.cast("int").alias("bucket"),
        (F.struct("chunk", "pos") == F.min(F.struct("chunk", "pos")).over(same)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def flush(chunk: int) -> pa.RecordBatch:
            c, bucket, first = (np.concatenate(x) for x in zip(*waiting))
            known = first & (c > 0)
            sums = np.stack([np.bincount(bucket[known], c[known], buckets + 1), np.bincount(bucket[known], minlength=buckets + 1)])
            return pa.RecordBatch.from_pydict({
                "chunk": [chunk], "c": pa.array([c.astype("<i8").tobytes()], pa.binary()),
                "sums": pa.array([sums.astype("<i8").tobytes()], pa.binary())})

        now = None
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("c", "bucket", "first")]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if now is not None and chunk[a] != now:
                    yield flush(now)
                    waiting = []
                now = int(chunk[a])
                waiting.append(tuple(x[a:b] for x in cols))
        if waiting:
            yield flush(now)

    gathered = counted.repartition("chunk").sortWithinPartitions("chunk", "pos")
    return written(gathered.mapInArrow(run, "chunk long, c binary, sums binary"), "corpus-counts")


def _bucket_sums(counts: DataFrame, buckets: int) -> np.ndarray:
    """Training tokens and distinct words of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets + 1), np.int64)
        for batch in batches:
            for raw in batch.column("sums").to_pylist():
                total += np.frombuffer(raw, "<i8").reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"b": np.arange(buckets + 1), "c": total[0], "v": total[1]})

    rows = counts.select("sums").mapInArrow(run, "b long, c long, v long").groupBy("b").agg(F.sum("c"), F.sum("v")).collect()
    out = np.zeros((2, buckets + 1), np.int64)
    for b, c, v in rows:
        out[:, b] = c, v
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Each chunk's row, the bucket of each token, and the sizes of its texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for row in batch.to_pylist():
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        seq = np.frombuffer(unpack(row["seq"], max_output_size=int(4 * sizes.sum())), "<u4")
        row["numbers"] = seq
        yield row, np.frombuffer(row["buckets"], "<u2")[seq], sizes


def _side_by_side(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sequences from the longest, and how many are longer than t for each t."""
    order = np.argsort(-sizes, kind="stable")
    longer = np.searchsorted(-sizes[order], -np.arange(int(sizes.max()) if len(sizes) else 0), "left")
    return order, longer


def expected_counts(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of sequences under the model."""
    states = len(model.start)
    order, longer = _side_by_side(tokens, begins, sizes)
    begins, move, emit = begins[order], model.move.astype(np.float32), model.emit.astype(np.float32)
    forward, scale, seen = [], [], []
    for t, live in enumerate(longer):
        symbol = tokens[begins[:live] + t]
        a = np.broadcast_to(model.start.astype(np.float32), (live, states)) if t == 0 else forward[-1][:live] @ move
        a = a * emit[symbol]
        c = np.maximum(a.sum(1, keepdims=True), 1e-30)
        forward.append(a / c)
        scale.append(c)
        seen.append(symbol)
    moves, gammas = np.zeros((states, states)), [None] * len(forward)
    after = np.ones((0, states), np.float32)
    for t in range(len(forward) - 1, -1, -1):
        beta = np.ones_like(forward[t])
        if len(after):
            reach = emit[seen[t + 1]] * after / scale[t + 1]
            beta[:len(after)] = reach @ move.T
            moves += forward[t][:len(after)].T.astype(np.float64) @ reach
        gammas[t], after = forward[t] * beta, beta
    if not gammas:
        return np.zeros(states), moves, np.zeros_like(model.emit)
    gamma, symbols = np.concatenate(gammas), np.concatenate(seen)
    gamma = gamma / np.maximum(gamma.sum(1, keepdims=True), 1e-30)
    emissions = np.stack([np.bincount(symbols, gamma[:, k], len(model.emit)) for k in range(states)], 1)
    return gamma[:len(gammas[0])].sum(0, dtype=np.float64), moves * model.move, emissions


def log_likelihood(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """log10 of the probability of each sequence of buckets, by the scaled forward recursion."""
    order, longer = _side_by_side(tokens, begins, sizes)
    begins, total = begins[order], np.zeros(len(order))
    state = np.broadcast_to(model.start, (len(order), len(model.start)))
    for t, live in enumerate(longer):
        state = state[:live] if t == 0 else state[:live] @ model.move
        state = state * model.emit[tokens[begins[:live] + t]]
        c = state.sum(1)
        total[:live] += np.log10(c)
        state = state / c[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


def _windows(sizes: np.ndarray, keep: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and sizes of the windows that cover all tokens of the texts to keep."""
    begins = (np.cumsum(sizes) - sizes)[keep]
    sizes = sizes[keep]
    n = -(-sizes // window)
    number = arrays.gather(np.zeros(len(n), np.int64), n)
    first = np.repeat(begins, n) + number * window
    return first, np.minimum(window, np.repeat(begins + sizes, n) - first)


def _one_round(chunks: DataFrame, model: Model, window: int) -> Model:
    states, symbols = len(model.start), len(model.emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + states + symbols, states))
        for batch in batches:
            for row, tokens, sizes in _texts(batch):
                begins, lengths = _windows(sizes, ~np.array(row["held"], bool), window)
                if len(begins):
                    total += np.concatenate([x.reshape(-1, states) for x in expected_counts(tokens, begins, lengths, model)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), *[pa.array(total[:, k]) for k in range(states)]],
            ["row", *[f"s{k}" for k in range(states)]])

    fields = ", ".join(["row long", *[f"s{k} double" for k in range(states)]])
    sums = chunks.select("held", "sizes", "seq", "buckets").mapInArrow(run, fields).groupBy("row").agg(
        *[F.round(F.sum(f"s{k}"), 6) for k in range(states)]).collect()
    table = np.zeros((1 + states + symbols, states))
    for row, *values in sums:
        table[row] = values
    start, move, emit = table[0] + 0.1, table[1:1 + states] + 0.1, table[1 + states:]
    backing = (emit.sum(1, keepdims=True) + 1) / (emit.sum() + symbols)
    emit = emit + 20 * backing
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _first_model(chunks: DataFrame, sums: np.ndarray, states: int, seeds: int) -> Model:
    """States that emit like documents far apart from each other, and tend to stay."""
    symbols = sums.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, tokens, sizes in _texts(batch):
                ends = np.cumsum(sizes)
                for i, (a, b) in enumerate(zip(ends - sizes, ends)):
                    if not row["held"][i] and sizes[i] > 100:
                        order = zlib.crc32(f"seed {row['ids'][i]}".encode())
                        found.append((order, np.bincount(tokens[a:b], minlength=symbols).astype("<i4")))
                found = sorted(found, key=lambda x: x[0])[:seeds]
            yield pa.RecordBatch.from_pydict({
                "h": pa.array([h for h, _ in found], pa.int64()), "n": pa.array([zlib.compress(n.tobytes()) for _, n in found], pa.binary())})

    drawn = written(chunks.select("ids", "held", "sizes", "seq", "buckets").mapInArrow(run, "h long, n binary"), "seeds")
    # first the hashes alone, so that the driver gets `seeds` rows of counts and not as many from each task
    last = drawn.select("h").orderBy("h").limit(seeds).agg(F.max("h")).first()[0]
    picked = drawn.where(F.col("h") <= F.lit(last)).orderBy("h")
    share = (sums[0] + 1) / (sums[0].sum() + symbols)
    rows = np.array([np.frombuffer(zlib.decompress(r["n"]), "<i4") for r in picked.collect()], float).reshape(-1, symbols)
    rows = rows / np.maximum(rows.sum(1, keepdims=True), 1)
    unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    chosen = [0] if len(rows) else []
    while len(chosen) < min(states, len(rows)):
        nearest = (unit @ unit[chosen].T).max(1)
        nearest[chosen] = np.inf
        chosen.append(int(nearest.argmin()))
    emit = np.array([0.5 * rows[i] + 0.5 * share for i in chosen] + [share] * (states - len(chosen))).T
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = 8, rounds: int = 4,
                buckets: int = BUCKETS, window: int = 256, seeds: int = 64, by: int = 7, remainder: int = 2) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col, by, remainder).alias("held"),
                       F.col(text_col).alias("text"))
    chunks = _chunks(rows, buckets)
    counts = _corpus_counts(chunks, buckets)
    sums = _bucket_sums(counts, buckets)
    train, distinct = int(sums[0].sum()), int(sums[1].sum())
    model = _first_model(chunks, sums, states, seeds)
    for _ in range(rounds):
        model = _one_round(chunks, model, window)
    in_bucket = np.log10(sums[0] + sums[1] + 1)
    in_bucket[buckets] = np.nan  # the end is alone in its bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens, sizes in _texts(batch):
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                c = np.frombuffer(row["c"], "<i8")
                bucket = np.frombuffer(row["buckets"], "<u2")
                of_word = np.log10(c + 1)
                inside = np.where(bucket == buckets, 0, of_word - in_bucket[bucket])
                numbers = row["numbers"]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                    "n_tokens": sizes, "n_known": arrays.sums((c > 0)[numbers].astype(np.int64), offsets),
                    "train_tokens": np.full(len(sizes), train),
                    "base_score": arrays.sums((of_word - np.log10(train + distinct + 1))[numbers], offsets),
                    "score": log_likelihood(tokens, offsets[:-1], sizes, model) + arrays.sums(inside[numbers], offsets)})

    joined = chunks.select("chunk", "ids", "held", "sizes", "seq", "buckets").join(counts.select("chunk", "c"), "chunk")
    return joined.mapInArrow(
        run, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    ).withColumnRenamed("id", id_col)
