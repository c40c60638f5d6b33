r"""Toxic passages as maximum-scoring segments of token log-odds.

* Log-odds. Tokens are lower-cased words `[^\x20\x09-\x0D]+` without ASCII signs at
  either end, hashed into `2 ** bits` buckets, so the model has a fixed size. A
  bucket counts once a row, as a text that repeats a word tells no more by it. The
  log-odds of a bucket between toxic and clean rows have an informative Dirichlet
  prior of `prior` counts in the proportions of all training text. A bucket scores
  what its log-odds exceed `z` standard deviations; all others score `-drift`, or less
  if they are as surely clean. The mean score of clean text is thus below zero.
* Search. Ruzzo and Tompa's scan finds all maximal segments of a text in linear time;
  only positive tokens enter its list.
* Calibration. Scores of chance segments follow an extreme-value law: with n tokens,
  E = K n exp(-lambda S) segments of score S or more are expected. lambda solves
  sum p exp(lambda s) = 1 over clean text, K is its maximum-likelihood value given the
  best segments of clean training rows. A segment is significant if E < `chance`.
  A text's evidence (bits of its best segment, and how many are significant) becomes
  a probability by logistic regression on the training rows, fitted on counts of
  cells of the evidence.

The fit uses at most `training_rows` labelled rows, those with the smallest hash
of the id; that bound is what lets their ids be broadcast. Rows whose crc32(id as
text) leaves 0 modulo `fold` are never used to learn.

Null and empty texts have no segments and get the probability of a text without
evidence. Labels with a null id or label are left out; an id labelled twice takes the
larger label. Rows with a null id are scored and held in. With no usable labels every
score is 0. Repeated rows each get a score. Only the named columns are read.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import arrays
from ledgerlens.operators.sizing import written

_SEGMENTS = "array<struct<first:long,last:long,score:double>>"


def _held_out(column: str, fold: int):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % fold == 0, F.lit(False))


def _buckets(vocab: pa.Array, bits: int) -> np.ndarray:
    """The bucket of each word; words of signs only keep them."""
    bare = pc.utf8_trim(pc.utf8_lower(vocab), string.punctuation)
    bare = pc.if_else(pc.equal(bare, ""), vocab, bare)
    mask = (1 << bits) - 1
    return np.fromiter((zlib.crc32(w.encode()) & mask for w in bare.to_pylist()), np.int64, len(bare))


def training_labels(labels: DataFrame, id_col: str, label_col: str, fold: int, training_rows: int) -> DataFrame:
    """id and label of the rows to learn from."""
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.dropna().where(~_held_out("id", fold)).groupBy("id").agg(F.max("label").alias("label"))
    return written(usable.orderBy(F.xxhash64("id", F.lit(4)), "id").limit(training_rows), "training-labels")


def token_counts(texts: DataFrame, labelled: DataFrame, bits: int) -> np.ndarray:
    """Clean and toxic training rows that have a token of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int64)
        for piece in arrays.pieces(batches, "text"):
            words = arrays.split(piece.column("text"))
            bucket = _buckets(words.vocab, bits)[words.ids]
            once = np.unique(words.owner << bits | bucket)
            toxic = piece.column("label").to_numpy()[once >> bits] > 0
            for k in (0, 1):
                total[k] += np.bincount(once[toxic == k] & (1 << bits) - 1, minlength=1 << bits)
        used = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_pydict({"bucket": used, "clean": total[0][used], "toxic": total[1][used]})

    rows = texts.join(F.broadcast(labelled), "id").select("text", "label").mapInArrow(
        run, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = rows.toArrow()
    out = np.zeros((2, 1 << bits), np.int64)
    out[:, found.column("bucket").to_numpy()] = found.column("clean").to_numpy(), found.column("toxic").to_numpy()
    return out


def log_odds(counts: np.ndarray, prior: float, z: float, drift: float) -> np.ndarray:
    """The score of each bucket."""
    both = counts.sum(0) + 0.01
    pseudo = prior * both / both.sum()
    with_prior = counts + pseudo
    rest = with_prior.sum(1, keepdims=True) - with_prior
    odds = np.log(with_prior[1] / rest[1]) - np.log(with_prior[0] / rest[0])
    spread = z * np.sqrt((1 / with_prior).sum(0))
    return np.where(odds > spread, odds - spread, -drift - np.maximum(0, -odds - spread))


def decay(scores: np.ndarray, clean: np.ndarray) -> float:
    """lambda with sum p exp(lambda s) = 1 over clean text."""
    p = (clean + 1e-9) / (clean + 1e-9).sum()
    low, high = 1e-3, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        if np.log(p @ np.exp(np.minimum(mid * scores, 700))) < 0:
            low = mid
        else:
            high = mid
    return low


def maximal_segments(places: list[int], before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal segments, given the positive tokens' places and the running sums before and after each."""
    segments: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, nearest with a lower sum before
    for place, left, right in zip(places, before, after):
        first = place
        while True:
            j = len(segments) - 1
            while j >= 0 and segments[j][2] >= left:
                j = segments[j][4]
            if j < 0 or segments[j][3] >= right:
                segments.append((first, place, left, right, j))
                break
            first, left = segments[j][0], segments[j][2]
            del segments[j:]
    return [(a, b, right - left) for a, b, left, right, _ in segments]


def segments_of(texts: DataFrame, scores: np.ndarray, bits: int) -> DataFrame:
    """id, n_tokens and all maximal segments of every text."""
    scores = scores.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        for piece in arrays.pieces(batches, "text"):
            words = arrays.split(arrays.whole(piece.column("text")))
            of_token = scores[_buckets(words.vocab, bits)].astype(np.float64)[words.ids]
            running = np.concatenate([[0.0], np.cumsum(of_token)])
            positive = np.flatnonzero(of_token > 0)
            found: list[list[dict]] = [[] for _ in range(piece.num_rows)]
            bounds = np.searchsorted(positive, words.offsets)
            for d in np.flatnonzero(np.diff(bounds)):
                own = positive[bounds[d]:bounds[d + 1]]
                hits = maximal_segments((own - words.offsets[d]).tolist(), running[own].tolist(), running[own + 1].tolist())
                found[d] = [{"first": a, "last": b, "score": s} for a, b, s in hits]
            yield pa.RecordBatch.from_pydict({
                "id": piece.column("id"), "n_tokens": words.counts, "segments": pa.array(found, shape)})

    return texts.select("id", "text").mapInArrow(run, f"id long, n_tokens long, segments {_SEGMENTS}")


def logistic(x: np.ndarray, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Coefficients of a weighted logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - p)) - 1e-3 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def surprise(log_expected: Column) -> Column:
    """Bits of a chance segment as good, of which exp(log_expected) are expected; 40 at most.

    Below e**-20 the chance of one equals the number expected, so the bits are taken
    from its logarithm: the number itself becomes 0 for strong texts.
    """
    few = -log_expected / math.log(2)
    return F.least(F.lit(40.0), F.greatest(F.lit(0.0), F.when(log_expected < -20, few).otherwise(
        -F.log2(-F.expm1(-F.exp(log_expected))))))


def score_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                fold: int = 5, training_rows: int = 100_000, bits: int = 20, prior: float = 5000.0, z: float = 3.0,
                drift: float = 0.05, chance: float = 0.05) -> DataFrame:
    """id, held_out, significant passages (word numbers, score) and the probability of every text."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    labelled = training_labels(labels, id_col, label_col, fold, training_rows)
    counts = token_counts(texts, labelled, bits)
    scores = log_odds(counts, prior, z, drift)
    rate = decay(scores, counts[0])

    found = written(segments_of(texts, scores, bits), "segments")
    best = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    rows = found.withColumn("best", best)
    trained = rows.join(F.broadcast(labelled), "id")
    clean = trained.where("label = 0 AND n_tokens > 0").agg(
        F.count("*"), F.sum(F.col("n_tokens") * F.exp(-rate * F.col("best")))).first()
    k = clean[0] / clean[1] if clean[1] else 1.0

    def log_expected(score):
        return F.log(k * F.col("n_tokens")) - rate * score

    passages = F.filter("segments", lambda s: log_expected(s["score"]) < math.log(chance))
    bits_of_best = F.when(F.col("best") > 0, surprise(log_expected(F.col("best"))))
    evidence = [F.round(F.coalesce(bits_of_best, F.lit(0.0)), 1), F.log1p(F.least(F.size("passages"), F.lit(100)).cast("double"))]
    rows = rows.withColumn("passages", passages).withColumn("x1", evidence[0]).withColumn("x2", evidence[1])

    cells = rows.join(F.broadcast(labelled), "id").groupBy("x1", "x2").agg(F.count("*"), F.sum("label")).collect()
    table = np.array([tuple(map(float, c)) for c in cells]).reshape(-1, 4)
    score = F.lit(0.0)
    if table[:, 3].sum() > 0:
        x = np.column_stack([np.ones(len(table)), table[:, :2]])
        weight = np.concatenate([table[:, 3], table[:, 2] - table[:, 3]])
        label = np.concatenate([np.ones(len(table)), np.zeros(len(table))])
        b0, b1, b2 = logistic(np.concatenate([x, x]), weight, label).tolist()
        score = 1 / (1 + F.exp(-(F.lit(b0) + b1 * F.col("x1") + b2 * F.col("x2"))))
    return rows.select(F.col("id").alias(id_col), _held_out("id", fold).alias("held_out"), "passages", score.alias("score"))
