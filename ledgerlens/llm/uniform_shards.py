"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Rows fall into `blocks` logical blocks by a hash of their content, so a block
   is the same set of rows whichever executor computes it.
2. The communication matrix says how many rows of block b go to shard s. Its rows
   are drawn from the multivariate hypergeometric law given the block and shard
   sizes, which is the law these counts have under a uniform permutation.
3. Each block is permuted on its own and dealt by its row of the matrix.
4. Rows are exchanged and every shard is permuted again. A shard is cut into
   `cells` by hash, so no task sorts a whole shard; the cells' counts give the
   place of each cell's first row.

The driver sees one count for each block: `blocks` numbers, whatever the input.
Everything else is DataFrame expressions.

Whole rows move: through the deal into shards, through the second permutation, and
into the shards' files, one folder for each shard. Sizes and checksums of the result
are those of the texts read back from the files.

Rows with a null id or text are ordinary rows (a null text has size 8 and the
checksum of no bytes). Repeated rows keep one slot each. An empty table gives no
rows. Columns may have any name, as rows travel as one struct.
"""

from __future__ import annotations

import json
import math
import random
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.session import work_folder

#: Whole rows are written twice; this takes about two thirds of the default's space.
_CODEC = "zstd"


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` items taken from `good` + `bad` are good.

    Inverse transform walking outwards from the mode, so the steps grow with
    the standard deviation and not with the counts.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    peak = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = right = mode
    p_left = p_right = peak
    rest = rng.random() - peak
    while rest >= 0:
        if right < high:
            p_right *= (good - right) * (draws - right) / ((right + 1) * (bad - draws + right + 1))
            right += 1
            rest -= p_right
            if rest < 0:
                return right
        if left > low:
            p_left *= left * (bad - draws + left) / ((good - left + 1) * (draws - left + 1))
            left -= 1
            rest -= p_left
            if rest < 0:
                return left
        elif right == high:
            return mode  # the float sum fell short of 1
        if p_left + p_right < 1e-300:
            return mode
    return mode


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each block to each shard; shard sizes differ by one at most."""
    rng, total = random.Random(seed), sum(block_rows)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for need in block_rows:
        rest, row = sum(free), []
        for s in range(shards):
            rest -= free[s]
            taken = hypergeometric(rng, free[s], rest, need)
            row.append(taken)
            need -= taken
        free = [f - t for f, t in zip(free, row)]
        matrix.append(row)
    return matrix


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder, as small as the shards' files."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.option("compression", _CODEC).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", shards: int = 24,
                 blocks: int = 512, cells: int = 64, seed: int = 20) -> None:
    """Writes every row, as a struct `row`, with its slot to the files of its shard; slots are gapless from 0 in a shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))

    def drawn(step: int) -> Column:
        return F.xxhash64(F.lit(seed * 1000 + step), F.col("id"), F.col("text_crc32"))

    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("block", F.pmod(drawn(0), F.lit(blocks)).cast("int"))
    counts = sorted((r["block"], r["count"]) for r in rows.groupBy("block").count().collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    bounds = json.dumps([{"block": b, "bounds": list(accumulate(row))} for (b, _), row in zip(counts, matrix)])
    plan = spark.range(1).select(F.inline(F.from_json(
        F.lit(bounds), "array<struct<block:int,bounds:array<bigint>>>")))

    inside = Window.partitionBy("block").orderBy(drawn(1), "id", "text_crc32")
    dealt = (
        rows.withColumn("place", F.row_number().over(inside))
        .join(plan, "block")
        .select("row", "id", "text_crc32",
                F.size(F.filter("bounds", lambda upto: upto < F.col("place"))).alias("shard"),
                F.pmod(drawn(2), F.lit(cells)).cast("int").alias("cell")))
    dealt = _written(dealt, "shard-dealt")

    firsts = dealt.groupBy("shard", "cell").count().select(
        "shard", "cell",
        F.coalesce(F.sum("count").over(
            Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("first"))
    again = Window.partitionBy("shard", "cell").orderBy(drawn(3), "id", "text_crc32")
    (
        dealt.withColumn("place", F.row_number().over(again))
        .join(firsts, ["shard", "cell"])
        .select("shard", (F.col("first") + F.col("place") - 1).alias("slot"), "row")
        .write.partitionBy("shard").option("compression", _CODEC).parquet(folder))


def read_shards(docs: DataFrame, folder: str) -> DataFrame:
    """shard, slot and row (a struct of the columns of `docs`) of all that the shards' files hold."""
    shape = StructType().add("slot", "long").add("row", docs.schema).add("shard", "integer")
    return docs.sparkSession.read.schema(shape).parquet(folder)


def uniform_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24,
                   blocks: int = 512, cells: int = 64, seed: int = 20) -> DataFrame:
    """id, text, size, text_crc32, shard and slot of every row, as read back from the shards' files."""
    folder = work_folder(docs.sparkSession, "shards")
    write_shards(docs, folder, id_col, text_col, shards, blocks, cells, seed)
    row = F.col("row")
    text = F.coalesce(row[text_col], F.lit(""))
    return read_shards(docs, folder).select(
        row[id_col].alias(id_col), row[text_col].alias(text_col),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "slot")
