"""Deterministic sampling and splitting by hashed row ids.

Rows are put in a fixed pseudo-random order per stratum: the order of
md5(seed|row_id). "The k first rows of the order" is found without sorting a
stratum: rows are counted per short hash prefix, whole prefixes below the cut are
in, the one prefix that straddles the cut is counted by a longer one, and so on;
only the rows of the last prefix are ranked.
The result is a threshold per stratum, so the sample itself is a filter on
the table with no shuffle of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.config import DriftSplitParams
from ledgerlens.operators.profile import top_values
from ledgerlens.operators.sizing import one_row, written

#: Prefix lengths, in turn: a count by two characters is 256 rows a stratum from each task.
PREFIXES = (2, 5)


def row_hash(row_id: str, seed: int) -> Column:
    """Lower-case hex md5 of 'seed|row_id'."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string")))


def cut_points(df: DataFrame, strata: Sequence[str], row_id: str, seed: int, quotas: DataFrame) -> DataFrame:
    """The last (hash, id) inside each quota: columns strata, `cut`, `mark`.

    `quotas` has the strata, a `cut` name and the number `k` of rows wanted.
    A quota of 0 yields no row; `k` must not exceed the stratum's row count.
    Without strata, `quotas` is one row for the whole table.
    """
    hashed = df.select(*strata, F.col(row_id).alias("_id"), row_hash(row_id, seed).alias("_h"))
    if strata:
        edge = quotas.select(*strata, "cut", F.col("k").alias("_need"))
    else:
        edge = quotas.select(F.lit("sample").alias("cut"), F.col("k").alias("_need"))
    edge = written(edge.withColumn("_p", F.lit("")), "edges")
    below = Window.partitionBy(*strata, "cut").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    shorter = 0
    for length in PREFIXES:
        narrowed = hashed.withColumns({"_p": F.substring("_h", 1, shorter), "_q": F.substring("_h", 1, length)})
        counts = (
            narrowed.groupBy(*strata, "_p", "_q").agg(F.count("*").alias("_n"))
            if not shorter else
            narrowed.join(edge.select(*strata, "_p").distinct(), [*strata, "_p"], "left_semi").groupBy(*strata, "_p", "_q").agg(F.count("*").alias("_n"))
        )
        held = (
            counts.join(edge, [*strata, "_p"])
            .withColumn("_before", F.coalesce(F.sum("_n").over(below), F.lit(0)))
            .where((F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_n")))
        )
        edge = written(held.select(*strata, "cut", F.col("_q").alias("_p"), (F.col("_need") - F.col("_before")).alias("_need")), "edges")
        shorter = length
    rank = F.row_number().over(Window.partitionBy(*strata, "cut").orderBy("_h", "_id"))
    return written(
        hashed.withColumn("_p", F.substring("_h", 1, shorter)).join(edge, [*strata, "_p"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_need"))
        .select(*strata, "cut", F.struct("_h", "_id").alias("mark"))
    )


def _mark(row_id: str, seed: int) -> Column:
    return F.struct(row_hash(row_id, seed).alias("_h"), F.col(row_id).alias("_id"))


def _wide(marks: DataFrame, strata: Sequence[str], cuts: Sequence[str]) -> DataFrame:
    """One row per stratum with a `_mark_<cut>` column per cut."""
    return marks.groupBy(*strata).agg(*[
        F.max(F.when(F.col("cut") == c, F.col("mark"))).alias(f"_mark_{c}") for c in cuts
    ])


def _within(mark: str, row_id: str, seed: int) -> Column:
    return F.coalesce(_mark(row_id, seed) <= F.col(mark), F.lit(False))


def strata_sizes(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    return df.groupBy(*strata).agg(F.count("*").alias("n"))


def stratified_flag(df: DataFrame, stratum: str, row_id: str, fraction: float, seed: int) -> DataFrame:
    """Add `in_sample`: true for round-half-even(fraction * n) rows per stratum."""
    size = F.bround(F.lit(fraction).cast("double") * F.col("n"), 0).cast("long")
    quotas = strata_sizes(df, [stratum]).select(stratum, F.lit("sample").alias("cut"), size.alias("k"))
    marks = _wide(cut_points(df, [stratum], row_id, seed, quotas), [stratum], ["sample"])
    return (
        df.join(marks, stratum, "left")
        .withColumn("in_sample", _within("_mark_sample", row_id, seed))
        .select(*df.columns, "in_sample")
    )


def stratified_sample(df: DataFrame, stratum: str, row_id: str, fraction: float, seed: int) -> DataFrame:
    return stratified_flag(df, stratum, row_id, fraction, seed).where("in_sample").drop("in_sample")


def sample_rest(df: DataFrame, stratum: str, row_id: str, fraction: float, seed: int) -> DataFrame:
    """The complement of `stratified_sample`."""
    return stratified_flag(df, stratum, row_id, fraction, seed).where("NOT in_sample").drop("in_sample")


def rest_by_id(df: DataFrame, sampled: DataFrame, row_id: str) -> DataFrame:
    """The complement for an arbitrary sample: anti join on the row id."""
    return df.join(sampled.select(row_id), row_id, "left_anti")


def sample_rows(df: DataFrame, row_id: str, n: int | Column, seed: int, size: DataFrame | None = None) -> DataFrame:
    """min(n, rows) rows without replacement, over the whole table.

    `n` may be an expression over the one-row table `size`; without `size` the
    rows are counted and given as column `n`.
    """
    size = size if size is not None else df.agg(F.count("*").alias("n"))
    wanted = F.least(F.lit(n).cast("long") if isinstance(n, int) else n, F.col("n"))
    marks = cut_points(df, [], row_id, seed, size.select(wanted.alias("k")))
    return (
        df.withColumn("_mark_sample", marks.select("mark").scalar())
        .where(_within("_mark_sample", row_id, seed)).drop("_mark_sample")
    )


def capped_per_group(df: DataFrame, group: str, row_id: str, cap: int, seed: int) -> DataFrame:
    """At most `cap` uniformly drawn rows per group."""
    wanted = F.least(F.lit(cap).cast("long"), F.col("n"))
    quotas = strata_sizes(df, [group]).select(group, F.lit("sample").alias("cut"), wanted.alias("k"))
    marks = _wide(cut_points(df, [group], row_id, seed, quotas), [group], ["sample"])
    return df.join(marks, group).where(_within("_mark_sample", row_id, seed)).select(*df.columns)


def shuffled(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """Rows in seeded random order. Sort only where an order is asked for."""
    return df.orderBy(row_hash(row_id, seed), row_id)


def _hash_places(pool: DataFrame, row_id: str, seed: int, length: int = 4) -> DataFrame:
    """(row_id, _pos): the place of each row in the order of hash and id, without a sort of the pool.

    Rows are counted by hash prefix; a row's place is the number of rows with smaller prefixes
    and its rank within its own, one of `16 ** length` even parts.
    """
    part = F.substring("_h", 1, length)
    hashed = pool.select(row_id, row_hash(row_id, seed).alias("_h")).withColumn("_part", part)
    counts = hashed.groupBy("_part").agg(F.count("*").alias("_n"))
    # as many rows as there are prefixes, whatever the pool
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_h", row_id))
    return hashed.withColumn("_rank", rank).join(before, "_part").select(row_id, (F.col("_before") + F.col("_rank")).alias("_pos"))


def draw_with_replacement(pool: DataFrame, row_id: str, draws: Column | int, seed: int,
                          sizes: DataFrame | None = None, chunk: int = 100_000) -> DataFrame:
    """Exactly `draws` rows of the pool, the same row possibly many times.

    Draw i takes the pool row at position `md5(seed|draw|i) mod m`. Draw
    numbers are made by the executors in chunks, equal positions are counted
    before the join, and the join is on the place of the pool row, found by counts of hash prefixes.
    `draws` may be an expression over the one-row table `sizes`. An empty pool
    gives an empty result.
    """
    place = _hash_places(pool, row_id, seed)
    size = pool.agg(F.count("*").alias("_m"))
    wanted = sizes.select(draws.alias("_draws")) if sizes is not None else size.select(F.lit(draws).cast("long").alias("_draws"))
    plan = one_row(wanted.withColumn("_m", size.scalar()))
    starts = (
        plan.where("_m > 0 AND _draws > 0")
        .select("_m", "_draws", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_draws") - 1) / chunk))).alias("_part"))
        # a fixed number of parts: adaptive coalescing would put all draws in one task
        .repartition(int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_part")
    )
    numbers = starts.select("_m", F.explode(F.sequence(
        F.col("_part") * chunk, F.least((F.col("_part") + 1) * chunk, F.col("_draws")) - 1)).alias("_draw"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"), F.col("_draw").cast("string")))
    position = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.col("_m") + 1
    hits = numbers.groupBy(position.alias("_pos")).agg(F.count("*").alias("_times"))
    # positions are found on ids alone, so the rows themselves move once
    drawn = place.join(hits, "_pos").select(row_id, "_times")
    return (
        pool.join(drawn, row_id)
        .select(*pool.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("copy_no"))
    )


def train_val_test(df: DataFrame, label: str, row_id: str, test_size: float, val_size: float, seed: int,
                   sizes: DataFrame | None = None) -> DataFrame:
    """Add `split` (train, val, test), stratified by label.

    The total test size is ceil(test_size * n), shared over the labels by
    largest remainder; validation takes its relative share of the rest in the
    same way. Labels with a single row stay in train. `sizes` passes rows per
    label (label, n) that are known already.
    """
    sizes = sizes if sizes is not None else written(strata_sizes(df, [label]))
    quotas = split_quotas(sizes, label, test_size, val_size)
    cuts = quotas.select(label, F.explode(F.array(
        F.struct(F.lit("test").alias("cut"), F.col("n_test").alias("k")),
        F.struct(F.lit("val").alias("cut"), (F.col("n_test") + F.col("n_val")).alias("k")),
    )).alias("q")).select(label, "q.*")
    marks = _wide(cut_points(df, [label], row_id, seed, cuts), [label], ["test", "val"])
    # with an empty test quota the test mark is null, which reads as "outside"
    split = (
        F.when(_within("_mark_test", row_id, seed), "test")
        .when(_within("_mark_val", row_id, seed), "val")
        .otherwise("train")
    )
    return df.join(marks, label, "left").withColumn("split", split).select(*df.columns, "split")


def split_quotas(sizes: DataFrame, label: str, test_size: float, val_size: float) -> DataFrame:
    """Rows per label in test and validation. The input has one row per label."""
    eligible = sizes.where("n >= 2")
    test = _largest_remainder(eligible, label, "n", test_size, "n_test")
    rest = test.withColumn("_rest", F.col("n") - F.col("n_test"))
    return _largest_remainder(rest, label, "_rest", val_size / (1.0 - test_size), "n_val").select(
        label, "n", "n_test", "n_val")


def _largest_remainder(sizes: DataFrame, label: str, count: str, share: float, name: str) -> DataFrame:
    """Integer quotas that sum to ceil(share * total), ties by label."""
    everything = Window.partitionBy()
    whole = (
        sizes.withColumn("_all", F.sum(count).over(everything))
        .withColumn("_goal", F.ceil(F.lit(share).cast("double") * F.col("_all")))
        # the product of two row counts leaves the range of a long at 10^10 rows
        .withColumn("_wide", F.col("_goal").cast("decimal(19,0)") * F.col(count).cast("decimal(19,0)"))
        .withColumn("_floor", F.expr("_wide div _all"))
        .withColumn("_left", F.col("_wide") % F.col("_all"))
    )
    order = F.row_number().over(everything.orderBy(F.desc("_left"), label))
    extra = F.col("_goal") - F.sum("_floor").over(everything)
    return (
        whole.withColumn("_extra", extra).withColumn("_order", order)
        .withColumn(name, F.col("_floor") + (F.col("_order") <= F.col("_extra")).cast("long"))
        .drop("_all", "_goal", "_wide", "_floor", "_left", "_extra", "_order")
    )


def drift_split(df: DataFrame, row_id: str, stratum: str = "category",
                params: DriftSplitParams = DriftSplitParams()) -> tuple[DataFrame, DataFrame]:
    """A stratified baseline, and a skewed remainder that over-draws the top labels.

    The remainder keeps its size; three quarters of it are drawn with
    replacement from rows of the overall most frequent labels, the others
    without replacement from the remaining rows. If there are too few other
    rows the second part is shorter. Every row carries `copy_no`.
    """
    seed = params.seed
    flagged = stratified_flag(df, stratum, row_id, params.baseline_fraction, seed)
    baseline = flagged.where("in_sample").drop("in_sample")
    # a tenth of the table is read several times below, so it is written once
    rest = written(flagged.where("NOT in_sample").drop("in_sample"), "rest")
    top = written(top_values(df, params.top_categories, stratum).select(stratum))
    sizes = one_row(rest.agg(F.count("*").alias("n_rest")))
    n_top = F.floor(F.lit(params.top_share) * F.col("n_rest"))

    top_rows = rest.join(top, stratum, "left_semi").select(*df.columns)
    other_rows = rest.join(top, stratum, "left_anti").select(*df.columns)
    other_size = other_rows.agg(F.count("*").alias("n")).withColumn("n_rest", sizes.scalar())
    drawn = draw_with_replacement(top_rows, row_id, n_top, seed, sizes)
    others = sample_rows(other_rows, row_id, F.col("n_rest") - n_top, seed, other_size)
    return baseline, drawn.unionByName(others.withColumn("copy_no", F.lit(1).cast("long")))
