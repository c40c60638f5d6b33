"""Training runs: listings, best epoch, early stop, metric log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.config import EARLY_STOP_PATIENCE, RUN_LIST_SIZE
from ledgerlens.functions.numbers import metric_or_null
from ledgerlens.operators.ordered import running


def list_runs(runs: DataFrame, names: Sequence[str], status: str = "FINISHED", limit: int = RUN_LIST_SIZE) -> DataFrame:
    """The latest finished runs with one of the names; ties by run id."""
    return (
        runs.where((F.col("status") == status) & F.col("run_name").isin(list(names)))
        .orderBy(F.desc("start_time"), "run_id")
        .limit(limit)
    )


def clean_metrics(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    return runs.withColumns({c: metric_or_null(F.col(c)) for c in columns})


def latest_per_group(df: DataFrame, group: str, time: str, tie: str) -> DataFrame:
    """The latest row of each group. An aggregate, so a large group shrinks before the shuffle."""
    rest = [c for c in df.columns if c != group]
    row = F.max_by(F.struct(*rest), F.struct(F.col(time), F.col(tie)))
    return df.groupBy(group).agg(row.alias("_r")).select(group, *[f"_r.{c}" for c in rest])


def latest_n_per_group(df: DataFrame, group: str, time: str, tie: str, n: int, salts: int = 64) -> DataFrame:
    """The n latest rows per group, cut in two steps so that no task ranks a whole group.

    Rows are spread over `salts` parts by their tie column; each part keeps
    its n latest, and at most salts * n rows per group meet in the last step.
    """
    order = [F.desc(time), F.col(tie)]
    part = F.pmod(F.hash(tie), F.lit(salts))
    first = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    last = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return (
        df.withColumn("_part", part).withColumn("_rank", first).where(F.col("_rank") <= n).drop("_part", "_rank")
        .withColumn("rank", last).where(F.col("rank") <= n)
    )


def latest_version(models: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """The highest version per name, compared as integers ('10' after '9')."""
    number = F.col(version).try_cast("int")
    return models.groupBy(name).agg(F.max_by(version, number).alias(version))


def best_epoch(history: DataFrame) -> DataFrame:
    """(run_id, epoch, val_f1): the first epoch with the best F1 above 0."""
    top = F.max(F.struct("val_f1", (-F.col("epoch")).alias("_late")))
    return history.where("val_f1 > 0").groupBy("run_id").agg(top.alias("_b")).select(
        "run_id", (-F.col("_b._late")).alias("epoch"), F.col("_b.val_f1").alias("val_f1"))


def early_stop(history: DataFrame, patience: int = EARLY_STOP_PATIENCE) -> DataFrame:
    """Per epoch: did it improve, the best so far, and epochs since the last improvement.

    An epoch improves when its F1 is above 0 and above all F1 before it, so the
    last improvement is where the running best was first reached. Epochs of a
    run are numbered without gaps.
    """
    out = running(
        history, ["run_id"], ["epoch"],
        maxes={"_best": F.struct("val_f1", (-F.col("epoch")).alias("late")), "_first": -F.col("epoch")})
    gained = F.when(F.col("_best.val_f1") > 0, -F.col("_best.late"))
    stale = F.col("epoch") - F.coalesce(gained, -F.col("_first") - 1)
    return out.select(
        *history.columns,
        F.coalesce(gained == F.col("epoch"), F.lit(False)).alias("improved"),
        F.greatest(F.col("_best.val_f1"), F.lit(0.0)).alias("best_so_far"),
        stale.alias("stale_epochs"), (stale >= patience).alias("should_stop"))


def stop_epoch(history: DataFrame, patience: int = EARLY_STOP_PATIENCE) -> DataFrame:
    """The first epoch at which each run stops early, if it does."""
    return early_stop(history, patience).where("should_stop").groupBy("run_id").agg(F.min("epoch").alias("stop_epoch"))


def weighted_loss(history: DataFrame, group: str = "run_id") -> DataFrame:
    """Mean loss weighted by batch size: sum(loss * n) / sum(n)."""
    return history.groupBy(group).agg(
        F.try_divide(F.sum(F.col("loss") * F.col("n")), F.sum("n").cast("double")).alias("mean_loss"))


def metric_log(run_id: str, metrics: DataFrame) -> DataFrame:
    """(run_id, metric, label, value) rows of an evaluation report, ready to append."""
    return metrics.select(F.lit(run_id).alias("run_id"), "metric", "label", "value")
