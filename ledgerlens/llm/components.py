"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.sizing import written


def _roots(steps: DataFrame) -> DataFrame:
    """node and the end of its way, for steps (node, to) that lead to lesser nodes, an end to itself.

    A round follows every way three times as far and says whether the last step led on.
    """
    while True:
        one, two = (steps.select(F.col("node").alias(f"via{k}"), F.col("to").alias(f"to{k}")) for k in (1, 2))
        far = steps.join(one, F.col("to") == F.col("via1")).join(two, F.col("to1") == F.col("via2"))
        far = written(far.select("node", F.col("to2").alias("to"), (F.col("to1") != F.col("to2")).alias("moved")), "labels")
        steps = far.select("node", "to")
        if far.where("moved").isEmpty():
            return steps


def _renamed(links: DataFrame, names: DataFrame) -> DataFrame:
    """Links (a, b) with the name that `names` (node, to) has for an end, if it has one."""
    one, two = (names.select(F.col("node").alias(f"node{k}"), F.col("to").alias(f"to{k}")) for k in (1, 2))
    found = links.select("a", "b").join(one, F.col("a") == F.col("node1"), "left").join(two, F.col("b") == F.col("node2"), "left")
    return found.select(F.coalesce("to1", "a").alias("a"), F.coalesce("to2", "b").alias("b"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node and component (its least node) of all nodes of links (a, b), and of `known`, the components of links before.

    In a round every node steps to its least neighbour, ways are followed to their ends, and
    each tree of steps becomes one node, so a round sees only links between trees. In two
    rounds every node that has links left joins another. Names lie in written tables; the
    driver sees whether a table is empty.
    """
    labels = None if known is None else known.select("node", F.col("component").alias("to"))
    left = links.select("a", "b") if labels is None else _renamed(links, labels)
    while True:
        left = written(left, "links")
        if labels is not None and left.isEmpty():
            return labels.withColumnRenamed("to", "component")
        ends = left.select(F.inline(F.array(*[
            F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ("ab", "ba")])))
        steps = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("to"))
        roots = _roots(written(steps, "labels"))
        if labels is not None:
            further = roots.select(F.col("node").alias("via"), F.col("to").alias("further"))
            again = labels.join(further, F.col("to") == F.col("via"), "left").select("node", F.coalesce("further", "to").alias("to"))
            labels = written(again.union(roots.join(labels.select("node"), "node", "left_anti")), "labels")
        else:
            labels = roots
        left = _renamed(left, roots).where("a <> b")
