"""Connected components over (u, v) edges between numbered nodes, by contraction.

In a round every node of the remaining edges points to the least of itself and its
neighbours, and follows that pointer once more; the ends of the edges are replaced by what
they point to, and loops and repeats go. Edges vanish in a number of rounds that is
logarithmic in practice; rounds go on until none is left.

A hub's neighbours meet in a partially aggregated ``min`` only; every join is between
tables read back from the shared folder, one of them with a row per node, so that adaptive
execution splits a hub's partition. Superseded tables are deleted, and nothing but an
emptiness test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.scratch import Scratch


def _simple(edges: DataFrame) -> DataFrame:
    """The edges without loops, each once, whichever way round it was."""
    u, v = F.col("u"), F.col("v")
    return edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def _moved(rows: DataFrame, end: str, to: DataFrame, keep: str) -> DataFrame:
    """``rows`` with column ``end`` replaced by what ``to`` (node, least) points to."""
    return rows.join(to.withColumnRenamed("node", end), end, keep).withColumn(end, F.coalesce("least", end)).drop("least")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long, not null) that has a neighbour
    other than itself. The root is some node of the component, the same for all of them."""
    rest, labels = scratch.table(_simple(edges), "edges"), None
    while not rest.isEmpty():
        ends = rest.select(F.col("u").alias("node"), F.col("v").alias("other")).unionAll(
            rest.select(F.col("v").alias("node"), F.col("u").alias("other")))
        once = scratch.table(ends.groupBy("node").agg(F.min("other").alias("other"))
                             .select("node", F.least("node", "other").alias("least")), "once")
        far = once.select("node", F.col("least").alias("to"))
        twice = scratch.table(_moved(far, "to", once, "inner").select("node", F.col("to").alias("least")), "twice")
        if labels is None:
            named = scratch.table(twice.select("node", F.col("least").alias("root")), "labels")
        else:
            named = scratch.table(_moved(labels, "root", twice, "left").select("node", "root"), "labels")
            scratch.drop(labels)
        labels = named
        half = scratch.table(_moved(rest, "u", twice, "inner").select("u", "v"), "half")
        left = scratch.table(_simple(_moved(half, "v", twice, "inner")), "edges")
        scratch.drop(once, twice, half, rest)
        rest = left
    return rest.select(F.col("u").alias("node"), F.col("v").alias("root")) if labels is None else labels
