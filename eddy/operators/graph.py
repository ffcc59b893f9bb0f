"""Connected components by hooking to the least neighbour and contracting.

Each round every node of the remaining edges points to the least of itself and its
neighbours, follows that pointer once more, and the edges are rewritten between what
their ends point to; loops and repeats go. Edges vanish in a number of rounds that is
logarithmic in practice: nodes are compared by a hash, so no order of the ids makes long
chains. Rounds go on until no edge is left.

A hub's edges meet by ``groupBy(...).min`` (combined before the shuffle); every join is
between tables read back from the shared folder, one of them with a row per key, so that
adaptive execution splits a hub's partition. Superseded tables are deleted; nothing but an
emptiness test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def contract(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long, not null) that has a
    neighbour. The root is some node of the component, the same for all of them."""
    def tidy(e: DataFrame) -> DataFrame:
        return (e.where(F.col("u") != F.col("v"))
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    rest = scratch.table(tidy(edges), "edges")
    labels = None
    while not rest.isEmpty():
        both = rest.unionAll(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = scratch.table(both.groupBy("u").agg(F.min("v").alias("m"))
                             .select("u", F.least("u", "m").alias("m")), "hook")
        jump = scratch.table(
            hook.alias("a").join(hook.alias("b"), F.col("a.m") == F.col("b.u"))
            .select(F.col("a.u").alias("u"), F.col("b.m").alias("m")), "jump")
        if labels is None:
            new = scratch.table(jump.select(F.col("u").alias("node"), F.col("m").alias("root")), "labels")
        else:
            new = scratch.table(
                labels.alias("l").join(jump.alias("j"), F.col("l.root") == F.col("j.u"), "left")
                .select("node", F.coalesce("j.m", "l.root").alias("root")), "labels")
            scratch.drop(labels)
        labels = new
        half = scratch.table(rest.alias("e").join(jump.alias("j"), F.col("e.u") == F.col("j.u"))
                             .select(F.col("j.m").alias("u"), F.col("e.v").alias("v")).distinct(), "half")
        smaller = scratch.table(tidy(
            half.alias("e").join(jump.alias("j"), F.col("e.v") == F.col("j.u"))
            .select(F.col("e.u").alias("u"), F.col("j.m").alias("v"))), "edges")
        scratch.drop(hook, jump, half, rest)
        rest = smaller
    if labels is None:
        labels = rest.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return labels


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` (rows with a null end are ignored) -> ``(vertex, component)``
    for every vertex on an edge (self loops included); ``component`` is the least vertex id
    of its component.

    Nodes are numbered by a hash while contracting; two ids of one hash would be taken for
    one node, which 64 bits make no matter of practice."""
    scratch = Scratch(edges.sparkSession, "components")
    base = scratch.table(edges.select("src", "dst").dropna(), "input")
    ids = scratch.table(base.select(F.col("src").alias("vertex")).unionAll(base.select(F.col("dst").alias("vertex")))
                        .distinct().select("vertex", F.xxhash64("vertex").alias("node")), "ids")
    labels = contract(base.select(F.xxhash64("src").alias("u"), F.xxhash64("dst").alias("v")), scratch)
    # a vertex whose only edges are self loops is a component of its own
    named = scratch.table(ids.join(labels, "node", "left")
                          .select("vertex", F.coalesce("root", "node").alias("root")), "named")
    least = scratch.table(named.groupBy("root").agg(F.min("vertex").alias("component")), "least")
    scratch.drop(base, ids)
    return named.join(least, "root").select("vertex", "component")
