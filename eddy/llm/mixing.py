"""Mixing sources to target weights by entropy balancing (native).

Targets: sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... of all words;
a target stops at ``most`` times its source's words and the excess goes to the others by
weight. Rates: among all document rates r_i in (0, ``most``] with sum r_i * size_i equal
to the target of each source, those nearest (in relative entropy) to one copy of each
document are r_i = min(most, exp(lambda_s * size_i)). The multipliers lambda_s solve the
convex dual, one equation per source; Newton steps run for all sources at once on counts
of documents per (source, size), a bracket keeps them safe. Copies: rates are rounded by
running sums over sizes, so that what one size gains the next gives back and a source's
words miss its target by no more than its longest document; inside a size documents are
dealt in the order of a hash of the id.

Defined cases: a null text has size 0; documents of size 0 keep one copy and count for
nothing; a null source is a source of its own; repeated rows (same id) are documents each;
without words nothing is taken; an empty table gives no rows; other columns are ignored
by ``mix`` and kept by ``resample``. Targets and multipliers are one row per source.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm.scratch import Scratch

WEIGHTS = (5.0, 2.0, 1.0)
PART = 4096  # documents of one source and size that are dealt together


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: float, scratch: Scratch) -> DataFrame:
    """Adds target to (source, words, least, second): one row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    t = scratch.table(sizes.withColumn("weight", weight), "sources")
    total = t.agg(F.sum("words")).first()[0] or 0
    limit = F.col("words") * most
    share = 0.0
    while True:  # every round settles at least one more source at its limit
        full = (F.col("weight") * share >= limit) if share else F.lit(False)
        r = t.agg(F.sum(F.when(full, limit).otherwise(0.0)).alias("settled"),
                  F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        new = (total - r["settled"]) / r["open"] if r["open"] else share
        if not r["open"] or new <= share * (1 + 1e-12):
            break
        share = new
    return t.select("source", "words", "least", "second", F.least(F.col("weight") * F.lit(float(share)), limit).alias("target"))


def _rate(lam: Column, size: Column, most: float) -> Column:
    return F.when(lam * size >= math.log(most), F.lit(most)).otherwise(F.exp(lam * size))


def solve(cells: DataFrame, wanted: DataFrame, most: float, scratch: Scratch, tolerance: float = 1e-9,
          rounds: int = 200) -> DataFrame:
    """(source, lam): multipliers with sum n * size * rate = target for every source.

    The sum grows with lam and log(target / words) / least is a bound on the far side of
    the solution from 0, which gives the first bracket. A Newton step that leaves the
    bracket is replaced by its middle.
    """
    edge = F.log(F.col("target") / F.col("words")) / F.col("least")
    state = scratch.table(wanted.where(F.col("words") > 0).select(
        "source", "target", F.least(edge, F.lit(0.0)).alias("low"), F.greatest(edge, F.lit(0.0)).alias("high"),
        (F.log(F.col("target") / F.col("words")) * F.col("words") / F.col("second")).alias("lam"),
        F.lit(True).alias("open")), "state")
    size = F.col("size").cast("double")
    for _ in range(rounds):
        if state.where("open").isEmpty():
            break
        rate = _rate(F.col("lam"), size, most)
        sums = (cells.join(state.select(F.col("source").alias("s"), "lam"), F.col("source").eqNullSafe(F.col("s")))
                .groupBy("s").agg(
                    F.sum(F.col("n") * size * rate).alias("got"),
                    F.sum(F.when(rate < most, F.col("n") * size * size * rate).otherwise(0.0)).alias("slope")))
        miss = F.col("got") - F.col("target")
        low = F.when(miss <= 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(miss >= 0, F.col("lam")).otherwise(F.col("high"))
        step = F.col("lam") - F.try_divide(miss, F.col("slope"))
        lam = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        done = F.abs(miss) <= tolerance * F.col("target")
        new = scratch.table(
            state.join(sums, F.col("source").eqNullSafe(F.col("s")))
            .select("source", "target", low.alias("low"), high.alias("high"),
                    F.when(done, F.col("lam")).otherwise(lam).alias("lam"), (~done).alias("open")), "state")
        scratch.drop(state)
        state = new
    return state.select("source", "lam")


def _dealt(docs: DataFrame, cells: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, u, source, size, copies): every cell's copies dealt out to its documents.

    A cell (source, size) may hold any number of rows; it is cut by a hash of the id into
    parts of about ``PART`` rows, parts get their copies by running sums, and a window
    ranks the rows of one part only.
    """
    cells = cells.select(F.col("source").alias("cs"), F.col("size").alias("cz"), "n", "copies",
                         F.ceil(F.col("n") / PART).cast("long").alias("parts"))
    placed = scratch.table(
        docs.join(cells, F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz"))).drop("cs", "cz")
        .withColumn("part", F.pmod(F.xxhash64("id", "u"), F.col("parts"))), "placed")
    parts = placed.groupBy("source", "size", "part").agg(
        F.count("*").alias("m"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    run = Window.partitionBy("source", "size").orderBy("part")
    upto = F.floor(F.sum("m").over(run).cast("double") * F.col("copies") / F.col("n") + 1e-6).cast("long")
    parts = scratch.table(
        parts.withColumn("upto", upto)
        .withColumn("k", F.col("upto") - F.coalesce(F.lag("upto").over(run), F.lit(0)))
        .select(F.col("source").alias("ps"), F.col("size").alias("pz"), F.col("part").alias("pp"), "m", "k"), "parts")
    match = F.col("source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("pz")) & (F.col("part") == F.col("pp"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("id"), "id", "u")) - 1
    base = F.floor(F.col("k") / F.col("m"))
    more = F.when(rank < F.col("k") - base * F.col("m"), 1).otherwise(0)
    return (placed.drop("n", "copies").join(parts, match)
            .select("id", "u", "source", "size", (base + more).cast("long").alias("copies")))


def _plan(docs: DataFrame, spark: SparkSession, most: float) -> tuple[DataFrame, DataFrame]:
    """(rows with copies, per source) for ``docs`` of (id, u, source, size); rows that the
    caller must tell apart differ in ``u``."""
    scratch = Scratch(spark, "mix")
    docs = scratch.table(docs, "sizes")
    cells = scratch.table(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    sizes = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("words"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")).alias("second"))
    wanted = scratch.table(targets(sizes, most, scratch), "targets")
    filled = cells.where("size > 0")
    lam = solve(filled, wanted, most, scratch)
    # One row per source and size: no more rows in a source than its longest text has words.
    run = Window.partitionBy("source").orderBy(F.desc("size"))
    rate = _rate(F.col("lam"), F.col("size").cast("double"), most)
    given = scratch.table(
        filled.join(lam.select(F.col("source").alias("s"), "lam"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("upto", F.floor(F.sum(F.col("n") * rate).over(run) + 0.5).cast("long"))
        .withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(run), F.lit(0)))
        .select("source", "size", "n", "copies"), "given")
    empty = docs.where("size = 0").withColumn("copies", F.lit(1).cast("long"))
    return _dealt(docs.where("size > 0"), given, scratch).unionByName(empty), wanted


def mix(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", most: float = 3.0) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken."""
    rows, wanted = _plan(docs.select(
        F.col(id_col).alias("id"), F.lit(0).cast("long").alias("u"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size")), spark, most)
    return (rows.join(wanted.select(F.col("source").alias("s"), "words", "target"), F.col("source").eqNullSafe(F.col("s")))
            .select(F.col("id").alias(id_col), "size", F.col("words").cast("long").alias("source_size"),
                    "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def resample(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", most: float = 3.0) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (columns unchanged).

    Rows alike in every column can't be told apart: one of them stands for all of them."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    taken = {c.lower() for c in docs.columns}
    fresh = (f"_mix{i}" for i in itertools.count())  # helper columns that the table lacks
    u, v, many, place, again = itertools.islice((c for c in fresh if c not in taken), 5)
    keyed = docs.withColumn(u, F.xxhash64(*names)).withColumn(v, F.xxhash64(F.lit(1), *names))
    rows, _ = _plan(keyed.select(
        F.struct(F.col(u).alias("u"), F.col(v).alias("v")).alias("id"), F.lit(0).cast("long").alias("u"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), spark, most)
    copies = (rows.groupBy(F.col("id.u").alias(u), F.col("id.v").alias(v)).agg(F.sum("copies").cast("int").alias(many))
              .where(F.col(many) > 0))
    first = F.row_number().over(Window.partitionBy(u, v).orderBy(u))
    return (keyed.join(copies, [u, v]).withColumn(place, first).where(F.col(place) == 1)
            .withColumn(again, F.explode(F.array_repeat(F.lit(0), F.col(many))))
            .select(*names))
