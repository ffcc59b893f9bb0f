"""The corpus pipeline: toxicity, quality rules, near duplicates, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs`` with the
columns of the table documents; the last one returns the digests of the encoded texts.
``run`` writes each stage's rows below the shared checkpoint folder and reads them again
for the next stage; a table is deleted once the next one is written. Labels come from the
folder's table labels. Empty tables and nulls are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eddy.llm import mixing, parity_join, pieces, quality_rules, toxicity
from eddy.llm.queries import piece_model
from eddy.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the severity model calls toxic."""
    return toxicity.keep(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules refuse."""
    return quality_rules.keep(docs, quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return parity_join.keep_one(docs, spark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.resample(docs, spark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and digests of every row."""
    return pieces.digests(docs, piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("n-gram Jaccard join", drop_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

#: SQL can't express the models and the encoder; tests hold each stage against its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, previous = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if previous is not None:
            scratch.drop(previous)
        previous = docs
    return docs
