"""Repeated ids, clashing column names and odd tables in the operators and the pipeline."""

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from eddy.llm import mixing, quality_rules, toxicity
from llm.helpers import ODD, docs


def test_resample_keeps_columns_named_like_helpers(spark):
    rows = [(i, f"word {i} " * (i % 9 + 1), "ab"[i % 2]) for i in range(60)]
    df = docs(spark, rows)
    for c in ("_u", "_v", "_copies", "_first", "_again", "_mix0", "_MIX3"):
        df = df.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    got = mixing.resample(df, spark)
    assert got.columns == df.columns
    mine = {tuple(r) for r in df.collect()}
    assert {tuple(r) for r in got.collect()} <= mine and got.count() > 0
    plain = mixing.resample(docs(spark, rows), spark)
    assert plain.count() == got.select("doc_id").count()


def test_labelled_bound_counts_rows(spark, monkeypatch):
    """One labelled id that many rows share is one labelled document."""
    words = "the quick brown fox jumps over some lazy dog and then goes home again today"
    rows = [(1, f"{words} {i}", "a") for i in range(700)] + [(i, f"{words} number {i} of many", "a") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    seen = []
    grow, fit = quality_rules.grow, toxicity._fit
    monkeypatch.setattr(quality_rules, "grow", lambda x: seen.append(len(x)) or grow(x))
    monkeypatch.setattr(toxicity, "_fit", lambda x, *rest: seen.append(len(x)) or fit(x, *rest))
    quality_rules.fit(docs(spark, rows), labels, max_labelled=30)
    toxicity.fit(docs(spark, rows), labels, max_labelled=30)
    assert seen and max(seen) <= 30


def test_pipeline_runs_on_odd_documents(spark, tmp_path):
    good = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(i, t, None, s, None) for i, t, s in [*ODD, (1, "other text of id one " * 9, "z")]],
                                "doc_id long, text string, lang string, source string, n_chars long")
    rows = good.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")).unionAll(odd)
    rows.withColumn("_u", F.lit("mine")).withColumn("n", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 10
    # Without labels nothing is toxic and only the base rules refuse: all that is left comes from the table.
    assert {r["doc_id"] for r in got.collect()} <= {r["doc_id"] for r in rows.collect()}
    (tmp_path / "none").mkdir()
    rows.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
