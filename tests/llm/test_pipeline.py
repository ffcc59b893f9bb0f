"""Every stage of the pipeline against its operator applied by hand, on small tables."""

import corpus_pipeline as C
from pyspark.sql import functions as F

from eddy.llm import mixing, parity_join, pieces, quality_rules, toxicity
from eddy.llm.queries import QUERIES, piece_model

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda d: sorted(r[0] for r in d.select("doc_id").collect())
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if k == 0:
            judged = toxicity.judge(docs, toxicity.fit(docs, labels))
            assert ids(out) == ids(judged.where("not toxic"))
        elif k == 1:
            assert ids(out) == ids(quality_rules.judge(docs, quality_rules.fit(docs, labels)).where("kept"))
        elif k == 2:
            assert ids(out) == ids(parity_join.classes(docs, spark).where("component_id = doc_id"))
        elif k == 3:
            taken = mixing.mix(docs, spark)
            assert out.count() == taken.agg(F.sum("copies")).first()[0]
        else:
            assert ids(out) == ids(docs) and out.count() == docs.count()
            want = pieces.digests(docs, piece_model())
            assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
        docs = out


def test_registered_queries():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
