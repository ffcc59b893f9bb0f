"""Text files and message logs as sources, in batch and on streams."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eddy.operators import text as X
from eddy.plans import queries as Q
from eddy.schemas import AUCTION_MSG
from eddy.sources import bindings as B
from eddy.sources import messages as M
from eddy.sources import text_files as T
from eddy.streaming import queries as SQ
from eddy.streaming.runner import run_foreach_batch, run_to_memory
from eddy.streaming.sinks import latest_snapshot, upsert_writer


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The documents' lines in three files, one of them much longer than a split."""
    folder = str(tmp_path_factory.mktemp("text"))
    texts = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    parts = [texts[:5], texts[5:6], texts[6:]]
    for i, part in enumerate(parts):
        with open(os.path.join(folder, f"{i}.txt"), "w", newline="") as f:
            f.write("\n".join(t or "" for t in part))
    return folder, ["\n".join(t or "" for t in part) for part in parts]


def _split(text):
    """Lines as a text file has them: a carriage return before a newline belongs to it."""
    out = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return out[:-1] if out[-1] == "" else out


@pytest.mark.parametrize("split", ["4k", "37k", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, files, split):
    folder, texts = files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = T.lines(spark, folder)
        got = sorted((os.path.basename(r["path"]), r["line_no"], r["value"]) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(f"{i}.txt", n, v) for i, t in enumerate(texts) for n, v in enumerate(_split(t), 1)]


def test_word_count_from_files_equals_table(spark, files):
    folder, _ = files
    want = _rows(Q.word_count(spark, SF001))
    assert _rows(X.word_count(X.tokens(T.lines(spark, folder), "value", ("path", "line_no")))) == want
    stream = X.tokens(T.lines_stream(spark, folder, 1), "value", ("path",))
    changes = run_to_memory(SQ.word_count_stream(stream), "files_words", mode="update")
    assert _rows(changes.groupBy("word").agg(F.max("n").alias("n"))) == want


def test_message_stream_with_quarantine_equals_batch(spark, tmp_path):
    """Files of messages, some broken, through decode and the upsert sink."""
    auctions = B.auctions_q3(spark, SF001)
    fields = [f.name for f in AUCTION_MSG.fields]
    good = M.encode(auctions, "id", fields)
    n = good.count()
    bad = spark.createDataFrame([(b"1", None), (b"2", b""), (b"x", b'{"id": 1}'), (b"3", b"{broken"), (b"4", b'{"id": "no number"}'),
                                 (b"5", b"[1, 2")], "key binary, value binary")
    folder, snap, hospital = (str(tmp_path / x) for x in ("log", "snap", "bad"))
    good.unionAll(bad).repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(good.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    writer = M.sorted_out(upsert_writer(snap, ["seller"], ["id"]), hospital)
    run_foreach_batch(M.decode_checked(stream, AUCTION_MSG), writer, str(tmp_path / "ck"), mode="append")
    broken = spark.read.parquet(hospital)
    assert sorted((r["broken"], r["key"].decode()) for r in broken.collect()) == [
        ("key", "x"), ("no value", "1"), ("no value", "2"), ("value", "3"), ("value", "4"), ("value", "5")]
    checked = M.decode_checked(good.unionAll(bad), AUCTION_MSG)
    assert checked.where("broken is null").count() == n and checked.count() == n + broken.count()
    want = auctions.groupBy("seller").agg(F.max("id").alias("id"))
    assert _rows(latest_snapshot(spark, snap).select("seller", "id")) == _rows(want)
