"""Archives: exact round trip, reruns give the same bytes, damage is noticed."""

import base64
import gzip
import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from eddy.llm import warc

ROWS = [(1, "http://a\r\nX: 1", "x"), (2, None, "x"), (None, "u", "x"), (None, "v", "y"), (None, "w", "y"), (7, "é", "z"),
        (7, "é", "z"), (8, "q", None), (9, "q", ""), (10, "long", "l" * 300_000)]


def _pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("id", F.lit(2))


def test_round_trip_and_revisits(spark, tmp_path):
    folder = str(tmp_path / "a")
    m = warc.write(_pages(spark), folder, spark, roll_bytes=600)
    assert m.count() > 1
    got = warc.read(m, folder).collect()
    b32 = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    last = {}
    for i, _, t in ROWS:
        last[t or ""] = max([x for x in (last.get(t or ""), i) if x is not None], default=None)
    assert sorted((r.id or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (i or 0, len(t or ""), b32(t)) for i, _, t in ROWS)
    for t in last:
        same = [r for r in got if r.payload_digest == b32(t)]
        assert [r.id for r in same if r.record_type == "response"] == [last[t]]
        assert all(r.refers_to == last[t] and r.payload is None for r in same if r.record_type == "revisit")
        assert bytes(next(r.payload for r in same if r.record_type == "response")).decode() == t
    every = warc.read(warc.write(_pages(spark), str(tmp_path / "b"), spark, revisit_from=2), str(tmp_path / "b"))
    assert {r.record_type for r in every.collect()} == {"response"}


def test_reruns_agree_and_members_are_gzip(spark, tmp_path):
    sums = []
    for name, d in (("a", _pages(spark)), ("b", _pages(spark).repartition(7))):
        folder = str(tmp_path / name)
        m = warc.write(d, folder, spark, shard_bytes=50_000, roll_bytes=700)
        sums.append(sorted((r.file, r.records, r.bytes, r.sha256) for r in m.collect()))
        assert sorted(f for f in os.listdir(folder) if f.endswith(".gz") and not f.startswith(".")) == [x[0] for x in sums[-1]]
        for f, *_ in sums[-1]:
            assert gzip.decompress((tmp_path / name / f).read_bytes()).startswith(b"WARC/1.1\r\n")
    assert sums[0] == sums[1]


def test_damage_and_leftovers(spark, tmp_path):
    folder = str(tmp_path / "a")
    m = warc.write(_pages(spark), folder, spark)
    (tmp_path / "a" / ".part-000000-0000.warc.gz.dead").write_bytes(b"left over")
    assert warc.read(m, folder).count() == len(ROWS)
    path = tmp_path / "a" / m.first().file
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    path.write_bytes(path.read_bytes() + pack.compress(warc.record(99, "u", b"p", None, False, 0)) + pack.flush())
    with pytest.raises(Exception, match="differs from its manifest"):
        warc.read(m, folder).collect()
    empty = warc.write(_pages(spark).limit(0), str(tmp_path / "e"), spark)
    assert empty.count() == 0 and warc.read(empty, str(tmp_path / "e")).count() == 0


def _bytes(m):
    return sorted((r.file, r.records, r.bytes, r.sha256) for r in m.collect())


def test_far_ids_and_null_ids_leave_shards_near_their_size(spark, tmp_path):
    """A third of null ids, a third of near ids and one far id: shards follow the bytes, with
    all keys as bounds and with a few picked ones, and reruns give the same files."""
    d = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("page_id"), F.lit("u").alias("url"),
                                F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512)).alias("html"))
    d = d.unionAll(spark.createDataFrame([((1 << 62) + 1, "u", "far"), (1 - (1 << 62), "u", "far below")], d.schema))
    for blocks, most in ((1 << 16, 21_000), (64, 60_000)):
        folders = [str(tmp_path / f"{blocks}-{k}") for k in range(2)]
        first, again = (warc.write(x, f, spark, shard_bytes=20_000, roll_bytes=4_000, blocks=blocks)
                        for x, f in zip((d, d.repartition(5)), folders))
        assert _bytes(first) == _bytes(again)
        shards = {}
        for r in first.collect():
            shard = r.file.split("-")[1]
            shards[shard] = shards.get(shard, 0) + r.records
        assert sum(shards.values()) == 902 and len(shards) > 230_000 // most and max(shards.values()) * 257 <= most
        assert any(r.file.endswith("-0001.warc.gz") for r in first.collect())
        assert sorted((r.id or 0, r.payload_bytes) for r in warc.read(first, folders[0]).collect()) == sorted(
            (r.page_id or 0, len(r.html)) for r in d.collect())


def test_query_rolls_files_by_compressed_size(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    files = warc.write(pages, str(tmp_path / "w"), spark).collect()
    assert any(not r.file.endswith("-0000.warc.gz") for r in files) and all(r.bytes <= 4 << 20 for r in files)
