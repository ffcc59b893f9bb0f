"""Byte-level BPE by overlapping chunks, against the public library."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF001
from llm.helpers import ODD, docs

from eddy.llm import byte_pieces as B
from eddy.llm.queries import QUERIES, byte_ranks

PATH = byte_ranks()


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def long_texts():
    """Texts that are hard to cut: contractions, runs of spaces, letters and signs, scripts."""
    rng = random.Random(3)
    parts = ["'re", "'l", "ll", " ", "  ", "\n", "\n\n \n", "\t", "we", " don't", "1234", " 56", "!?", " <|endoftext|>", "é", "日本語の文章", "🎉👍🏽",
             "　", "\x00", "́", "'", " '", "a" * 30]
    out = ["".join(rng.choices(parts, k=rng.randint(200, 500))) for _ in range(40)]
    return [*out, "x" * 900, "x" * 500 + " " + "y" * 700 + " end", " " * 600, "ab " * 300 + "q" * 400 + " we're " * 100,
            "\n" + " " * 500 + "\n tail"]


def test_encoder_equals_library(library):
    e = B.Encoder(PATH, P.PATTERN)
    for text in [*long_texts(), "".join(map(chr, range(0x20, 0x2000))), "Zürich naïve " * 3, "a" * 3000]:
        ids, ends = e.encode([text, None, text])
        assert ids.tolist() == library.encode_ordinary(text) * 2
        assert ends.tolist() == [0, len(ids) // 2, len(ids) // 2, len(ids)]
    assert e.encode([])[0].tolist() == []
    every = "".join(rf"{a}{b} {c}x" for a in "a'\n \x1c\u3000\x85" for b in "z \x1f\t'" for c in " \x1d\u2028é\n's")
    assert e.encode([every])[0].tolist() == library.encode_ordinary(every)


@pytest.mark.parametrize("chunk,overlap", [(64, 32), (50, 7), (1000, 100)])
def test_chunks_are_stitched(spark, library, chunk, overlap):
    rows = [(i, t, "s") for i, t in enumerate(long_texts())]
    rows += [(1, "another text of id one", "s"), (None, long_texts()[2], "s"), (0, long_texts()[0], "s"), (0, long_texts()[0], "s")]
    got = B.encode(docs(spark, rows), PATH, P.PATTERN, spark, chunk=chunk, overlap=overlap).collect()
    want = [(i, library.encode_ordinary(t)) for i, t, _ in rows]
    assert sorted([(r["doc_id"], list(r["ids"])) for r in got], key=str) == sorted(want, key=str)


def test_most_texts_resynchronise(spark):
    texts = docs(spark, [(i, t, "s") for i, t in enumerate(long_texts()[:40])]).selectExpr("doc_id row", "doc_id id", "text")
    chunks = B.borders(B.cut(texts, 256, 64), P.PATTERN, 256, 64)
    per = [r["n"] for r in B.stitched(chunks, 256).groupBy("row").count().selectExpr("count n").collect()]
    assert len(per) == 40 and sum(per) > 3 * 40


def test_odd_rows_and_round_trip(spark, library):
    df = docs(spark, [*ODD, (9, "<|endoftext|>", "a"), (10, "long " * 20000, "a")])
    tokens = B.encode(df, PATH, P.PATTERN, spark)
    got = B.decode(tokens, PATH).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in [*ODD, (9, "<|endoftext|>", 0), (10, "long " * 20000, 0)]]
    assert sorted([(r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in got], key=str) == sorted(want, key=str)
    assert B.encode(docs(spark, []), PATH, P.PATTERN, spark).collect() == []
    bad = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r["decoded"]) for r in B.decode(bad, PATH).collect()} == {b""}


def test_query(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op13_byte_pieces"](spark, SF001).collect()}
    texts = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        ids = library.encode_ordinary(r["text"] or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((r["text"] or "").encode()).hexdigest())
        x = got[r["doc_id"]]
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == want
