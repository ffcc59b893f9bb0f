"""Byte-level BPE by overlapping chunks.

A long text is cut into chunks that overlap, the chunks are dealt out over the cluster and
split into pre-tokens at the same time. A chunk that starts inside a pre-token is wrong at
first; the matches of the pattern depend only on where the last one ended, so from the
first border that two neighbours share in their overlap on they agree. There the chunks
are stitched (DataFrame functions on the borders inside the overlaps), each stitched piece
is encoded on its own, and a text's ids are the pieces' ids in order. Where an overlap
holds no common border (a run of letters longer than it), the rest of that text from the
last stitch on is one piece. Texts of one chunk skip the stitching.

A match is trusted when it ends ``LOOKAHEAD`` characters before the chunk does: every
alternative of the supplied pattern is a run of one class of characters, which is seen to
end, or has three characters at most. A pre-token is encoded as a whole if the vocabulary
has it, else by merges of the pair of least rank, the leftmost first. Distinct
pre-tokens of a batch are merged together (numpy) and kept in a bounded cache of the worker.

Defined cases: a null text counts as empty and has no ids; null ids and repeated rows pass
row by row; an empty table gives no rows; columns other than the id and the text are
ignored. Characters that no match of the pattern covers have no ids. Decoding joins the
bytes of the ids; null ids give no bytes, an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm import pieces
from eddy.llm import textkernel as K
from eddy.llm.scratch import Scratch

#: Characters of a chunk without its overlap, and of the overlap with the next one.
CHUNK, OVERLAP = 32_768, 512
LOOKAHEAD = 4
_CACHE = 300_000


class Ranks:
    """A rank file: bytes -> id, and back."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {i: b for b, i in self.of.items()}


class Merger(pieces.Model):
    """Merges of the pair of least rank, with the piece encoder's code for many runs at
    once: byte x stands as character x, a symbol is an id and its rank."""

    def __init__(self, ranks: Ranks):
        of = ranks.of
        self.pieces = range(max(ranks.bytes) + 1)  # every symbol is final
        self.symbol = {chr(x).encode(): of[bytes([x])] for x in range(256)}
        self.symbol_bytes = [len(ranks.bytes.get(i, b"").decode("latin-1").encode()) for i in self.pieces]
        pair, to = array("q"), array("i")
        for b, i in of.items():
            for cut in range(1, len(b)):
                left, right = of.get(b[:cut]), of.get(b[cut:])
                if left is not None and right is not None:
                    pair.append(left << 20 | right)
                    to.append(i)
        self._pair_tables(pair, to, to)

    def merged(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of the pre-tokens, by merges alone."""
        first, ids, _ = self.merge_many([t.decode("latin-1").encode() for t in tokens])
        return ids, first


class _Known(dict):
    """Pre-token -> its place; one not seen before gets the next place and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, token: str) -> int:
        self[token] = at = len(self)
        self.fresh.append(token)
        return at


class Encoder:
    """Encodes texts with one vocabulary, keeping the pre-tokens seen before."""

    def __init__(self, path: str, pattern: str):
        ranks = Ranks(path)
        self.of, self.merger = ranks.of, Merger(ranks)
        self.split = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        """Drop the kept pre-tokens: a worker outlives its task."""
        self.known = _Known()
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.first = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts in order, text i's at ``first[i]:first[i + 1]``."""
        if len(self.known) > _CACHE:
            self.forget()
        place, at, stops = self.known.__getitem__, array("q"), [0]
        for text in texts:
            if text:
                at.extend(map(place, self.split.findall(text)))
            stops.append(len(at))
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        at = np.asarray(at)
        length = self.first[at + 1] - self.first[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        pick = np.arange(ends[-1]) + np.repeat(self.first[at] - ends[:-1], length)
        return self.ids[pick], ends[stops]

    def _learn(self, tokens: list[str]) -> None:
        raw = [t.encode() for t in tokens]
        whole = np.array([self.of.get(b, -1) for b in raw], dtype=np.int32)
        rest = np.flatnonzero(whole < 0)
        ids, first = self.merger.merged([raw[i] for i in rest])
        count = np.ones(len(tokens), dtype=np.int64)
        count[rest] = np.diff(first)
        start = self.first[-1] + np.cumsum(count) - count
        total = int(start[-1] + count[-1])
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[start[whole >= 0]] = whole[whole >= 0]
        self.ids[np.arange(len(ids)) + np.repeat(start[rest] - first[:-1], count[rest])] = ids
        self.first = np.concatenate([self.first, start + count])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file (which every node holds at this path)."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def _lists(ends: list[int], flat: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(np.array([0, *ends], dtype=np.int32), np.concatenate([np.zeros(0, np.int32), *flat]))


def _encoded(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``df`` (any columns, then ``text``) with ``ids`` in place of the text; every text is
    a whole one or a stitched piece."""
    head = [f for f in df.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            text = b.column(b.num_columns - 1)
            for at, to in K.parts(text, 2 << 20):
                ids, ends = e.encode(text.slice(at, to - at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(at, to - at) for i in range(b.num_columns - 1)), _lists(ends[1:], [ids])],
                    names=[*(f.name for f in head), "ids"])
        e.forget()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in head), "ids array<int>"])
    return df.select(*(f.name for f in head), "text").mapInArrow(K.trimmed(run), schema)


def cut(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, id, chunk, last, text): the overlapping chunks of the texts of (row, id, text)."""
    kind = long.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(2)[i].as_py()
                n = max(1, -(-len(text) // chunk))
                for at in range(0, n, 64):  # 64 chunks at a time
                    ks = range(at, min(n, at + 64))
                    same = lambda c: pa.array([b.column(c)[i].as_py()] * len(ks), b.column(c).type)
                    yield pa.RecordBatch.from_arrays(
                        [same(0), same(1), pa.array(ks, pa.int32()), pa.array([k == n - 1 for k in ks]),
                         pa.array([text[k * chunk:(k + 1) * chunk + overlap] for k in ks], pa.string())],
                        names=["row", "id", "chunk", "last", "text"])

    return long.select("row", "id", "text").mapInArrow(run, f"row long, id {kind}, chunk int, last boolean, text string")


def borders(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``chunks`` with head (borders of pre-tokens in the overlap with the chunk before) and
    tail (trusted ones in the overlap with the next chunk), counted from the overlap's start."""
    kind = chunks.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for b in batches:
            head, tail = [], []
            for text in b.column(4).to_pylist():
                tokens = split.findall(text)
                at = np.cumsum([0, *map(len, tokens)])
                if at[-1] != len(text):  # some characters are covered by no match
                    spans = [m.span() for m in split.finditer(text)]
                    at = np.array([0, *(x for s in spans for x in s)] if spans else [0])
                at = np.unique(at)
                head.append(at[at <= overlap].astype(np.int32))
                at = at[(at >= chunk) & (at <= len(text) - LOOKAHEAD)]
                tail.append((at - chunk).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(_lists(np.cumsum([len(x) for x in c]), c) for c in (head, tail))],
                names=["row", "id", "chunk", "last", "text", "head", "tail"])

    return chunks.mapInArrow(
        run, f"row long, id {kind}, chunk int, last boolean, text string, head array<int>, tail array<int>")


def stitched(chunks: DataFrame, chunk: int) -> DataFrame:
    """(row, id, piece, text): the pieces between stitches, from the chunks with their borders."""
    line = Window.partitionBy("row").orderBy("chunk")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(line)))
    plan = (chunks.select("row", "chunk", "last", "head", "tail").withColumn("meet", meet)
            .withColumn("lost", F.min(F.when(F.col("meet").isNull() & ~F.col("last"), F.col("chunk"))).over(
                Window.partitionBy("row")))
            .withColumn("begin", F.coalesce(F.lag("meet").over(line), F.lit(0)))
            .select("row", "chunk", "lost", "begin", "meet"))
    lost = F.coalesce(F.col("lost"), F.lit(2 ** 31 - 1))
    begin = F.when(F.col("chunk") <= lost, F.col("begin")).otherwise(0)
    end = F.when(F.col("last"), F.length("text")).when(F.col("chunk") < lost, F.col("meet") + chunk).otherwise(chunk)
    parts = (chunks.select("row", "id", "chunk", "last", "text").join(plan, ["row", "chunk"])
             .select("row", "id", "chunk", F.least("chunk", lost).alias("piece"), (F.col("chunk") >= lost).alias("rest"),
                     F.col("text").substr(begin + 1, end - begin).alias("text")))
    rest = (parts.where("rest").groupBy("row", "piece")
            .agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("chunk", "text"))).alias("all"))
            .select("row", "id", "piece", F.array_join(F.col("all.text"), "").alias("text")))
    return parts.where("not rest").select("row", "id", "piece", "text").unionByName(rest)


def encode(docs: DataFrame, path: str, pattern: str, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """id, ids: the ids of every row's text by the ranks in ``path``, each match of
    ``pattern`` on its own."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = _encoded(rows.where(F.length("text") <= chunk), path, pattern)
    scratch = Scratch(spark, "bytes")
    long = rows.where(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    chunks = scratch.table(
        borders(cut(long, chunk, overlap).repartition("row", "chunk"), pattern, chunk, overlap), "chunks")
    whole = (_encoded(stitched(chunks, chunk), path, pattern).groupBy("row")
             .agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("all"))
             .select("id", F.flatten(F.col("all.ids")).alias("ids")))
    return short.unionByName(whole).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``tokens`` with a column ``name``: the bytes of the ids, joined."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields), f"`{name}` binary"])
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Ranks(path).bytes.__getitem__
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                lists = part.column(at).fill_null([]) if part.column(at).null_count else part.column(at)
                flat, first = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                out = [b"".join(map(of, flat[x:y].tolist())) for x, y in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*b.schema.names, name])

    return tokens.mapInArrow(run, schema)


def digests(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""
    return decode(tokens, path).select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
