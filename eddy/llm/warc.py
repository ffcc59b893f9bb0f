"""Deterministic sharded WARC archives: write, read back.

Writing. Records are dealt to shards by ranges of (id, payload digest), whose bounds follow
the bytes, however the ids are spread; a shard is sorted by them and written as gzip
members, one per record, to files that are rolled when their compressed size reaches
``roll_bytes``; a shard holds several files. Headers, record ids and digests are regenerated from the
record alone and dates are a parameter, so a repeated run, or a second attempt of a lost
task, makes the same bytes under the same names. A file is written under a temporary name
and renamed when complete; a table of manifests (file, records, bytes, digest of the
file), itself committed by Spark, names what belongs to the archive. Readers go by the
manifests and refuse a file that differs from its entry; leftovers of lost attempts are
in none.

Equal payloads. Of the records with equal payloads of at least ``revisit_from`` bytes the
one with the largest id is stored as response, the others as revisit records that refer
to it. Payload length and digest are those of the full payload for both.

Defined cases: a null payload counts as empty; a null url leaves the target header out; a
null id comes last in its shard order and is the smallest for choosing the response; rows
alike in id and payload: the first in order of url is the response, the rest revisit it;
an empty table gives an empty archive; other columns are ignored. Payloads are held one
at a time by the tasks.

Files go through ``pyarrow.fs`` (local or shared folders, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm.scratch import Scratch

MANIFEST = "file string, records long, bytes long, sha256 string"
DATE = "2024-01-01T00:00:00Z"
BLOCKS = 1 << 16  # ranges of the order that are weighed: bounds and weights of so many are held at once
TASKS = 1 << 16   # tasks that write at most; a task may write several shards


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, given as a path or a URI."""
    return pafs.FileSystem.from_uri(uri) if urlparse(uri).scheme else (pafs.LocalFileSystem(), uri)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}/{copy}')}>"


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, copy: int,
           date: str = DATE) -> bytes:
    """One WARC 1.1 record. Extension headers carry the integer id, since ids are what
    records are told apart and referred to by."""
    digest = _digest(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(key, digest, copy)),
            ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    if key is not None:
        head.append(("X-Key", str(key)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    head.append(("WARC-Block-Digest", f"sha1:{_digest(block)}"))
    if revisit:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", record_id(refers_to, digest, 0)))
        if refers_to is not None:
            head.append(("X-Refers-To-Key", str(refers_to)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


class _Roller:
    """Writes gzip members to numbered files of one shard, each under a temporary name
    until it is complete."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.path = _store(folder)
        self.shard, self.roll, self.n, self.out = shard, roll_bytes, 0, None
        self.done: list[tuple[str, int, int, str]] = []

    def put(self, rec: bytes) -> None:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member; its header holds no time
        data = pack.compress(rec) + pack.flush()
        if self.out is not None and self.size + len(data) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.n:04d}.warc.gz"
            self.temp = f"{self.path}/.{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temp, compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temp, f"{self.path}/{self.name}")
        self.done.append((self.name, self.records, self.size, self.sha.hexdigest()))
        self.out, self.n = None, self.n + 1


def _manifests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      names=["file", "records", "bytes", "sha256"])


def write(pages: DataFrame, folder: str, spark: SparkSession, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", revisit_from: int = 0, shard_bytes: int = 32 << 20,
          roll_bytes: int = 4 << 20, blocks: int = BLOCKS) -> DataFrame:
    """Write the archive to ``folder`` (seen by all nodes); returns the table of manifests.

    ``shard_bytes`` are bytes of payload, ``roll_bytes`` compressed ones.

    Payloads move once, to their shard. What a record becomes is settled on digests; the
    rows that say so go to the same shard and are sorted in front of the records.
    """
    scratch = Scratch(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    keys = scratch.table(rows.select(
        "id", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("length")), "keys")
    equal = scratch.table(
        keys.where(F.col("length") >= revisit_from).groupBy("sha").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        .where("n > 1").select("sha", "last"), "equal")
    known = keys.join(equal, "sha").select("id", "sha", "last").distinct()
    shard, count = _shards(keys, shard_bytes, blocks)
    both = known.select("id", "sha", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                        F.lit(None).cast("binary").alias("payload"), "last").unionAll(
        rows.select("id", F.sha1("payload").alias("sha"), F.lit(1).alias("kind"), "url", "payload",
                    F.lit(None).cast("bigint").alias("last")))
    tasks = min(count, TASKS)
    dealt = (both.withColumn("shard", shard).repartitionById(tasks, F.col("shard") % tasks)
             .sortWithinPartitions("shard", F.asc_nulls_last("id"), "sha", "kind", "url")
             .select("shard", "id", "sha", "kind", "url", "payload", "last"))
    _folder(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current, last, copy, several = None, None, None, 0, False
        for b in batches:
            shard, key, sha, kind, url, _, response = (c.to_pylist() if i != 5 else None for i, c in enumerate(b.columns))
            data = b.column(5)  # payloads one at a time
            for i, (s, k, d) in enumerate(zip(shard, key, sha)):
                if out is None or out.shard != s:
                    if out is not None:
                        out.close()
                        yield _manifests(out.done)
                    out, current = _Roller(folder, s, roll_bytes), None
                if current != (k, d):
                    current, copy, several = (k, d), 0, False
                if kind[i] == 0:
                    several, last = True, response[i]
                    continue
                revisit = several and not (k == last and copy == 0)
                out.put(record(k, url[i], data[i].as_py(), last if revisit else None, revisit, copy))
                copy += 1
        if out is not None:
            out.close()
            yield _manifests(out.done)

    return scratch.table(dealt.mapInArrow(run, MANIFEST), "manifests")


def _order(id: pd.Series, none: pd.Series, sha: pd.Series) -> np.ndarray:
    """The order of records, (id, digest) with null ids (0, marked) last, as byte strings that
    compare alike: the mark, the id with its sign turned, the head of the digest."""
    mark = none.to_numpy(dtype=np.uint8).reshape(-1, 1)
    n = (id.to_numpy(dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    head = sha.to_numpy().astype("S16").view(np.uint8).reshape(-1, 16)
    return np.ascontiguousarray(np.concatenate([mark, n, head], axis=1)).view("S25").ravel()


def _shards(keys: DataFrame, shard_bytes: int, blocks: int):
    """(column that gives the shard of the rows' id and sha, number of shards).

    Bounds of about ``blocks`` ranges are keys that a hash picks from the distinct ones
    (all of them in small tables), so that each range has about as many keys, wherever the
    ids lie; ranges are weighed over all rows, and neighbouring ones join to shards of
    about ``shard_bytes``. It depends on the rows alone, so reruns agree. At most a few
    times ``blocks`` bounds and weights are held by driver and tasks, whatever the table."""
    distinct = keys.select("id", "sha").distinct()
    rate = max(1, -(-distinct.count() // blocks))
    of = (F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("none"), F.col("sha"))
    picked = distinct.where(F.pmod(F.xxhash64("id", "sha"), F.lit(rate)) == 0).select(*of).toPandas()
    spark = keys.sparkSession
    bounds = np.sort(_order(picked["id"], picked["none"], picked["sha"])) if len(picked) else np.zeros(0, "S25")
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def block(id: pd.Series, none: pd.Series, sha: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, _order(id, none, sha), side="right").astype(np.int32))

    weights = (keys.select(block(*of).alias("block"), "length").groupBy("block")
               .agg(F.sum(F.col("length") + 1).alias("w")).toPandas())
    heavy = np.zeros(len(bounds) + 1, dtype=np.int64)
    heavy[weights["block"].to_numpy(dtype=np.int64)] = weights["w"].to_numpy(dtype=np.int64)
    number = (np.cumsum(heavy) - heavy) // shard_bytes
    # numbers without a gap: a range heavier than a shard would leave some out
    table = spark.sparkContext.broadcast(np.unique(number, return_inverse=True)[1].astype(np.int32))

    @F.pandas_udf("int")
    def shard(id: pd.Series, none: pd.Series, sha: pd.Series) -> pd.Series:
        return pd.Series(table.value[np.searchsorted(shared.value, _order(id, none, sha), side="right")])

    return shard(*of), int(table.value.max()) + 1


def _folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, a gzip member each, read piece by piece."""
    unpack, parts = zlib.decompressobj(31), []
    while chunk := stream.read(size):
        while chunk:
            parts.append(unpack.decompress(chunk))
            chunk = b""
            if unpack.eof:
                yield b"".join(parts)
                chunk, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("the file ends inside a record")


def parse(rec: bytes) -> dict:
    """Headers, HTTP length and payload of one record; digests are checked."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or h["WARC-Block-Digest"] != f"sha1:{_digest(block)}":
        raise ValueError("damaged record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if h["WARC-Type"] == "response" and h["WARC-Payload-Digest"] != f"sha1:{_digest(payload)}":
        raise ValueError("damaged payload")
    return {"headers": h, "length": length, "payload": payload}


RECORD = ("id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "record_id string, payload binary")


def read(manifests: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an archive, in no order: id, url (as in the header), payload_bytes,
    payload_digest, record_type, refers_to, record_id, payload (null for revisits, and
    for all without ``payloads``)."""
    files = max(1, min(manifests.count(), 1 << 14))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        for b in batches:
            for m in b.to_pylist():
                yield from _file(fs, f"{path}/{m['file']}", m, payloads)

    return manifests.repartition(files, "file").mapInArrow(run, RECORD)


class _Hashed:
    """A stream that digests what is read from it."""

    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha256()

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.sha.update(data)
        return data


def _file(fs, path: str, manifest: dict, payloads: bool) -> Iterator[pa.RecordBatch]:
    cols: list[list] = [[] for _ in range(8)]
    held = n = 0

    def flush():
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        names = [x.split()[0] for x in RECORD.split(", ")]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        for c in cols:
            c.clear()
        return batch

    with fs.open_input_stream(path, compression=None) as raw:
        stream = _Hashed(raw)
        for rec in members(stream):
            r = parse(rec)
            h = r["headers"]
            response = h["WARC-Type"] == "response"
            row = (int(h["X-Key"]) if "X-Key" in h else None, h.get("WARC-Target-URI"), r["length"],
                   h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"],
                   int(h["X-Refers-To-Key"]) if "X-Refers-To-Key" in h else None, h["WARC-Record-ID"],
                   r["payload"] if payloads and response else None)
            for c, x in zip(cols, row):
                c.append(x)
            n, held = n + 1, held + (len(r["payload"]) if payloads else 0) + 500
            if held > 1 << 22:
                yield flush()
                held = 0
    if n != manifest["records"] or stream.sha.hexdigest() != manifest["sha256"]:
        raise ValueError(f"{path} differs from its manifest")
    if cols[0]:
        yield flush()
