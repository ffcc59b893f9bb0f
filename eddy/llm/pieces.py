"""SentencePiece (BPE with byte fallback) encoding that keeps source offsets.

A text is normalised by the longest prefix that the model's compiled character map knows
(a double-array trie over UTF-8), and every normalised byte records the source byte it
came from. Pieces are byte-pair merges over the normalised text; their borders, looked up
in that record, give each piece its span of bytes in the original text.

Merges never cross from a character to a space symbol when no piece does (checked when
the model is read), so the text falls apart into runs "spaces and one word". Distinct
runs are encoded once per batch, many at a time (numpy), and kept by their 64-bit hash in
a bounded cache of the worker; long runs and texts that hold the space symbol itself are
encoded singly by a heap.

Defined cases: a null text counts as empty and gives the begin and end ids alone; null
ids and repeated rows pass through row by row; an empty table gives no rows; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm import textkernel as K

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_ONLY_SPACE = np.zeros(256, dtype=bool)
_ONLY_SPACE[0x20] = True
_NONE = np.int32(1 << 30)
_CACHE = 400_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        if x < 128:
            return value, i
        shift += 7


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialised protocol buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = b[i:i + n], i + n
        yield tag >> 3, value


class CharMap:
    """The compiled character map: a double-array trie, then the replacements."""

    def __init__(self, blob: bytes):
        n = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{n // 4}I", blob, 4) if n else ()
        self.pool = blob[4 + n:]

    def longest(self, b: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest key that ``b`` has at ``at``."""
        if not self.units:
            return None
        units, found, node = self.units, None, 0
        node ^= _offset(units[0])
        for i in range(at, len(b)):
            node ^= b[i]
            unit = units[node]
            if unit & 0x800000FF != b[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.pool[found[1]:self.pool.index(b"\0", found[1])]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


def _char_length(first: int) -> int:
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


@dataclass
class Model:
    """A piece model read from its file, with the tables the encoder uses."""

    path: str
    pieces: list[bytes] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    charmap: CharMap = field(default_factory=lambda: CharMap(b""))
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    def __post_init__(self):
        with open(self.path, "rb") as f:
            raw = f.read()
        trainer = {}
        for number, value in _fields(raw):
            if number == 1:
                x = dict(_fields(value))
                self.pieces.append(x.get(1, b""))
                self.scores.append(struct.unpack("<f", x[2])[0] if 2 in x else 0.0)
                self.kinds.append(x.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                x = dict(_fields(value))
                self.charmap = CharMap(x.get(2, b""))
                self.dummy_prefix, self.trim, self.escape = (bool(x.get(k, 1)) for k in (3, 4, 5))
        if trainer.get(3) != 2:
            raise ValueError("only byte-pair models are supported")
        if USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.bos, self.eos = self.pieces.index(b"<s>"), self.pieces.index(b"</s>")
        self.unk = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        space = SPACE.encode()
        self.splits = not any(space in p[len(space) if p.startswith(space) else 1:].lstrip(space) for p in self.ids)
        self._tables()

    def _tables(self) -> None:
        """Pair -> (rank, merged symbol). Symbols are piece ids; characters that are no
        piece of their own follow as further symbols when a piece holds them."""
        self.symbol = dict(self.ids)
        self.symbol_bytes = [len(p) for p in self.pieces]
        self.letters: dict[int, bytes] = {}  # characters of pieces that are no piece
        for p in self.ids:
            for c in p.decode():
                b = c.encode()
                if b not in self.symbol:
                    self.symbol[b] = len(self.symbol_bytes)
                    self.letters[len(self.symbol_bytes)] = b
                    self.symbol_bytes.append(len(b))
        order = sorted({self.scores[i] for i in self.ids.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        pair, ranks, to = array("q"), array("i"), array("i")
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                left, right = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if left is not None and right is not None:
                    pair.append(left << 20 | right)
                    ranks.append(rank[self.scores[i]])
                    to.append(i)
        self._pair_tables(pair, ranks, to)

    def _pair_tables(self, pair: array, ranks: array, to: array) -> None:
        """Sorted pairs with their ranks and what they merge to: arrays, for every worker
        holds them."""
        order = np.argsort(np.asarray(pair))
        self.pair, self.pair_rank, self.pair_to = (np.asarray(x)[order] for x in (pair, ranks, to))
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[_slot(self.pair)] = True
        self.merge = _Merges(self.pair, self.pair_rank, self.pair_to)

    # Normalisation -----------------------------------------------------------------

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and for the end, the source position."""
        space, out, source = (SPACE.encode() if self.escape else b" "), [], []

        def put(b: bytes, at: int) -> None:
            out.append(b)
            source.extend([at] * len(b))

        at, end = 0, len(text)
        if not self.charmap.units and not self.trim and self.escape:  # identity: whole arrays
            return self._identity(text)
        chunks = []
        while at < end:
            hit = self.charmap.longest(text, at)
            n, new = hit if hit else (_char_length(text[at]), text[at:at + _char_length(text[at])])
            chunks.append((at, at + n, new))
            at += n
        if self.trim:
            while chunks and chunks[0][2].strip(b" ") == b"":
                chunks.pop(0)
        if not chunks:
            return b"", np.array([end])
        if self.dummy_prefix:
            put(space, chunks[0][0])
        after_space = self.trim
        for start, _, new in chunks:
            if after_space:
                new = new.lstrip(b" ")
            if new:
                for i in range(len(new)):
                    put(space if new[i:i + 1] == b" " else new[i:i + 1], start)
                after_space = self.trim and new.endswith(b" ")
        stop = chunks[-1][1]
        result = b"".join(out)
        if self.trim:
            while result.endswith(space):
                result = result[:-len(space)]
                stop = source[len(result)]
        return result, np.array([*source[:len(result)], stop])

    def _identity(self, text: bytes) -> tuple[bytes, np.ndarray]:
        src = np.frombuffer(text, dtype=np.uint8)
        if not len(src):
            return b"", np.zeros(1, dtype=np.int64)
        times = np.where(src == 0x20, 3, 1)
        head = 3 if self.dummy_prefix else 0
        source = np.concatenate([np.zeros(head, np.int64), np.repeat(np.arange(len(src)), times), [len(src)]])
        result = (SPACE.encode() if head else b"") + text.replace(b" ", SPACE.encode())
        return result, source

    # Merging -----------------------------------------------------------------------

    def merge_one(self, run: bytes) -> list[tuple[int, int]]:
        """(id, normalised bytes) of the pieces of one run, by a heap of merges."""
        chars = [c.encode() for c in run.decode()]
        sym = [self.symbol.get(c, -1) for c in chars]
        size = [len(c) for c in chars]
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and sym[i] >= 0 and sym[j] >= 0:
                got = self.merge.get(sym[i] << 20 | sym[j])
                if got:
                    heapq.heappush(heap, (got[0], i, sym[i], sym[j], got[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, left, right, to = heapq.heappop(heap)
            j = after[i]
            if j < 0 or size[i] == 0 or sym[i] != left or sym[j] != right:
                continue
            sym[i], size[i] = to, size[i] + size[j]
            size[j] = 0
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        out, at = [], 0
        for i in range(n):
            if size[i]:
                out += self._final(sym[i], run[at:at + size[i]])
                at += size[i]
        return out

    def _final(self, symbol: int, b: bytes) -> list[tuple[int, int]]:
        """A symbol's pieces; a character that is no piece falls back to its bytes, the
        last of which carries the whole length."""
        if 0 <= symbol < len(self.pieces):
            return [(symbol, len(b))]
        if len(self.bytes) < 256:
            return [(self.unk, len(b))]
        return [(self.bytes[x], len(b) if i == len(b) - 1 else 0) for i, x in enumerate(b)]

    def merge_many(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``merge_one`` of many runs, one merge in every run at a time: (first, ids,
        sizes), the pieces of run i at ``first[i]:first[i + 1]``."""
        texts = [r.decode() for r in runs]
        length = np.array([len(t) for t in texts])
        count = np.zeros(len(runs), dtype=np.int64)
        groups, single = [], {}
        for low, high in ((0, 8), (8, 16), (16, 32)):
            group = np.flatnonzero((length > low) & (length <= high))
            if len(group):
                row, ids, size = self._finals(self._merge_group([texts[i] for i in group], length[group], high))
                count[group] = np.bincount(row, minlength=len(group))
                groups.append((group, ids, size))
        for i in np.flatnonzero(length > 32):
            single[i] = self.merge_one(runs[i])
        for i, pieces in single.items():
            count[i] = len(pieces)
        first = np.concatenate([[0], np.cumsum(count)])
        ids, sizes = np.zeros(first[-1], np.int32), np.zeros(first[-1], np.int32)
        for group, sym, size in groups:
            n = count[group]
            to = np.arange(len(sym)) + np.repeat(first[group] - np.cumsum(n) + n, n)
            ids[to], sizes[to] = sym, size
        for i, pieces in single.items():
            if pieces:
                ids[first[i]:first[i + 1]], sizes[first[i]:first[i + 1]] = np.array(pieces).T
        return first, ids, sizes

    def _finals(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, bytes) of the pieces of the symbols that ``_merge_group`` leaves, in
        order: as ``_final`` gives them, looked up once per kind of symbol."""
        on = sym != -1
        row, left = np.nonzero(on)[0], sym[on]
        kinds, back = np.unique(left, return_inverse=True)
        finals = [self._final(k, b"\0" * self.symbol_bytes[k]) if 0 <= k < len(self.pieces) else
                  self._final(-1, chr(-2 - k).encode() if k < 0 else self.letters[k]) for k in kinds.tolist()]
        n = np.array([len(f) for f in finals], dtype=np.int64)
        flat = np.array([p for f in finals for p in f], dtype=np.int32).reshape(-1, 2)
        many = n[back]
        pick = np.arange(many.sum()) + np.repeat((np.cumsum(n) - n)[back] - np.cumsum(many) + many, many)
        return np.repeat(row, many), flat[pick, 0], flat[pick, 1]

    def _merge_group(self, texts: list[str], length: np.ndarray, width: int) -> np.ndarray:
        """Symbols left after all merges, a row per run: -1 after the last, -2 less its
        code point for a character that the model lacks."""
        n = len(texts)
        chars = np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(n, width)
        kinds, back = np.unique(chars, return_inverse=True)
        of = np.array([self.symbol.get(chr(c).encode(), -2 - c) if c else -1 for c in kinds.tolist()], dtype=np.int64)
        sym = of[back].reshape(n, width)
        sym[(np.arange(width) < length[:, None]) & (sym == -1)] = self.symbol.get(b"\0", -2)
        rank, to = self._pairs(sym[:, :-1], sym[:, 1:])
        live = np.arange(n)
        place = np.arange(width)
        while len(live):
            r = rank[live]
            j = r.argmin(axis=1)
            on = r[np.arange(len(live)), j] < _NONE
            live, j = live[on], j[on]
            if not len(live):
                break
            s = sym[live]
            s[np.arange(len(live)), j] = to[live, j]
            s = np.take_along_axis(s, np.minimum(place + (place > j[:, None]), width - 1), axis=1)
            s[:, -1] = -1
            sym[live] = s
            # Pairs behind the merge move up; the two that touch it are looked up anew.
            shift = np.minimum(place[:-1] + (place[:-1] > j[:, None]), width - 2)
            rl, tl = np.take_along_axis(rank[live], shift, axis=1), np.take_along_axis(to[live], shift, axis=1)
            rl[:, -1] = _NONE
            for at in (j - 1, j):
                ok = np.flatnonzero((at >= 0) & (at < width - 1))
                a = at[ok]
                rl[ok, a], tl[ok, a] = self._pairs(s[ok, a], s[ok, a + 1])
            rank[live], to[live] = rl, tl
        return sym

    def _pairs(self, left: np.ndarray, right: np.ndarray):
        key = (left << 20 | (right & 0xFFFFF))
        rank = np.full(key.shape, _NONE, dtype=np.int32)
        to = np.zeros(key.shape, dtype=np.int64)
        maybe = (left >= 0) & (right >= 0)
        maybe &= self.maybe[_slot(key)]
        at = np.nonzero(maybe)
        want = key[at]
        i = np.minimum(np.searchsorted(self.pair, want), len(self.pair) - 1)
        same = self.pair[i] == want
        at = tuple(x[same] for x in at)
        rank[at], to[at] = self.pair_rank[i[same]], self.pair_to[i[same]]
        return rank, to


class _Merges:
    """Pair -> (rank, merged symbol), by search in the sorted pairs (as buffers: an array's
    call for one number costs more than the search)."""

    def __init__(self, pair: np.ndarray, rank: np.ndarray, to: np.ndarray):
        self.pair, self.rank, self.to = (memoryview(np.ascontiguousarray(x)) for x in (pair, rank, to))

    def get(self, pair: int) -> tuple[int, int] | None:
        i = bisect_left(self.pair, pair)
        return (self.rank[i], self.to[i]) if i < len(self.pair) and self.pair[i] == pair else None


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key * np.int64(-7046029254386353131)) >> 42) & np.int64((1 << 22) - 1)


class Encoder:
    """Encodes batches of texts with one model, keeping the pieces of seen runs."""

    def __init__(self, model: Model):
        self.model = model
        self.fast = model.splits and not model.charmap.units and not model.trim and model.escape
        self._reset()

    def forget(self) -> None:
        """Drop the kept runs: a worker outlives its task, and what follows needs the memory."""
        self._reset()

    def _reset(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.sizes = np.zeros(1 << 16, dtype=np.int32)
        self.first = [0]

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begin, end) per text, without begin and end ids; spans are source bytes."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        for at, to in K.parts(column):
            yield from self._part(column.slice(at, to - at))

    def _part(self, column: pa.Array):
        m = self.model
        data, offsets = K.text_bytes(column)
        single = {}
        for d in range(len(column)):
            raw = None
            if not self.fast or data[offsets[d]:offsets[d + 1]].tobytes().find(SPACE.encode()) >= 0:
                raw = data[offsets[d]:offsets[d + 1]].tobytes()
            if raw is not None:
                norm, source = m.normalise(raw)
                single[d] = (m.merge_one(norm), source)
        w = K.words(column, lower=False, gaps=_ONLY_SPACE)
        # Runs: the spaces before a word (and the dummy one before the text), the word.
        n = len(column)
        counts = np.diff(w.first)
        doc = np.repeat(np.arange(n), counts)
        previous = np.empty(len(w.start), dtype=np.int64)
        previous[1:] = w.end[:-1]
        heads = w.first[:-1][counts > 0]
        previous[heads] = offsets[:-1][counts > 0]
        spaces = w.start - previous
        if m.dummy_prefix:
            spaces[heads] += 1
        last = offsets[:-1].copy()
        last[counts > 0] = w.end[w.first[1:][counts > 0] - 1]
        tail = offsets[1:] - last
        if m.dummy_prefix:
            tail += (counts == 0) & (offsets[1:] > offsets[:-1])
        trailing = np.flatnonzero(tail > 0)
        doc = np.concatenate([doc, trailing])
        order = np.argsort(doc, kind="stable")
        key = np.concatenate([w.hash, np.zeros(len(trailing), K.U)])
        gaps = np.concatenate([spaces, tail[trailing]])
        begin = np.concatenate([w.start, offsets[1:][trailing]])
        end = np.concatenate([w.end, offsets[1:][trailing]])
        key = K.mix(key + gaps.astype(K.U) * K.U(0x9E3779B97F4A7C15))
        keys, at, back = np.unique(key, return_index=True, return_inverse=True)
        raw, mark = w.data.tobytes(), SPACE.encode()
        before, low, high = gaps[at].tolist(), begin[at].tolist(), end[at].tolist()
        run = self._runs(keys, lambda i: mark * before[i] + raw[low[i]:high[i]])
        first = np.array(self.first)
        run = run[back[order]]
        length = (first[run + 1] - first[run])
        total = np.concatenate([[0], np.cumsum(length)])
        pick = np.arange(total[-1]) + np.repeat(first[run] - total[:-1], length)
        ids, sizes = self.ids[pick], self.sizes[pick]
        of_doc = np.concatenate([[0], np.cumsum(np.bincount(doc[order], minlength=n))])
        for d in range(n):
            if d in single:
                pieces, source = single[d]
                got = np.array([p[0] for p in pieces], dtype=np.int32)
                edge = np.concatenate([[0], np.cumsum([p[1] for p in pieces], dtype=np.int64)]).astype(np.int64)
            else:
                a, b = total[of_doc[d]], total[of_doc[d + 1]]
                got = ids[a:b]
                edge = np.concatenate([[0], np.cumsum(sizes[a:b])])
                _, source = m.normalise(data[offsets[d]:offsets[d + 1]].tobytes())
            yield got, source[edge[:-1]], source[edge[1:]]

    def _runs(self, keys: np.ndarray, text) -> np.ndarray:
        """Cache positions of the runs, encoding those not seen yet."""
        if len(self.known) > _CACHE:
            self._reset()
        wanted = keys.tolist()
        fresh = [i for i, k in enumerate(wanted) if k not in self.known]
        if fresh:
            first, ids, sizes = self.model.merge_many([text(i) for i in fresh])
            at = self.first[-1]
            while at + len(ids) > len(self.ids):
                self.ids, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ids, self.sizes))
            self.ids[at:at + len(ids)], self.sizes[at:at + len(ids)] = ids, sizes
            for j, i in enumerate(fresh):
                self.known[wanted[i]] = len(self.first) - 1 + j
            self.first += (first[1:] + at).tolist()
        return np.array([self.known[k] for k in wanted], dtype=np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a model file (which every node holds at this path)."""
    if path not in _encoders:
        _encoders[path] = Encoder(Model(path))
    return _encoders[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (with begin and end ids), begin, end: source byte spans of the pieces
    (0, 0 for the begin id; n, n for the end id). One row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            cols = ([], [], [])
            size = np.diff(K.text_bytes(b.column(1))[1])
            for d, (ids, begin, end) in enumerate(e.encode(b.column(1))):
                for c, x, edge in zip(cols, (ids, begin, end), ((e.model.bos, e.model.eos), (0, size[d]), (0, size[d]))):
                    c.append(np.concatenate([edge[:1], x, edge[1:]]).astype(np.int32))
            ends = np.cumsum([0, *(len(x) for x in cols[0])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *c])) for c in cols)],
                names=["id", "ids", "begin", "end"])
        e.forget()

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return (picked.mapInArrow(K.trimmed(run), f"id {kind}, ids array<int>, begin array<int>, end array<int>")
            .withColumnRenamed("id", id_col))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``encode`` gives, reduced to digests in the same task: id, n_tokens,
    ids_sha256, decoded_sha256 (of the library's ``decode(ids)``), span_bytes (source
    bytes that the spans cover)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        e = encoder(path)
        decoder = sentencepiece.SentencePieceProcessor(model_file=path)
        for b in batches:
            n, sha, text, covered = [], [], [], []
            for ids, begin, end in e.encode(b.column(1)):
                whole = np.concatenate([[e.model.bos], ids, [e.model.eos]]).astype("<u4")
                n.append(len(whole))
                sha.append(hashlib.sha256(whole.tobytes()).hexdigest())
                text.append(hashlib.sha256(decoder.decode(whole.tolist()).encode()).hexdigest())
                covered.append(int((end - begin).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(text, pa.string()),
                 pa.array(covered, pa.int64())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"])
        e.forget()

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return (picked.mapInArrow(K.trimmed(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long")
            .withColumnRenamed("id", id_col))
