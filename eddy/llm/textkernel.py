"""Vectorised word and shingle hashing over Arrow string columns (numpy, inside tasks).

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, which is
``[^\\x20\\x09-\\x0D]+`` over code points, since those bytes never occur inside a longer
UTF-8 sequence. Work runs in blocks of about ``BLOCK`` bytes cut between words, so the
temporary arrays stay small however long a text is.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte but letters and digits ends a word (for features, not for contracts).
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

_powers: dict[str, np.ndarray] = {}


def _power_table(kind: str, base: int, n: int) -> np.ndarray:
    t = _powers.get(kind)
    if t is None or len(t) < n:
        size = max(1 << 12, 1 << n.bit_length())  # few texts need no table for a whole block
        t = np.full(size, base, dtype=U)
        t[0] = 1
        np.multiply.accumulate(t, out=t)
        _powers[kind] = t
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` (over a task's batches), giving back to the system at the task's end what it
    has freed: an idle worker outlives its task and would keep it."""
    def task(batches: Iterator) -> Iterator:
        if not gc.get_freeze_count():  # what the worker has loaded so far is no garbage: tasks needn't look through it
            gc.freeze()
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return task


@contextmanager
def pages_kept():
    """Arrays of a few hundred kilobytes, made and freed again and again, reuse their pages
    inside; at the end the C library is asked for its defaults and what is free goes back."""
    libc = ctypes.CDLL(None)
    tune, trim = getattr(libc, "mallopt", None), getattr(libc, "malloc_trim", None)
    if tune is not None:
        tune(-3, 32 << 20)  # from this size on a mapping of its own
        tune(-1, 64 << 20)  # free memory kept
    try:
        yield
    finally:
        if tune is not None:
            tune(-3, 128 << 10)
            tune(-1, 128 << 10)
        if trim is not None:
            trim(0)


@dataclass
class Words:
    """Words of a batch of texts. ``first[d]:first[d + 1]`` are the words of text ``d``;
    ``start`` and ``end`` are byte positions in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray | None
    heads: dict[int, np.ndarray]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n, at = len(column), column.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[at:at + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(column: pa.Array, limit: int = 4 << 20):
    """(start, stop) of runs of texts of about ``limit`` bytes (at least one text each)."""
    _, offsets = text_bytes(column)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, to
        at = to


def words(column, lower: bool = True, hashes: bool = True, gaps: np.ndarray = SPACE,
          heads: tuple[int, ...] = ()) -> Words:
    """Find (and hash) the words of every text; A-Z are lower-cased first when asked.

    ``gaps`` marks the bytes that end a word. ``heads`` asks for more hashes: of the first
    so many bytes of each word.
    """
    raw, offsets = text_bytes(column)
    n = len(raw)
    table = LOWER if lower else SAME
    starts, ends, sums = [], [], []
    more = {k: [] for k in heads}
    at = 0
    while at < n:
        stop = min(n, at + BLOCK)
        if stop < n:  # end the block at a space or at the end of a text
            while True:
                cut = np.flatnonzero(gaps[raw[stop:stop + 4096]])
                d = offsets[np.searchsorted(offsets, stop)]
                near = min([stop + int(cut[0])] if len(cut) else [n], default=n)
                if d <= near or len(cut) or stop + 4096 >= n:
                    stop = int(min(d, near))
                    break
                stop += 4096
        block = table[raw[at:stop]]
        gap = gaps[block]
        m = stop - at
        inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        head = ~gap
        tail = head.copy()
        head[1:] &= gap[:-1]
        tail[:-1] &= gap[1:]
        inner = inner[inner < m]
        head[inner] = ~gap[inner]
        before = inner[inner > 0] - 1
        tail[before] = ~gap[before]
        s = np.flatnonzero(head)
        e = np.flatnonzero(tail) + 1
        if hashes and len(s):
            up = _power_table("up", _BASE, m + 1)
            down = _power_table("down", _INV, m + 1)
            total = np.empty(m + 1, dtype=U)
            total[0] = 0
            np.cumsum((block.astype(U) + U(1)) * up[:m], out=total[1:])
            sums.append(_hash(total, down, s, e))
            for k in heads:
                more[k].append(_hash(total, down, s, np.minimum(e, s + k)) + U(k))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    h = (np.concatenate(sums) if sums else np.zeros(0, U)) if hashes else None
    rest = {k: np.concatenate(v) if v else np.zeros(0, U) for k, v in more.items()}
    return Words(raw, offsets, np.searchsorted(start, offsets), start, end, h, rest)


def _hash(total, down, s, e):
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


_SHINGLE = [U(x) for x in (0x9FB21C651E98DF25, 0xA24BAED4963EE407, 0x8CB92BA72F3D8DD7,
                           0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(h: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of the ``width``-word shingles of one word-hash sequence, in order; a
    shorter sequence counts as one shingle, an empty one has none."""
    n = len(h)
    w = min(n, width)
    if n == 0:
        return h
    k = n - w + 1
    out = np.full(k, U(w))
    for j in range(w):
        out += h[j:j + k] * (_SHINGLE[j % 5] + U(2 * (j // 5)))
    return mix(out)
