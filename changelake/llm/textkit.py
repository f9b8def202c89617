"""Vectorised word splitting and hashing over Arrow string columns, shared by the operators on word sequences.

Everything works on the UTF-8 bytes of a whole batch at once: a lookup table says which bytes belong to words, document borders
always end a word, and word hashes are made eight bytes at a time. No Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text handled at once by one task (a single longer document is handled alone).
CHUNK = 1 << 20

#: Bytes of a batch between Spark and Python.
BATCH = 8 << 20

_U = np.uint64
_C1, _C2, _C3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)

#: Words end at the ASCII white space characters 09-0D and 20.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Words are runs of digits, ASCII letters and anything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_a : _b + 1] = True

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64, in place."""
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


#: What this worker process remembers from one task to the next, by name.
_HELD: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What an earlier task of this worker made under this name, or a new one. Tasks that don't name it in map_arrow make the worker forget it."""
    if name not in _HELD:
        _HELD[name] = make()
    return _HELD[name]


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str, holds: str | None = None) -> DataFrame:
    """df.mapInArrow in batches of BATCH bytes at most, which the session keeps: a batch exists twice in the JVM and once in Python."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH:
        conf.set(key, str(BATCH))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in [x for x in _HELD if x != holds]:
            del _HELD[name]
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(tidy, schema)


def _give_back() -> None:
    """Returns what was freed to the system: workers stay, and what their heaps keep counts as an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `limit` bytes at most."""
    col = batch.column(column)
    if not len(col):
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0)), dtype=np.int64)
    at = kept = 0
    while at < len(col):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(at, to - at)
        if size[to - 1] - kept >= CHUNK // 2:
            kept = size[to - 1]
            _give_back()
        at = to


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, with eight zero bytes behind them, and len + 1 offsets. A null is an empty text."""
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    n = int(offs[-1] - offs[0])
    out = np.zeros(n + 8, dtype=np.uint8)
    if n:
        out[:n] = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]]
    return out, offs - offs[0]


class Words:
    """Words of a batch of texts: byte ranges [start, end), and for document d the word range [first[d], first[d + 1])."""

    def __init__(self, col: pa.Array, table: np.ndarray = NOT_SPACE, lower: bool = False):
        raw, self.offs = as_bytes(col)
        self.raw = raw
        self.data = LOWER[raw] if lower else raw
        n = len(raw) - 8
        inside = table[raw[:n]]
        inner = self.offs[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        edge = np.zeros(n + 1, dtype=bool)
        edge[inner] = True
        edge[0] = edge[n] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:] if n else inside
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offs)
        self.count = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        view = np.ndarray((max(0, len(self.data) - 7),), dtype="<u8", buffer=self.data, strides=(1,))
        left = self.end - self.start
        with np.errstate(over="ignore"):
            h = left.astype(np.uint64) * _C3 + _U(seed)
            at, which = self.start.copy(), np.arange(len(left))
            while len(which):
                w = view[at] & _MASKS[np.minimum(left, 8)]
                x = (h[which] ^ (w * _C1)) * _C2
                x ^= x >> _U(29)
                h[which] = x
                more = left > 8
                which, at, left = which[more], at[more] + 8, left[more] - 8
            return mix(h)

    def doc_of(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring runs from the hashes of both."""
    with np.errstate(over="ignore"):
        x = a * _C1 + ((b << _U(31)) | (b >> _U(33))) * _C2
        x ^= x >> _U(32)
        x *= _C3
        x ^= x >> _U(29)
    return x


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words; entry i is of words i to i + n - 1, len(h) - n + 1 entries (none if fewer)."""
    if len(h) < n:
        return h[:0]
    powers, size = {1: h}, 1
    while size * 2 <= n:
        prev = powers[size]
        powers[size * 2] = join_hash(prev[: len(prev) - size], prev[size:])
        size *= 2
    out, done = None, 0
    total = len(h) - n + 1
    for size in sorted(powers, reverse=True):
        if n - done >= size:
            part = powers[size][done : done + total]
            out = part if out is None else join_hash(out, part)
            done += size
    return mix(out.copy())


def starts(first: np.ndarray, n: int) -> np.ndarray:
    """Whether n words from a word on lie in one document; for the entries of grams(..., n)."""
    total = int(first[-1]) - n + 1
    if total <= 0:
        return np.zeros(0, dtype=bool)
    ok = np.ones(total, dtype=bool)
    for k in range(1, n):
        at = first[1:-1] - k
        at = at[(at >= 0) & (at < total)]
        ok[at] = False
    return ok


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values."""
    if len(x) < n:
        return x[:0]
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list<int64> array from a flat array of uint64 or int64 and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
