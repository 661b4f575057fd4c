"""Vectorised text helpers for code that runs inside Arrow batches.

Texts stay in Arrow's own UTF-8 buffers. Words are byte runs found with a 256-entry
table, hashed to 64 bits with a prefix polynomial; nothing here is per word in Python.
Memory is bounded by slicing a batch to about ``SLICE_BYTES`` of text (one row at least).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20          # text handled at once by the vectorised code
HASH_SPAN = 1 << 18            # bytes whose prefix hashes are held at once
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))
SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)

_b = np.arange(256)
LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)
# words of letters and digits: [0-9a-z] and everything outside ASCII
ALNUM_WORD = ((LOWER >= 48) & (LOWER <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_b >= 128)
# words between white space (space, \t \n \v \f \r)
SPACE_WORD = ~((_b == 32) | ((_b >= 9) & (_b <= 13)))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse (wrapping products), built on first use in each process."""

    def __init__(self):
        self.kept = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):  # a task gets an empty one, not the driver's arrays
        return _Powers, ()

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.kept[0]) < n:
            for i, b in enumerate((BASE, BASE_INV)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                self.kept[i] = np.cumprod(p, dtype=np.uint64)
        return self.kept[0][:n], self.kept[1][:n]


POWERS = _Powers()


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the n + 1 row offsets into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if not len(off):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def row_slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """The words of some rows: ``start``/``end`` bytes, ``row``, 64-bit ``hash``, ``first`` word of each row."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, table: np.ndarray):
        n = len(buf)
        is_word = table[buf]
        if n:
            edge = off[(off > 0) & (off < n)]
            prev = np.empty(n, bool)
            prev[0] = False
            prev[1:] = is_word[:-1]
            prev[edge] = False
            nxt = np.empty(n, bool)
            nxt[-1] = False
            nxt[:-1] = is_word[1:]
            nxt[edge - 1] = False
            self.start = np.flatnonzero(is_word & ~prev)
            self.end = np.flatnonzero(is_word & ~nxt) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(off) - 1), self.count)
        self.hash = np.empty(len(self.start), np.uint64)
        lo = 0
        while lo < len(self.start):
            s0 = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.end, s0 + HASH_SPAN, "right")))
            self.hash[lo:hi] = span_hash(buf[s0:self.end[hi - 1]], self.start[lo:hi] - s0, self.end[lo:hi] - s0)
            lo = hi

    def prefix_hash(self, buf: np.ndarray, width: int) -> np.ndarray:
        """Hash of each word's first ``width`` bytes, 0 for words that aren't longer."""
        out = np.zeros(len(self.start), np.uint64)
        long = np.flatnonzero(self.end - self.start > width)
        if len(long):
            at = self.start[long]
            h = np.zeros(len(long), np.uint64)
            for j in range(width):
                h = h * BASE + LOWER[buf[at + j]].astype(np.uint64) + np.uint64(1)
            out[long] = mix(h + np.uint64(width))
        return out

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``k`` words inside one row."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h = h * SHINGLE_BASE + self.hash[j:n - k + 1 + j]
        at = np.flatnonzero(self.row[: n - k + 1] == self.row[k - 1:])
        return at, mix(h[at] + np.uint64(k))


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans of ``buf`` (ASCII letters in lower case)."""
    p, inv = POWERS.up_to(len(buf) + 1)
    acc = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((LOWER[buf].astype(np.uint64) + np.uint64(1)) * p[:-1], out=acc[1:])
    return mix((acc[end] - acc[start]) * inv[start] + (end - start).astype(np.uint64))


def group_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``first`` (empty groups: 0)."""
    acc = np.concatenate([[0], np.cumsum(values)])
    return acc[first[1:]] - acc[first[:-1]]


class Lookup:
    """Positions of 64-bit hashes in a small sorted array; -1 where absent. A bit table rejects most first."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(np.uint64))
        self.bits = max(12, min(24, int(len(keys)).bit_length() + 4))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.keys >> np.uint64(64 - self.bits)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``h``, index into ``keys``) of the hashes that are present."""
        at = np.flatnonzero(self.table[h >> np.uint64(64 - self.bits)])
        if not len(at) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.searchsorted(self.keys, h[at])
        ok = k < len(self.keys)
        ok[ok] = self.keys[k[ok]] == h[at][ok]
        return at[ok], k[ok]


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def without(df: DataFrame, name: str, *kept: str) -> DataFrame:
    """``df`` without columns of this name in any case, so that a result of that name replaces them; ``kept`` columns stay."""
    return df.drop(*[c for c in df.columns if c.lower() == name.lower() and c not in kept])


def release() -> None:
    """Gives freed memory back to the system at the end of a task: workers stay, and share the executor with others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def append_column(df: DataFrame, name: str, kind: T.DataType, make: Callable[[], Callable[[pa.RecordBatch], pa.Array]]) -> DataFrame:
    """``df`` with one more column, computed batch by batch; ``make`` runs once per task and returns the function."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def run(batches):
        fn = make()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, fn(b)], names=[*b.schema.names, name])
            del b
        del fn
        release()

    return df.mapInArrow(run, schema)


def id_bucket(col: str, n: int = 5):
    """crc32 of the id's decimal text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))
