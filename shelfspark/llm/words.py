"""Words of whole text batches as numpy arrays.

The operators cut the bytes of an Arrow batch into words (runs without the six
white-space bytes), hash all of them at once and look up what they keep per
distinct word. No Python object is made for a word that was seen before.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 2_000_000
#: Bytes and rows of one Arrow batch: bounds a worker's memory.
BATCH_BYTES, BATCH_ROWS = 8_000_000, 4_000
#: The same for operators that follow one another in one session: what their workers and
#: the executor hold adds up.
LEAN_SLICE, LEAN_BATCH = 500_000, 2_000_000

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bounds the Arrow batches that workers get, unless the session says how."""
    for key, value in (("maxBytesPerBatch", size), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or int(now) > value or int(now) == 0:
            spark.conf.set(key, str(value))


def release() -> None:
    """Gives what this worker no longer uses back to the machine: the powers, objects that
    refer to each other, Arrow's pool, and the C library's free memory (glibc alone has the call)."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def lean(task: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``task`` for ``mapInArrow``, whose worker does not keep its memory: Spark uses
    the same Python workers for all later tasks, beside the executor's own heap."""

    @functools.wraps(task)
    def run(batches: Batches) -> Batches:
        try:
            yield from task(batches)
        finally:
            release()

    return run


def without(df: DataFrame, *names: str) -> DataFrame:
    """Input columns that carry an output column's name give way to it."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64, at least n of each (by steps of 2^19)."""
    if not _powers or len(_powers[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(-(-n // (1 << 19)) << 19, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]: a polynomial over random byte values."""
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of each data[i:i + gram]; the high bits are the better ones."""
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return (sums[gram:] - sums[:-gram]) * inverse[: len(sums) - gram]


@dataclass
class Texts:
    """Some rows of a batch: bytes, row bounds in them, word bounds, and for
    each row the place of its first word (``row_word`` has one more entry)."""

    first: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_word: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def words_of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.row_word))


def cut(data: np.ndarray, bounds: np.ndarray, first: int = 0) -> Texts:
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Texts(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and its row bounds."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def texts(column, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a string column, in order, in slices of about ``limit`` bytes."""
    data, bounds = column_bytes(column)
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        part = data[bounds[i]:bounds[j]]
        yield cut(LOWER[part] if lower else part, bounds[i:j + 1] - bounds[i], i)
        i = j


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start:start+length] of all pairs, one after another."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(total)
    return flat[at]


class SpanCodes:
    """Codes (arrays of integers) per distinct byte span, kept by the span's
    hash; ``encode`` maps a list of new spans to their codes. At most ``limit``
    spans are kept: then the memory starts anew, which costs time only."""

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All codes of all spans in order, and how many each span has."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, where, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        known = place < len(self.keys)
        new[known] = self.keys[place[known]] != keys[known]
        if new.any():
            if len(self.keys) > self.limit:
                self.clear()
                new[:] = True
                place[:] = 0
            raw = data.tobytes()
            codes = self.encode([raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())])
            size = np.fromiter(map(len, codes), np.int64, len(codes))
            total = int(size.sum())
            while self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
            self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(codes), np.int32, total)
            self.at = np.insert(self.at, place[new], self.used + np.cumsum(size) - size)
            self.size = np.insert(self.size, place[new], size)
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.used += total
            place = np.searchsorted(self.keys, keys)
        span = place[back.reshape(-1)]
        lengths = self.size[span]
        return ragged(self.flat, self.at[span], lengths), lengths


def per_row(lengths: np.ndarray, row_word: np.ndarray) -> np.ndarray:
    """Sums of ``lengths`` (one per word) by row."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return np.diff(sums[row_word])


def held_out(id_col: str, remainder: int) -> Column:
    """crc32 of the id as text, modulo 5, is ``remainder`` (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == remainder, F.lit(False))
