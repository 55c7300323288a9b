"""Line dedup against a sharded minimal perfect hash.

1. Each document gives the distinct 128-bit hashes of its line keys; a grouped
   count, combined on the map side, tells in how many documents each occurs.
2. Hashes that repeat are dealt to shards of about SHARD_KEYS by their own
   value. Each shard's task builds a minimal perfect hash (levels of bit arrays:
   a key takes a place that no other key of its level wants, the rest go to the
   next level) and writes one file: levels, then a fingerprint and a count at
   each key's index. A hash outside the index is of a line seen once; it meets
   a fingerprint that differs.
3. Documents probe the files' arrays, shard by shard within a batch; at most
   CACHED_SHARDS are held by a worker at a time. No line is joined.

A document is a row: rows of one id count one by one. Null and empty texts are
one empty line; lines with an empty key always stay.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import shared
from shelfspark.llm.words import LEAN_BATCH, lean, mix, small_batches, without
from shelfspark.session import scratch_path, written

MIN_DOCS = 10
SHARD_KEYS = 100_000
CACHED_SHARDS = 64
_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z in lower case."""
    return line.strip(_STRIP).lower()  # bytes.lower() leaves all but A-Z


def key_hashes(lines: list[bytes]) -> np.ndarray:
    """(n, 2) 64-bit halves of each line key's 128-bit hash; (0, 0) for an empty key."""
    raw = b"".join(xxhash.xxh3_128_digest(k) if (k := line_key(x)) else bytes(16) for x in lines)
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _row_lines(column) -> Iterator[list[bytes]]:
    for text in column.to_pylist():
        yield (text or "").encode("utf-8", "surrogatepass").split(b"\n")


class Mph:
    """Minimal perfect hash of 128-bit keys: key -> 0 .. n-1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # booleans
        self.ranks = []
        before = 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits) - bits)
            before += int(bits.sum())
        self.n = before

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys[:, 0] + mix(keys[:, 1] + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> Mph:
        """``keys``: distinct rows of two 64-bit halves."""
        levels = []
        while len(keys):
            size = len(keys) * 3 // 2 + 1
            at = cls._at(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; any index or -1 for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self._at(keys[todo], level, len(bits))
            hit = bits[at]
            out[todo[hit]] = self.ranks[level][at[hit]]
            todo = todo[~hit]
        return out


class Shard:
    """Perfect hash, fingerprints and counts of one shard."""

    def __init__(self, mph: Mph, prints: np.ndarray, counts: np.ndarray):
        self.mph, self.prints, self.counts = mph, prints, counts

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> Shard:
        mph = Mph.build(keys)
        at = mph(keys)
        prints, by_index = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32)
        prints[at] = keys[:, 1]
        by_index[at] = np.minimum(counts, 0xFFFFFFFF)
        return cls(mph, prints, by_index)

    def dump(self) -> bytes:
        sizes = np.array([len(x) for x in self.mph.levels], "<i8")
        bits = [np.packbits(x).tobytes() for x in self.mph.levels]
        return b"".join([np.array([len(sizes), self.mph.n], "<i8").tobytes(), sizes.tobytes(), *bits,
                         self.prints.astype("<u8").tobytes(), self.counts.astype("<u4").tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Shard:
        n_levels, n = np.frombuffer(data, "<i8", 2).tolist()
        sizes = np.frombuffer(data, "<i8", n_levels, 16).tolist()
        at, levels = 16 + 8 * n_levels, []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(Mph(levels), np.frombuffer(data, "<u8", n, at), np.frombuffer(data, "<u4", n, at + 8 * n))

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Documents that hold each key; 1 for keys outside the index."""
        at = self.mph(keys)
        found = at >= 0
        found[found] = self.prints[at[found]] == keys[found, 1]
        out = np.ones(len(keys), np.int64)
        out[found] = self.counts[at[found]]
        return out


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """(a, b, n): hash halves of the line keys found in two documents or more."""
    small_batches(docs.sparkSession, LEAN_BATCH)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(key_hashes(lines), axis=0) for lines in _row_lines(batch.column(0))]
            keys = np.concatenate(own) if own else np.zeros((0, 2), np.uint64)
            keys = keys[keys.any(1)].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["a", "b"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(lean(task), "a long, b long")
    return rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")


def index(docs: DataFrame, text: str = "text", folder: str | None = None, shard_keys: int = SHARD_KEYS) -> list[str]:
    """Builds the shards of the lines of ``docs``; returns the shard files' places
    (one short string per SHARD_KEYS repeated lines; empty: no shard)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "line-index")
    counts = written(repeated(docs, text), "line-counts")
    shards = max(1, -(-counts.count() // shard_keys))

    def build(table: pa.Table) -> pa.Table:
        halves = [table.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("a", "b")]
        shard = Shard.build(np.stack(halves, 1), table.column("n").to_numpy())
        k = table.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([k], pa.int32()),
                         "path": [shared.put(folder, f"shard-{k:06d}", shard.dump())]})

    dealt = counts.withColumn("shard", F.pmod(F.shiftrightunsigned("a", 20), F.lit(shards)).cast("int"))
    files = written(dealt.groupBy("shard").applyInArrow(build, "shard int, path string"), "line-shards")
    places = {r["shard"]: r["path"] for r in files.toLocalIterator()}
    return [places.get(k, "") for k in range(shards)]


class Probe:
    def __init__(self, places: list[str]):
        self.places, self.held = places, OrderedDict()

    def _shard(self, k: int) -> Shard:
        if k not in self.held:
            if len(self.held) >= CACHED_SHARDS:
                self.held.popitem(last=False)
            self.held[k] = Shard.load(shared.get(self.places[k]))
        self.held.move_to_end(k)
        return self.held[k]

    def counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), np.int64)
        of = ((keys[:, 0] >> np.uint64(20)) % np.uint64(len(self.places))).astype(np.int64)
        for k in np.unique(of).tolist():
            if self.places[k]:
                mine = np.flatnonzero(of == k)
                out[mine] = self._shard(k).count(keys[mine])
        out[~keys.any(1)] = 0
        return out


def drop_repeated(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, places: list[str] | None = None) -> DataFrame:
    """``docs`` with the kept lines as ``text`` and added ``n_lines``, ``n_dropped``."""
    small_batches(docs.sparkSession, LEAN_BATCH)
    docs = without(docs, "n_lines", "n_dropped").withColumn(text, F.col(text).cast("string"))
    places = index(docs, text) if places is None else places
    place, names = docs.columns.index(text), docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe(places)
        for batch in batches:
            rows = list(_row_lines(batch.column(place)))
            size = np.fromiter(map(len, rows), np.int64, len(rows))
            keys = key_hashes([x for lines in rows for x in lines])
            dropped = probe.counts(keys) >= min_docs
            ends = np.cumsum(size)
            gone = np.diff(np.concatenate([[0], np.cumsum(dropped)])[np.concatenate([[0], ends])])
            kept = [b"\n".join(lines) if not g else b"\n".join(x for x, d in zip(lines, dropped[e - n:e].tolist()) if not d)
                    for lines, g, e, n in zip(rows, gone.tolist(), ends.tolist(), size.tolist())]
            columns = list(batch.columns)
            columns[place] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(gone.astype(np.int64))],
                                             names=[*names, "n_lines", "n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(lean(task), f"{schema}, n_lines long, n_dropped long")
