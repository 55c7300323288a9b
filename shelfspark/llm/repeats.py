"""Repeated byte strings, found by a radix sort of suffixes to a limited depth.

A window is DEPTH bytes that start at one place of a text. A byte goes if a
window over it also starts in a document with a smaller id.

1. The texts are written once with the number of their block (a partition).
2. A window's key is the least hash of the grams in it, so equal windows have
   equal keys, and neighbours mostly share theirs. Each block sends its distinct
   keys (48 bits each, sorted) to shards by key range; a shard tells each block
   which of its keys other documents hold too. Suffixes with other keys are in
   no equal group: they leave before the sort and nothing is lost by it.
3. Runs of windows with one key travel as one context (run + DEPTH - 1 bytes).
   A block sends each distinct context once, with the least and the greatest id
   that hold it, so a passage that a third of all documents hold is one row per
   block. The shard's task orders the suffixes of its contexts by
   most-significant-digit passes of eight bytes, only through DEPTH bytes, and
   drops groups of one after each pass. Equal groups are the repeated windows;
   each gets its least id.
4. The blocks look up their contexts' least ids and cut the bytes out.

What a shard tells a block is one file in the shared folder (``block=n``),
written and committed by Spark; nothing passes the driver. Keys and contexts
that collide in 48 and 64 bits only cost work or, with odds of 2^-112 a pair of
contexts, a wrong byte.

Null text: empty. Texts shorter than DEPTH have no window. Rows with a null id
stay whole and remove nothing; rows of one id do not remove each other. Repeats
inside one document stay. Removal may cut a code point: ``kept`` is binary.
Input columns called n_bytes, n_removed, n_spans or kept give way; all others
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import Texts, gram_hashes, mix, ragged, small_batches, span_hashes, texts, without
from shelfspark.session import scratch_path, written

DEPTH = 50
#: Text bytes whose keys or contexts one shard's task gets, about.
SHARD_BYTES = 64_000_000
#: Keys or context bytes of a block that are held before they are sent.
HELD = 4_000_000
#: A key that so many blocks hold gets finer keys, so no task meets all contexts of a common phrase.
HOT_BLOCKS = 64
#: Windows whose keys are worked out at once: their arrays stay in a processor's cache.
PIECE = 1 << 16
#: Suffixes that are ordered at once.
SORT_SUFFIXES = 2_000_000
_KEY_BITS = 48
_DROPPED = np.uint64(64 - _KEY_BITS)
_ZSTD = pa.Codec("zstd", compression_level=1)


def pack(a: np.ndarray) -> bytes:
    """64-bit numbers as zstd-compressed planes of equal bytes."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(a).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def unpack(raw: bytes, dtype=np.int64) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(raw[8:], 8 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(dtype).reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint64), dtype=np.uint64)


def squeeze(data: np.ndarray) -> bytes:
    raw = data.tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def unsqueeze(raw: bytes) -> np.ndarray:
    return np.frombuffer(_ZSTD.decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True), np.uint8)


class Runs:
    """Runs of neighbouring windows with one key in a slice of texts: first
    window, number of windows, row, 48-bit key, 64-bit digest of the bytes.
    Windows whose key is in ``hot`` get a finer key, from longer grams too;
    ``base`` is the key without that."""

    def __init__(self, part: Texts, depth: int, hot: np.ndarray | None = None):
        ends = part.bounds[1:]
        step = np.zeros(len(part.data) + 1, np.int8)
        long = np.diff(part.bounds) >= depth
        step[part.bounds[:-1][long]] += 1
        step[ends[long] - depth + 1] -= 1
        valid = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        found = [self._piece(part.data, valid, at, depth, hot) for at in range(0, len(valid), PIECE)]
        found = [f for f in found if f is not None] or [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 3]
        self.start, self.size, self.base, self.key, self.digest = (np.concatenate(x) for x in zip(*found))
        self.row = np.searchsorted(part.bounds, self.start, "right") - 1

    @staticmethod
    def _piece(data, valid, at, depth, hot):
        """Windows that start in data[at:at + PIECE]."""
        own = data[at:at + PIECE + depth - 1]
        n = len(own) - depth + 1
        if n <= 0 or not valid[at:at + n].any():
            return None
        ok = valid[at:at + n]
        base = key = _least_hashes(own, depth, max(1, 2 * depth // 5))
        start, end = _runs(key, ok)
        if hot is not None and (many := _member(hot, _short(key[start]))).any():
            fine = np.zeros(n, bool)
            fine[ragged(np.arange(n), start[many], (end - start)[many])] = True
            key = np.where(fine, mix(key + mix(_least_hashes(own, depth, max(1, 4 * depth // 5)))), key)
            start, end = _runs(key, ok)
        return (start + at, end - start, _short(base[start]), _short(key[start]),
                span_hashes(own, start, end + depth - 1))


def _least_hashes(data: np.ndarray, depth: int, gram: int) -> np.ndarray:
    """For each window the least hash of the grams in it."""
    least, width, have = gram_hashes(data, gram), depth - gram + 1, 1
    while have < width:  # least hash of `have` neighbouring grams
        more = min(have, width - have)
        least, have = np.minimum(least[:-more], least[more:]), have + more
    return least


def _short(least: np.ndarray) -> np.ndarray:
    """48 bits of a least hash, evenly spread (least hashes are small)."""
    return mix(least) >> _DROPPED


def _runs(key: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of neighbouring windows that are ``ok`` and have one key."""
    same = (key[1:] == key[:-1]) & ok[:-1] & ok[1:]
    return np.flatnonzero(ok & ~np.append(False, same)), np.flatnonzero(ok & ~np.append(same, False)) + 1


def _member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)


def _shard_bounds(sorted_keys: np.ndarray, shards: int) -> np.ndarray:
    """Places in sorted keys where each shard's range of keys starts, and the end."""
    firsts = np.array([((1 << _KEY_BITS) * k) // shards for k in range(shards)], np.uint64)
    return np.append(np.searchsorted(sorted_keys, firsts), len(sorted_keys))


class Blocks:
    """Reads the table of texts by block and, of each, what shards have told it."""

    def __init__(self, columns: list[str], block: str, id_col: str, text: str, key_folder: str = ""):
        self.at = [columns.index(c) for c in (block, id_col, text)]
        self.key_folder = key_folder

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            block = batch.column(self.at[0]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield int(block[a]), batch.slice(a, b - a)

    def ids(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and which of them are not null."""
        column = batch.column(self.at[1])
        return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ~column.is_null().to_numpy(zero_copy_only=False)

    def texts(self, batch: pa.RecordBatch) -> Iterator[Texts]:
        return texts(batch.column(self.at[2]))

    def keys(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's keys that other documents hold too, in order, and the hot ones among them."""
        told = self.told(self.key_folder, block, ["keys", "hot"])
        return tuple(np.sort(np.concatenate([unpack_sorted(x) for x in c])) if c else np.zeros(0, np.uint64) for c in told)

    @staticmethod
    def told(folder: str, block: int, names: list[str]) -> list[list]:
        """The rows that shards wrote for the block, as lists of the columns."""
        store, path = fs.FileSystem.from_uri(f"{folder}/block={block}")
        files = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
        tables = []
        for name in sorted(files):
            with store.open_input_file(name) as f:
                tables.append(pq.ParquetFile(f).read(columns=names))
        return [[v for t in tables for v in t.column(n).to_pylist()] for n in names]


def _told(rows: DataFrame, name: str) -> str:
    """Writes rows with a ``block`` column as one file per block; returns the folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.repartition("block").write.partitionBy("block").parquet(path)
    return path


# ---- keys that other documents hold too ------------------------------------
def _key_rows(blocks: Blocks, depth: int, shards: int):
    def flush(block: int, held: list) -> Iterator[pa.RecordBatch]:
        key, low, high = (np.concatenate(x) for x in zip(*held))
        keys, low, high = _least_greatest(key, low, high)
        cuts = _shard_bounds(keys, shards)
        out = [(s, block, pack_sorted(keys[a:b]), np.packbits(low[a:b] != high[a:b]).tobytes())
               for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                         names=["shard", "block", "keys", "several"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for block, batch in blocks(batches):
            if held and (block != now or size > HELD):
                yield from flush(now, held)
                held, size = [], 0
            now = block
            ids, known = blocks.ids(batch)
            for part in blocks.texts(batch):
                runs = Runs(part, depth)
                row = runs.row + part.first
                use = known[row]
                if use.any():
                    held.append(_least_greatest(runs.key[use], ids[row[use]], ids[row[use]]))
                    size += len(held[-1][0])
        if held:
            yield from flush(now, held)

    return task


def _least_greatest(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with the least ``low`` and the greatest ``high`` of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    if not len(first):
        return key, low, high
    return key[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _shared_keys(table: pa.Table) -> pa.Table:
    """Of each block's keys in a shard, those that another row or several
    documents of one row hold, and the hot ones among them."""
    keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool)
               for x, k in zip(table.column("several").to_pylist(), keys)]
    all_keys, count = np.unique(np.concatenate(keys), return_counts=True)
    hot = count > 1
    hot[np.searchsorted(all_keys, np.concatenate([k[s] for k, s in zip(keys, several)]))] = True
    shared = all_keys[hot]
    many = all_keys[count >= HOT_BLOCKS]
    own = [(b, k[_member(shared, k)]) for b, k in zip(table.column("block").to_pylist(), keys)]
    own = [(b, k, k[_member(many, k)]) for b, k in own if len(k)]
    return pa.table({"block": pa.array([b for b, _, _ in own], pa.int32()),
                     "keys": pa.array([pack_sorted(k) for _, k, _ in own], pa.binary()),
                     "hot": pa.array([pack_sorted(h) for _, _, h in own], pa.binary())})


# ---- contexts of the shared keys --------------------------------------------
def _context_rows(blocks: Blocks, depth: int, shards: int):
    def distinct(held: list) -> tuple:
        key, digest, low, high, size, data = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((digest, key))
        k, d = key[order], digest[order]
        first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])))
        at = np.cumsum(size) - size
        one = order[first]
        return (k[first], d[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first),
                size[one], ragged(data, at[one], size[one]))

    def flush(block: int, held: list) -> Iterator[pa.RecordBatch]:
        key, digest, low, high, size, data = distinct(held)
        cuts, at = _shard_bounds(key, shards), np.append(0, np.cumsum(size))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([s], pa.int32()), "block": pa.array([block], pa.int32()), "key": [pack_sorted(key[a:b])],
                    **{n: [pack(x[a:b].astype(x.dtype if x.dtype == np.uint64 else np.int64))]
                       for n, x in (("digest", digest), ("low", low), ("high", high), ("size", size))},
                    "data": [squeeze(data[at[a]:at[b]])]})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shared, hot, held, size = None, None, None, [], 0
        for block, batch in blocks(batches):
            if held and (block != now or size > 4 * HELD):
                yield from flush(now, held)
                held, size = [], 0
            if block != now:
                now = block
                shared, hot = blocks.keys(block)
            ids, known = blocks.ids(batch)
            for part in blocks.texts(batch):
                runs = Runs(part, depth, hot)
                row = runs.row + part.first
                use = np.flatnonzero(known[row] & _member(shared, runs.base))
                if len(use):
                    length, doc = runs.size[use] + depth - 1, ids[row[use]]
                    held.append(distinct([(runs.key[use], runs.digest[use], doc, doc, length,
                                           ragged(part.data, runs.start[use], length))]))
                    size += len(held[-1][-1])
        if held:
            yield from flush(now, held)

    return task


def radix_groups(data: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of equal groups: suffixes ``at`` places of ``data`` have one number
    if their ``group`` and their first ``depth`` bytes are equal.

    Most-significant-digit passes: each orders the suffixes still open by the
    next eight bytes within their groups; groups of one are closed.
    """
    words = np.ndarray((len(data) + 1,), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    out, free, live = np.empty(len(at), np.int64), 0, np.arange(len(at))
    for done in range(-8, depth, 8):
        if done < 0:  # the pass of the groups that were given
            digit = np.zeros(len(live), np.uint64)
        else:
            digit = words[at[live] + done].astype(np.uint64) >> np.uint64(64 - 8 * min(8, depth - done))
        order = np.lexsort((digit, group))
        digit, group, live = digit[order], group[order], live[order]
        new = np.append(True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))
        alone = new & np.append(new[1:], True)
        n = int(alone.sum())
        out[live[alone]] = np.arange(free, free + n)
        free += n
        group, live = (np.cumsum(new) - 1)[~alone], live[~alone]
        if not len(live):
            return out
    out[live] = free + np.unique(group, return_inverse=True)[1].reshape(-1)
    return out


def _least_ids(key, low, size, data, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the distinct contexts, in order, the least id that holds it."""
    windows = size - depth + 1
    ends = np.cumsum(windows)
    least = np.repeat(low, windows)
    at = np.cumsum(size) - size
    new = np.append(True, key[1:] != key[:-1])
    number = np.cumsum(new) - 1
    several = np.flatnonzero(np.bincount(number)[number] > 1)  # keys with one context: all equal already
    while len(several):
        total = np.cumsum(windows[several])
        stop = max(1, int(np.searchsorted(total, SORT_SUFFIXES, "right")))
        while stop < len(several) and key[several[stop]] == key[several[stop - 1]]:
            stop += 1  # a key's contexts are ordered together
        mine, several = several[:stop], several[stop:]
        n = windows[mine]
        place = np.repeat(at[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        own = np.repeat(ends[mine] - windows[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        equal = radix_groups(data, place, np.repeat(number[mine], n), depth)
        best = np.full(int(equal.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(best, equal, least[own])
        least[own] = best[equal]
    return least, windows


def _sorted_contexts(depth: int):
    def task(table: pa.Table) -> pa.Table:
        rows = {n: [unpack(x, np.uint64 if n == "digest" else np.int64) for x in table.column(n).to_pylist()]
                for n in ("digest", "low", "high", "size")}
        rows["key"] = [unpack_sorted(x) for x in table.column("key").to_pylist()]
        count = np.array([len(k) for k in rows["key"]])
        key, digest, low, high, size = (np.concatenate(rows[n]) for n in ("key", "digest", "low", "high", "size"))
        data = np.concatenate([unsqueeze(x) for x in table.column("data").to_pylist()])
        order = np.lexsort((digest, key))
        k, d = key[order], digest[order]
        new = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]))
        first = np.flatnonzero(new)
        one, place = order[first], np.empty(len(key), np.int64)
        place[order] = np.cumsum(new) - 1  # each row's distinct context
        at = np.cumsum(size) - size
        length = size[one]
        least, windows = _least_ids(k[first], np.minimum.reduceat(low[order], first), length,
                                    ragged(data, at[one], length), depth)
        ends = np.cumsum(windows)
        change = np.append(True, least[1:] != least[:-1])
        change[ends[:-1]] = True
        starts = np.flatnonzero(change)  # runs of windows with one least id
        run_size, run_least = np.diff(np.append(starts, len(least))), least[starts]
        run_of = np.searchsorted(starts, ends - windows)
        n_runs = np.diff(np.append(run_of, len(starts)))
        lowest = np.minimum.reduceat(run_least, run_of)
        out = {"block": [], "key": [], "digest": [], "n_runs": [], "run_size": [], "run_least": []}
        for b, e, block in zip(np.cumsum(count) - count, np.cumsum(count), table.column("block").to_pylist()):
            mine = np.flatnonzero(lowest[place[b:e]] < high[b:e]) + b  # only these lose anything
            if len(mine):
                to = place[mine]
                out["block"].append(block)
                out["key"].append(pack_sorted(key[mine]))
                for n, x in (("digest", digest[mine]), ("n_runs", n_runs[to]), ("run_size", ragged(run_size, run_of[to], n_runs[to])),
                             ("run_least", ragged(run_least, run_of[to], n_runs[to]))):
                    out[n].append(pack(x))
        return pa.table({n: pa.array(v, pa.int32() if n == "block" else pa.binary()) for n, v in out.items()})

    return task


# ---- removal ------------------------------------------------------------------
class Told:
    """A block's contexts with the least ids of their windows."""

    NAMES = ["key", "digest", "n_runs", "run_size", "run_least"]

    def __init__(self, columns: list[list]):
        read = [unpack_sorted, lambda x: unpack(x, np.uint64), unpack, unpack, unpack]
        key, digest, n_runs, self.run_size, self.run_least = (
            np.concatenate([f(x) for x in c]) if c else np.zeros(0, np.uint64 if i < 2 else np.int64)
            for i, (f, c) in enumerate(zip(read, columns)))
        at = np.cumsum(n_runs) - n_runs
        order = np.argsort(digest, kind="stable")
        self.key, self.digest, self.n_runs, self.at = key[order], digest[order], n_runs[order], at[order]

    def removed(self, runs: Runs, ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of removed bytes; ``ids`` has the id of each run's document."""
        none = np.zeros(0, np.int64)
        if not len(self.digest):
            return none, none
        place = np.searchsorted(self.digest, runs.digest)
        place[place == len(self.digest)] = 0
        hit = np.flatnonzero((self.digest[place] == runs.digest) & (self.key[place] == runs.key))
        place = place[hit]
        n = self.n_runs[place]
        size, least = ragged(self.run_size, self.at[place], n), ragged(self.run_least, self.at[place], n)
        ahead = np.cumsum(size) - size
        ahead -= np.repeat(ahead[np.cumsum(n) - n] if len(n) else none, n)
        start = np.repeat(runs.start[hit], n) + ahead
        gone = least < np.repeat(ids[hit], n)
        return start[gone], (start + size + depth - 1)[gone]


def _remove(blocks: Blocks, folder: str, depth: int, names: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told, hot = None, None, None
        for block, batch in blocks(batches):
            if block != now:
                now, told, hot = block, Told(blocks.told(folder, block, Told.NAMES)), blocks.keys(block)[1]
            ids, known = blocks.ids(batch)
            ids[~known] = np.iinfo(np.int64).min
            stats, kept = [], []
            for part in blocks.texts(batch):
                runs = Runs(part, depth, hot)
                start, end = told.removed(runs, ids[runs.row + part.first], depth)
                step = np.bincount(start, minlength=len(part.data) + 1) - np.bincount(end, minlength=len(part.data) + 1)
                gone = np.cumsum(step[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = part.bounds[:-1][part.bounds[:-1] < len(gone)]
                opens[inner] = gone[inner]
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[part.bounds])
                stats.append((np.diff(part.bounds), total(gone), total(opens)))
                left = part.data[~gone]
                at = np.concatenate([[0], np.cumsum(stats[-1][0] - stats[-1][1])]).tolist()
                kept += [left[a:b].tobytes() for a, b in zip(at, at[1:])]
            columns = [batch.column(n) for n in names]
            more = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*stats)]
            yield pa.RecordBatch.from_arrays([*columns, *more, pa.array(kept, pa.binary())],
                                             names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return task


def _free_name(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def remove(docs: DataFrame, id_col: str = "doc_id", text: str = "text", depth: int = DEPTH,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and the
    ``kept`` bytes. ``id_col`` holds integers; ``depth`` is at least 2."""
    if depth < 2:
        raise ValueError("a repeated string has two bytes or more")
    spark = docs.sparkSession
    small_batches(spark)
    docs = without(docs, "n_bytes", "n_removed", "n_spans", "kept")
    names = docs.columns
    block, size = _free_name(docs, "_block"), _free_name(docs, "_size")
    docs = docs.withColumn(text, F.col(text).cast("string")).withColumn(id_col, F.col(id_col).cast("long"))
    table = written(docs.withColumn(block, F.spark_partition_id())
                        .withColumn(size, F.coalesce(F.octet_length(text), F.lit(0)).cast("long")), "repeat-texts")
    total = table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    table = table.drop(size)
    shards = max(1, -(-total // shard_bytes), min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // 1_000_000))
    narrow = table.select(block, id_col, text)
    blocks = Blocks(narrow.columns, block, id_col, text)
    keys = narrow.mapInArrow(_key_rows(blocks, depth, shards), "shard int, block int, keys binary, several binary")
    key_folder = _told(keys.groupBy("shard").applyInArrow(_shared_keys, "block int, keys binary, hot binary"), "repeat-keys")
    blocks = Blocks(narrow.columns, block, id_col, text, key_folder)
    contexts = narrow.mapInArrow(_context_rows(blocks, depth, shards), "shard int, block int, key binary, digest binary, "
                                 "low binary, high binary, size binary, data binary")
    folder = _told(contexts.groupBy("shard").applyInArrow(
        _sorted_contexts(depth), "block int, key binary, digest binary, n_runs binary, run_size binary, run_least binary"),
        "repeat-contexts")
    blocks = Blocks(table.columns, block, id_col, text, key_folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields if f.name in names)
    return table.mapInArrow(_remove(blocks, folder, depth, names), f"{schema}, n_bytes long, n_removed long, n_spans long, kept binary")
