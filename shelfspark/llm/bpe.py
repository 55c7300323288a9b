"""Byte-level BPE by a rank file, and back.

Texts are cut at white space into chunks (a chunk takes one space before it
along); each distinct chunk is matched against the split pattern and merged
once. Merging works on padded matrices, one per length bucket: in each round
every row merges its leftmost pair of the lowest rank, pairs are looked up in
a hash table, the row is compacted by one place, and rows without a mergeable
pair leave the matrix. Pieces of more than LONG bytes are merged one by one
with a heap, which gives the same ids. Null texts count as empty. What a task
keeps of the chunks and pieces it has met, and what it works on at once, is
bounded, however many distinct ones its texts hold.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import LEAN_BATCH, LEAN_SLICE, SpanCodes, Texts, lean, mix, per_row, ragged, small_batches, texts, without

LONG = 256
#: Distinct chunks and pieces that a task keeps, and places of a merge matrix.
CHUNKS, PIECES, MATRIX = 200_000, 20_000, 250_000
#: White space beyond the six ASCII characters: texts with it are split whole.
_ODD_SPACE = "[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_NONE = np.int32(0x7FFFFFFF)


class PairTable:
    """(left id, right id) -> id of their concatenation, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        bits = max(4, (4 * len(keys)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << bits, _NONE)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        at = mix(key) & self.mask
        while len(key):  # one of those that meet in a free place takes it, the others go on
            free = self.keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(at, return_index=True)
            win = np.zeros(len(key), bool)
            win[first] = True
            win &= free
            self.keys[at[win]], self.values[at[win]] = key[win], value[win]
            key, value, at = key[~win], value[~win], (at[~win] + np.uint64(1)) & self.mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; _NONE where the pair makes no token or a side is padding."""
        shape = left.shape
        out = np.full(left.size, _NONE)
        todo = np.flatnonzero((left.reshape(-1) >= 0) & (right.reshape(-1) >= 0))
        key = (left.reshape(-1)[todo].astype(np.uint64) << np.uint64(32)) | right.reshape(-1)[todo].astype(np.uint64)
        at = mix(key) & self.mask
        while len(todo):
            seen = self.keys[at]
            hit = seen == key
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (seen != np.uint64(0xFFFFFFFFFFFFFFFF))
            todo, key, at = todo[go], key[go], (at[go] + np.uint64(1)) & self.mask
        return out.reshape(shape)


class Bpe:
    def __init__(self, rank_file: str, pattern: str):
        import regex

        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern, self.odd = regex.compile(pattern), regex.compile(_ODD_SPACE)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        top = max(self.ranks.values()) + 1
        token = [b""] * top
        for t, r in self.ranks.items():
            token[r] = t
        self.token_size = np.fromiter(map(len, token), np.int64, top)
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self.pieces: dict[bytes, list[int]] = {}
        self.codes = SpanCodes(self.encode_chunks, CHUNKS)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, by buckets of like length."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = [self.ranks[p]]
            elif len(p) > LONG:
                out[i] = self._merge_long(p)
            else:
                buckets.setdefault(4 << max(0, (len(p) - 1).bit_length() - 2), []).append(i)
        for width, members in buckets.items():
            step = max(1, MATRIX // width)
            for k in range(0, len(members), step):
                some = members[k:k + step]
                for i, ids in zip(some, self._merge_matrix([pieces[i] for i in some], width)):
                    out[i] = ids
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        m = np.full((len(pieces), width + 1), -1, np.int32)
        m[np.arange(width + 1) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        done, rows = m.copy(), np.arange(len(pieces))
        rank = self.pairs(m[:, :-1], m[:, 1:])
        columns = np.arange(width + 1)
        while len(rows):
            at = rank.argmin(1)  # the leftmost of the lowest
            best = rank[np.arange(len(rows)), at]
            go = best != _NONE
            if not go.all():
                done[rows[~go]] = m[~go]
                rows, m, rank, at, best = rows[go], m[go], rank[go], at[go], best[go]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            after = columns[None, :] > at[:, None]
            moved = np.full_like(m, -1)
            moved[:, :-1] = m[:, 1:]
            m = np.where(after, moved, m)
            m[line, at] = best
            shifted = np.full_like(rank, _NONE)
            shifted[:, :-1] = rank[:, 1:]
            rank = np.where(after[:, :-1], shifted, rank)
            rank[line, at] = self.pairs(m[line, at], m[line, at + 1])
            left = np.maximum(at - 1, 0)
            rank[line, left] = np.where(at > 0, self.pairs(m[line, left], m[line, left + 1]), rank[line, left])
        size = (done >= 0).sum(1)
        flat = done[done >= 0].tolist()
        ends = np.cumsum(size).tolist()
        return [flat[e - n:e] for e, n in zip(ends, size.tolist())]

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
        token = [bytes([b]) for b in piece]

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := self.ranks.get(token[i] + token[j])) is not None:
                heapq.heappush(heap, (r, i, len(token[i]), len(token[j])))

        for i in range(n):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if token[i] is None or len(token[i]) != a or after[i] >= n or len(token[after[i]]) != b:
                continue  # a side has changed since
            j = after[i]
            token[i], ids[i], token[j] = token[i] + token[j], r, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ids[i] for i in range(n) if token[i] is not None]

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk: its matches of the pattern, each merged separately."""
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        split = [[p.encode() for p in self.pattern.findall(c.decode("utf-8", "replace"))] for c in chunks]
        new = list({p for ps in split for p in ps if p not in self.pieces})
        self.pieces.update(zip(new, self.merge(new)))
        return [self.pieces[ps[0]] if len(ps) == 1 else [i for p in ps for i in self.pieces[p]] for ps in split]

    def spans(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the spans that the pattern never joins, in order,
        and the place of each row's first span.

        Before a word, a run of white space gives up its last character: a
        space joins the word, any other stands alone; what is before is one
        match. A run at the end of a text is one match.
        """
        n = len(t.starts)
        row = t.words_of()
        own = np.ones(n, bool)  # the first word of its row
        own[1:] = row[1:] != row[:-1]
        gap = np.where(own, t.bounds[row], np.concatenate([[0], t.ends[:-1]])[:n])
        wide = t.starts - gap
        space = np.zeros(n, bool)
        has = wide > 0
        space[has] = t.data[t.starts[has] - 1] == 0x20
        last = t.starts - (wide > 0)
        starts = np.stack([gap, last, np.where(space, last, t.starts)], 1)
        ends = np.stack([last, np.where(space, last, t.starts), t.ends], 1)
        # the run of white space at the end of each row, or the whole row without words
        words = np.diff(t.row_word)
        tail = np.where(words > 0, t.ends[np.maximum(t.row_word[1:] - 1, 0)] if n else 0, t.bounds[:-1])
        starts = np.insert(starts.reshape(-1), 3 * t.row_word[1:], tail)
        ends = np.insert(ends.reshape(-1), 3 * t.row_word[1:], t.bounds[1:])
        first = 3 * t.row_word + np.arange(len(t) + 1)
        full = ends > starts
        return starts[full], ends[full], np.concatenate([[0], np.cumsum(full)])[first]

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and how many each row has."""
        starts, ends, first = self.spans(t)
        ids, size = self.codes(t.data, starts, ends)
        n = per_row(size, first)
        odd = [i for i in range(len(t)) if self.odd.search(t.text(i).decode("utf-8", "replace"))]
        if odd:
            bounds = np.cumsum(n)
            parts = [ids[b - k:b] for b, k in zip(bounds.tolist(), n.tolist())]
            for i, whole in zip(odd, self.encode_chunks([t.text(i) for i in odd])):
                parts[i] = np.array(whole, np.int32)
            ids, n = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, n

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.token_bytes, self.token_at[ids], self.token_size[ids])


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                              pa.py_buffer(data.tobytes())])


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``ids`` (binary: little-endian unsigned 32-bit integers)
    and ``decoded`` (binary, from the ids)."""
    small_batches(docs.sparkSession, LEAN_BATCH)
    docs = without(docs, "n_tokens", "ids", "decoded")
    place = docs.columns.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(rank_file, pattern)
        for batch in batches:
            for t in texts(batch.column(place), limit=LEAN_SLICE):
                ids, n = bpe.encode(t)
                ends = np.concatenate([[0], np.cumsum(n)])
                raw = bpe.decode(ids)
                at = np.concatenate([[0], np.cumsum(bpe.token_size[ids])])[ends]
                rows = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(n.astype(np.int64)), _binary(ids.astype("<u4"), 4 * ends), _binary(raw, at)],
                    names=[*batch.schema.names, "n_tokens", "ids", "decoded"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(lean(task), f"{names}, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)})
