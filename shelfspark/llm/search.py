"""Ranked lexical search over hashed max-sketches.

1. ``index`` cuts every text into terms once and writes a row per document: its
   length, its terms' 64-bit hashes with their counts, and a sketch. A sketch
   coordinate holds the greatest count among the terms that hash to it; an
   impact grows with the count, so the impact of that greatest count is the
   coordinatewise maximum of the document's impacts. Sketches have 2^6 to 2^12
   coordinates, about four to eight for a distinct term.
2. ``search`` takes the items in blocks of about BLOCK_ITEMS and BLOCK_TERMS.
   For a batch of documents one matrix product of sketch impacts and the block's
   term weights, folded the same way, bounds every score from above.
3. Each task rescores an item's documents exactly in descending order of their
   bounds, until the next bound is below the tenth best score that it has seen.
   A task's best rows per item are merged by a window. Nothing is dropped: a
   document is passed over only if ten of the same task surely rank before it.

A term's weight w is floor(1000 ln((2N+2)/(2df+1))); m is 10 + (90 n N) div L; a
score sums w ((10^9 tf) div (1000 tf + 8 m)). N, L and df are over all documents.
Sums are integers below 2^53, so bounds in doubles are exact upper bounds.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII; only
A-Z are lower-cased. Null and empty texts have none and count nowhere. A document
is a row: rows of one id are ranked one by one. Rows of one item id are one item
with all their terms; items without terms have no rows. Equal scores rank by id,
null ids last. Extra columns of either table are not returned. Two terms with one
64-bit hash would count as one (odds about 10^-12 for 10^3 query terms among 10^4
and 10^-6 among 10^10 terms).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.words import SLICE_BYTES, Texts, column_bytes, cut, ragged, small_batches
from shelfspark.session import scratch_path, written

TOP = 10
#: Items and (item, term) pairs of one block, about: what the driver and each task hold of the queries.
BLOCK_ITEMS, BLOCK_TERMS = 256, 20_000
SKETCH_BITS = (6, 12)
#: Sketch coordinates that are worked on at once.
PRODUCT_CELLS = 4_000_000
_NO_ID = np.iinfo(np.int64).max

_TERM = np.arange(256, dtype=np.uint8)
_TERM[65:91] += 32
for _a, _b in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    _TERM[_a:_b] = 0x20


def term_texts(column) -> Iterator[Texts]:
    """The rows of a string column in slices, cut into lower-cased terms."""
    data, bounds = column_bytes(column)
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE_BYTES, "right")) - 1)
        yield cut(_TERM[data[bounds[i]:bounds[j]]], bounds[i:j + 1] - bounds[i], i)
        i = j


def _binary(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: ``counts`` numbers of ``flat`` in each row."""
    at = np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _numbers(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column and how many each row has."""
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(dtype), np.diff(at) // np.dtype(dtype).itemsize


def _index_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in term_texts(batch.column(1)):
            key, row = part.hashes(), part.words_of()
            order = np.lexsort((key, row))
            key, row = key[order], row[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[:len(key)])
            count = np.diff(np.append(first, len(key))).astype(np.int32)
            key, row = key[first], row[first]
            distinct = np.bincount(row, minlength=len(part))
            bits = np.clip(np.ceil(np.log2(np.maximum(4 * distinct, 1))), *SKETCH_BITS).astype(np.int32)
            width = np.where(distinct > 0, 1 << bits, 0)
            slot = (key >> (64 - bits[row]).astype(np.uint64)).astype(np.int64) + (np.cumsum(width) - width)[row]
            new = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])[:len(slot)])
            sketch = np.zeros(int(width.sum()), np.int32)
            if len(new):
                sketch[slot[new]] = np.maximum.reduceat(count, new)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(part.first, len(part)), pa.array(np.diff(part.row_word).astype(np.int64)), pa.array(bits),
                 _binary(key, distinct), _binary(count, distinct), _binary(sketch, width)],
                names=["id", "n", "bits", "keys", "counts", "sketch"])


def index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: id, n (terms with repeats), bits, keys, counts, sketch."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_index_task, "id long, n long, bits int, keys binary, counts binary, sketch binary")
    path = scratch_path(docs.sparkSession, "search-index")
    rows.where("n > 0").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def item_terms(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """The written (item, key) pairs of the items, each once."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in term_texts(batch.column(1)):
                ids = batch.column(0).slice(part.first, len(part)).take(pa.array(part.words_of()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(part.hashes().view(np.int64))], names=["item", "key"])

    rows = items.select(F.col(id_col).alias("item"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    return written(rows.mapInArrow(task, f"item {kind}, key long").distinct(), "item-terms")


def _term_counts(table: DataFrame, vocab: np.ndarray) -> np.ndarray:
    """How many documents hold each term of the sorted ``vocab`` (one block's terms)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab), np.int64)
        for batch in batches:
            keys, _ = _numbers(batch.column(0), np.uint64)
            place = np.minimum(np.searchsorted(vocab, keys), len(vocab) - 1)
            total += np.bincount(place[vocab[place] == keys], minlength=len(vocab))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(len(vocab), np.int64)
    for r in table.select("keys").mapInArrow(task, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


class Block:
    """The queries of one block: term hashes, and each item's weights of them."""

    def __init__(self, item: np.ndarray, key: np.ndarray, n_items: int, df: np.ndarray, vocab: np.ndarray, docs: int, total: int):
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        use = df[np.searchsorted(vocab, key)] > 0  # a term that no document holds adds nothing
        self.item, self.key, self.n_items = item[use], key[use], n_items
        self.vocab, self.docs, self.total = vocab, docs, total
        term = np.searchsorted(vocab, self.key)
        self.weight = weight[term]
        self.exact = np.zeros((n_items, len(vocab)), np.int64)
        self.exact[self.item, term] = self.weight
        self._folded: dict[int, np.ndarray] = {}

    def folded(self, bits: int) -> np.ndarray:
        """Coordinates of a sketch x items: the weights of the terms there."""
        if bits not in self._folded:
            out = np.zeros((1 << bits, self.n_items))
            np.add.at(out, ((self.key >> np.uint64(64 - bits)).astype(np.int64), self.item), self.weight.astype(float))
            self._folded[bits] = out
        return self._folded[bits]


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Documents:
    """A batch of index rows: upper bounds and exact scores."""

    def __init__(self, batch: pa.RecordBatch, block: Block):
        self.block, n = block, batch.column(1).to_numpy()
        self.m = 10 + 90 * n * block.docs // block.total
        self.bits = batch.column(2).to_numpy()
        keys, size = _numbers(batch.column(3), np.uint64)
        counts, _ = _numbers(batch.column(4), np.int32)
        self.sketch, self.width = _numbers(batch.column(5), np.int32)
        place = np.minimum(np.searchsorted(block.vocab, keys), len(block.vocab) - 1)
        hit = np.flatnonzero(block.vocab[place] == keys)
        row = np.repeat(np.arange(len(n)), size)[hit]
        self.term, self.impact = place[hit], _impact(counts[hit], self.m[row])
        self.size = np.bincount(row, minlength=len(n))
        self.at = np.cumsum(self.size) - self.size

    def bounds(self) -> np.ndarray:
        """Documents x items: no score is above."""
        out = np.zeros((len(self.m), self.block.n_items))
        starts = np.cumsum(self.width) - self.width
        for bits in np.unique(self.bits).tolist():
            rows = np.flatnonzero(self.bits == bits)
            step = max(1, PRODUCT_CELLS >> bits)
            for k in range(0, len(rows), step):
                some = rows[k:k + step]
                tf = ragged(self.sketch, starts[some], self.width[some]).reshape(len(some), 1 << bits)
                out[some] = _impact(tf, self.m[some, None]) @ self.block.folded(bits)
        return out

    def scores(self, item: int, rows: np.ndarray) -> np.ndarray:
        n = self.size[rows]
        value = ragged(self.impact, self.at[rows], n) * self.block.exact[item][ragged(self.term, self.at[rows], n)]
        return np.diff(np.concatenate([[0], np.cumsum(value)])[np.concatenate([[0], np.cumsum(n)])])


class Best:
    """The best ``top`` (score, id) pairs of an item so far."""

    def __init__(self, top: int):
        self.top, self.score, self.id = top, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """A score below this is not among the best."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score))
        order = order[score[order] > 0][:self.top]
        self.score, self.id = score[order], ids[order]


def rescore(docs: Documents, ids: np.ndarray, best: list[Best]) -> int:
    """Brings the batch into ``best``; returns how many exact scores it took."""
    bounds, taken = docs.bounds(), 0
    for item, own in enumerate(best):
        rows = np.flatnonzero(bounds[:, item] >= own.least())
        bound = bounds[rows, item]
        order = np.argsort(-bound, kind="stable")
        rows, bound = rows[order], bound[order]
        at, step = 0, 2 * own.top
        while at < len(rows) and bound[at] >= own.least():
            some = rows[at:at + step][bound[at:at + step] >= own.least()]
            own.add(docs.scores(item, some), ids[some])
            taken += len(some)
            at, step = at + step, 2 * step
    return taken


def _search_task(block: Block, items: pa.Array, top: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in range(block.n_items)]
        for batch in batches:
            if batch.num_rows:
                rescore(Documents(batch, block), batch.column(0).fill_null(_NO_ID).to_numpy(), best)
        at = np.repeat(np.arange(block.n_items), [len(b.id) for b in best])
        ids = np.concatenate([b.id for b in best])
        yield pa.RecordBatch.from_arrays([items.take(pa.array(at)), pa.array(ids, mask=ids == _NO_ID),
                                          pa.array(np.concatenate([b.score for b in best]))], names=["item", "id", "score"])

    return task


def search(table: DataFrame, pairs: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item, rank (from 1), id, score: the ``top`` best rows of the index for each item."""
    spark = table.sparkSession
    kind = pairs.schema["item"].dataType.simpleString()
    stats = table.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
    size = pairs.agg(F.countDistinct("item").alias("items") + F.max(F.col("item").isNull().cast("int")), F.count("*")).first()
    if not stats["docs"] or not size[1]:
        return spark.createDataFrame([], f"item {kind}, rank int, id long, score long")
    blocks = max(-(-size[0] // block_items), -(-size[1] // block_terms))
    found = []
    for b in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        if not own.num_rows:
            continue
        coded = own.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
        key = own.column("key").to_numpy().view(np.uint64)
        vocab = np.unique(key)
        block = Block(coded.indices.to_numpy(), key, len(coded.dictionary), _term_counts(table, vocab), vocab,
                      stats["docs"], stats["total"])
        found.append(table.select("id", "n", "bits", "keys", "counts", "sketch")
                          .mapInArrow(_search_task(block, coded.dictionary, top), f"item {kind}, id long, score long"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item", "rank", "id", "score")
