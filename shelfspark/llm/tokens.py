"""Token ids of whole texts, written as token files and read back.

Documents are range-partitioned and sorted by id, so the files of partition 0,
1, ... hold all documents in ascending order (null ids first; rows of one id by
their text's hash). Each task encodes its texts and writes files of about
FILE_IDS ids, whole documents each, to the shared folder; the manifest (place,
partition, number in it, ids before it in the partition) is an ordinary table.
Null and empty texts hold only the end id. Strings of special tokens in a text
become their ids, as in the library's plain call.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm import shared, simple8b
from shelfspark.llm.words import LOWER, SpanCodes, Texts, per_row, small_batches, texts
from shelfspark.session import scratch_path, written

#: Ids in a file before the next is begun.
FILE_IDS = 1 << 20
MANIFEST = "path string, part int, number int, n_rows long, n_ids long, ids array<long>"

Encode = Callable[[list[bytes]], list]
_ASCII_WORD = re.compile(rb"[a-z]+\Z")
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def word_encoder(vocabulary: str) -> Encode:
    """Encodes pieces without white space with the tokenizers library.

    The vocabulary's own rules drop white space and never join pieces across
    it, so the ids of a text are those of its words in order. Pieces of lower-case
    ASCII letters alone go to the vocabulary's model directly.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    model = whole.model

    def encode(pieces: list[bytes]) -> list:
        text = [p.decode("utf-8", "replace") for p in pieces]
        plain = [_ASCII_WORD.match(p) is not None for p in pieces]
        rest = iter(whole.encode_batch([t for t, simple in zip(text, plain) if not simple], add_special_tokens=False))
        return [[x.id for x in model.tokenize(t)] if simple else next(rest).ids for t, simple in zip(text, plain)]

    return encode


_kept: dict[str, SpanCodes] = {}


def span_codes(vocabulary: str) -> SpanCodes:
    """The vocabulary's encoder with the pieces that it has met (SpanCodes bounds
    them), kept by a worker process from one task to the next."""
    if vocabulary not in _kept:
        _kept.clear()
        _kept[vocabulary] = SpanCodes(word_encoder(vocabulary))
    return _kept[vocabulary]


def pieces(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of the pieces of words, and each row's first piece.

    A-Z are lower-cased, as the vocabulary does. Punctuation at a word's end is a
    piece of its own after an ASCII letter or digit. A word with ``<|`` may hold a
    special token, which counts as it is written: it stays as it is and whole.
    """
    data, starts, ends = LOWER[t.data], t.starts, t.ends
    core, live = ends.copy(), np.arange(len(ends))
    while len(live):
        live = live[(core[live] > starts[live]) & _PUNCT[data[core[live] - 1]]]
        core[live] -= 1
    last = data[np.maximum(core - 1, 0)]
    tail = (core < ends) & (core > starts) & (last < 128)
    special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
    if len(special):
        word = np.searchsorted(starts, special, "right") - 1
        tail[word] = False
        for a, b in {(int(starts[w]), int(ends[w])) for w in word.tolist()}:
            data[a:b] = t.data[a:b]
    at = np.cumsum(1 + tail) - (1 + tail)
    total = int((1 + tail).sum())
    first, end = np.empty(total, np.int64), np.empty(total, np.int64)
    first[at], end[at] = starts, np.where(tail, core, ends)
    first[at[tail] + 1], end[at[tail] + 1] = core[tail], ends[tail]
    return data, first, end, np.append(at, total)[t.row_word]


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
          text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the token files; returns their manifest, read from the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part = span_codes(vocabulary), TaskContext.get().partitionId()
        held, lengths, ids, n, before, number = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            sizes = np.concatenate(lengths)
            path = shared.put(folder, f"part-{part:05d}-{number:05d}.s8b",
                              simple8b.dump(np.concatenate(held).astype(np.uint64), sizes, before))
            one = [[path], [part], [number], [len(sizes)], [n], [ids]]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(one, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                                                      pa.list_(pa.int64())))],
                names=["path", "part", "number", "n_rows", "n_ids", "ids"])

        for batch in batches:
            batch_ids = batch.column(0).to_pylist()
            for t in texts(batch.column(1)):
                data, starts, ends, row_piece = pieces(t)
                flat, size = codes(data, starts, ends)
                per = per_row(size, row_piece)
                bounds = np.cumsum(per)
                flat = np.insert(flat, bounds, end_id)  # an end id closes each row
                held.append(flat)
                lengths.append(per + 1)
                ids.extend(batch_ids[t.first:t.first + len(t)])
                n += len(flat)
                if n >= file_ids:
                    yield flush()
                    before, number = before + n, number + 1
                    held, lengths, ids, n = [], [], [], 0
        if ids:
            yield flush()

    return written(rows.mapInArrow(task, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: id, start (ids of all documents
    before it), n_tokens and ids_crc32. Files are unpacked one at a time; the
    only ordered sum outside a partition is over one row per partition."""
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    files = manifest.select("part", "path", "ids").repartition(
        max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths, start = simple8b.load(shared.get(row["path"]))
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (b - n): 4 * b]) for b, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array([row["part"]] * len(crc), pa.int32()),
                     pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["id", "part", "own_start", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(task, "id long, part int, own_start long, n_tokens long, ids_crc32 long")
    return rows.join(parts, "part").select(
        "id", (F.col("own_start") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
