"""Spelling variants: words one edit apart, found by asymmetric chunks.

1. ``words`` counts the words of all texts. A task counts a slice of texts at
   once; the counts are summed by word with a map-side combine.
2. ``near`` finds all pairs of words that one inserted, deleted or replaced code
   point parts. The word that is not the longer one contributes two disjoint
   chunks, its halves; the other contributes its positional grams of that length
   at the places where a chunk can lie: its start, and its end, which is shifted
   by one if it is the longer word. One edit leaves one chunk whole, so the two
   meet under that chunk, its position and the lengths. Candidates are verified
   by their edit distance.
3. A chunk that over HOT words share on both sides is not joined: its words are
   dealt again by the same rule over the rest of the word, the gap in which the
   edit must lie, until no chunk is hot or the gap is down to the edit itself,
   where only one alphabet of words is left. Candidates thus grow with the words,
   not with the square of a common syllable, and no pair is lost.
4. ``group`` gives each word its form, the near word with the largest count if
   that is at least RATIO times its own, and its root. Counts grow by RATIO along
   a chain of forms, so doubling steps of a bounded number end it.

Runs are maximal matches of [A-Za-zÀ-ÿ]+; only A-Z are lower-cased. In a
run whose crc32 of ``<id>:<run>`` is a multiple of DROP_EVERY the code point at
crc32 % length is left out (DROP_EVERY None: nothing is). Null and empty texts
have no words; a null id is an empty one; rows count one by one, repeated or not;
other columns are not read. Ties between forms go to the smallest word in
code-point order. Two words with one 64-bit hash in one slice of texts would count
as one (odds about 10^-9 a slice).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import LOWER, SLICE_BYTES, Texts, column_bytes, cut, ragged, small_batches
from shelfspark.session import written

MIN_LENGTH, MIN_COUNT, RATIO, DROP_EVERY = 6, 5, 5, 199
#: Words that share a chunk on both sides beyond which they are dealt by the rest of the word.
HOT = 16
#: Bytes of a run whose checksum is worked out in numpy; longer ones go to zlib one by one.
_SHORT = 64

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True


def _zero_byte_table() -> np.ndarray:
    """What a zero byte does to a CRC-32 register, by the register's low byte."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1, (v >> 1) ^ np.uint32(0xEDB88320), v >> 1)
    return v


_ZERO_BYTE = _zero_byte_table()


def run_texts(column) -> Iterator[Texts]:
    """The rows of a string column in slices, cut into lower-cased runs of letters."""
    data, bounds = column_bytes(column)
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE_BYTES, "right")) - 1)
        part = data[bounds[i]:bounds[j]]
        letter = _LETTER[part]
        letter[1:] |= part[:-1] == 0xC3  # U+00C0 to U+00FF are two bytes, the first of them C3
        yield cut(np.where(letter, LOWER[part], 0x20).astype(np.uint8), bounds[i:j + 1] - bounds[i], i)
        i = j


def run_checksums(part: Texts, ids: list[bytes], word: np.ndarray, vocab: list[bytes]) -> np.ndarray:
    """CRC-32 of ``<id>:<run>`` for each run of the slice. The checksum of two
    strings in a row is the first's, moved by the second's length, xor the second's."""
    head = np.fromiter((zlib.crc32(x + b":") for x in ids), np.uint32, len(ids))
    size, row = part.ends - part.starts, part.words_of()
    out = np.fromiter(map(zlib.crc32, vocab), np.uint32, len(vocab))[word]
    order = np.argsort(size, kind="stable")
    at, moved = np.searchsorted(size[order], np.arange(_SHORT + 2)), head.copy()
    for n in range(1, _SHORT + 1):
        moved = _ZERO_BYTE[moved & 0xFF] ^ (moved >> 8)
        own = order[at[n]:at[n + 1]]
        out[own] ^= moved[row[own]]
    for k in order[at[_SHORT + 1]:].tolist():
        out[k] = zlib.crc32(vocab[word[k]], int(head[row[k]]))
    return out


def _count_task(min_length: int, drop_every: int | None):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in run_texts(batch.column(1)):
                if not len(part.starts):
                    continue
                _, where, word = np.unique(part.hashes(), return_index=True, return_inverse=True)
                start, end = part.starts[where], part.ends[where]
                raw = part.data.tobytes()
                vocab = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
                count, more = np.bincount(word, minlength=len(vocab)), []
                if drop_every:
                    ids = [(x or "").encode() for x in batch.column(0).slice(part.first, len(part)).to_pylist()]
                    check = run_checksums(part, ids, word, vocab)
                    for k in np.flatnonzero(check % drop_every == 0).tolist():
                        text = vocab[word[k]].decode()
                        count[word[k]] -= 1
                        p = int(check[k]) % len(text)
                        more.append(text[:p] + text[p + 1:])
                inner = np.concatenate([[0], np.cumsum((part.data & 0xC0) == 0x80)])
                long = np.flatnonzero((end - start - inner[end] + inner[start] >= min_length) & (count > 0))
                size = end[long] - start[long]
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                same = pa.Array.from_buffers(pa.string(), len(long), [None, pa.py_buffer(at), pa.py_buffer(ragged(part.data, start[long], size))])
                yield pa.RecordBatch.from_arrays([same, pa.array(count[long])], names=["word", "n"])
                more = [x for x in more if len(x) >= min_length]
                yield pa.RecordBatch.from_arrays([pa.array(more, pa.string()), pa.array(np.ones(len(more), np.int64))], names=["word", "n"])

    return task


def words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
          min_count: int = MIN_COUNT, drop_every: int | None = DROP_EVERY) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points and ``min_count`` occurrences."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(_count_task(min_length, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- words one edit apart -----------------------------------------------------
# A row stands for a word under one key. ``more``: the longer word's surplus (0
# or 1); ``size``: the length of the word with the chunks; the gap [a, b) of that
# word is what is not yet known to be equal.
_ROW = ["side", "more", "size", "a", "b", "word"]


def _key() -> Column:
    """Hash of the lengths, the gap and everything outside the gap, in own positions."""
    surplus = F.when(F.col("side") == "gram", F.col("more")).otherwise(0)
    outside = F.concat(F.col("word").substr(F.lit(1), F.col("a")), F.lit("\x00"),
                       F.col("word").substr(F.col("b") + surplus + 1, F.length("word")))
    return F.xxhash64("more", "size", "a", "b", outside)


def _halves(a: Column, b: Column, more: Column) -> Column:
    """The gaps that are left if one half of [a, b) is equal; a gap of one ends at its sides."""
    mid = F.floor((a + b) / 2).cast("int")
    gap = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    return (F.when(b - a > 1, F.array(gap(mid, b), gap(a, mid)))
             .when((b - a == 1) & (more == 1), F.array(gap(a, a), gap(b, b)))
             .otherwise(F.array(gap(a, b))))


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row under the keys of its two chunks (or grams)."""
    split = rows.withColumn("gap", F.explode(_halves(F.col("a"), F.col("b"), F.col("more"))))
    return (split.select("side", "more", "size", F.col("gap.a").alias("a"), F.col("gap.b").alias("b"), "word")
                 .withColumn("key", _key()))


def _sides(table: DataFrame) -> DataFrame:
    """Each word as the one with chunks, and as the one with grams, of equal length and longer."""
    as_side = lambda s, more: F.struct(F.lit(s).alias("side"), F.lit(more).alias("more"))
    rows = table.withColumn("as", F.explode(F.array(*[as_side(s, m) for s in ("chunk", "gram") for m in (0, 1)])))
    size = F.length("word") - F.when(F.col("as.side") == "gram", F.col("as.more")).otherwise(0)
    return (rows.select("as.side", "as.more", size.alias("size"), "word").where("size > 0")
                .select("side", "more", "size", F.lit(0).alias("a"), F.col("size").alias("b"), "word"))


def near(table: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, other): each word of the table (a distinct ``word`` column) with
    each of its near words, every pair in both orders, once."""
    found = []
    rows = _dealt(_sides(table))
    while True:
        both = rows.groupBy("key").agg(F.count_if(F.col("side") == "chunk").alias("chunks"),
                                       F.count_if(F.col("side") == "gram").alias("grams"))
        many = written(both.where(F.least("chunks", "grams") > hot).select("key"), "variant-hot-keys")
        last = F.col("b") - F.col("a") == 1 - F.col("more")  # the gap is the edit itself
        some_hot = not many.isEmpty()
        cold = rows.where(last).unionByName(rows.where(~last).join(many, "key", "left_anti")) if some_hot else rows
        x = cold.where("side = 'chunk'").select("key", "more", F.col("word").alias("x"))
        y = cold.where("side = 'gram'").select("key", F.col("word").alias("y"))
        pairs = x.join(y, "key").where(((F.col("more") == 1) | (F.col("x") < F.col("y"))) & (F.levenshtein("x", "y", 1) == 1))
        found.append(written(pairs.select("x", "y").distinct(), "variant-pairs"))
        if not some_hot:
            break
        rows = written(_dealt(rows.where(~last).join(many, "key", "left_semi").select(*_ROW)), "variant-rows")
    pairs = reduce(DataFrame.union, found).distinct()
    both = F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("other")), F.struct(F.col("y").alias("word"), F.col("x").alias("other")))
    return pairs.select(F.explode(both).alias("p")).select("p.word", "p.other")


def group(table: DataFrame, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words``."""
    if ratio < 2:
        raise ValueError("counts must grow along a chain of forms")
    table = written(table.select("word", "n"), "variant-words")
    links = near(table, hot).join(table.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    near_n = -F.col("best.less")
    is_form = near_n >= ratio * F.col("n")
    out = written(table.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, near_n).alias("form_n")), "variant-forms")
    steps = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = out.agg(F.max("n")).first()[0] or 1
    chain = max(1, math.ceil(math.log(most, ratio)))
    for _ in range(math.ceil(math.log2(chain))):  # twice as far along the chain each time
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        steps = written(steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "variant-roots")
    return (out.join(steps, "word", "left")
               .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
