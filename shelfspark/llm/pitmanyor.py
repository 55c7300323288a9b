"""Language-model scores by a hierarchical Pitman-Yor model.

A text is a sequence of words and one end token. Each word is seated in the
restaurant of the word before it (the first one in that of the end token), whose
parent is one restaurant of all words: its customers are the tables of the word
contexts. Its base measure spells words: byte by byte, each byte seated in
the restaurant of the ORDER - 1 bytes before it, whose parent is the restaurant
of one byte less, down to the empty context over uniform bytes. So all contexts
share parents, and a word that was never seen still has its spelling's
probability.

Seating is sampled by Gibbs: given the other restaurants, the number of tables
of a dish is drawn by seating its customers one after another (from the 64th on
in growing groups whose chance of a new table is taken at the group's start).
Draws follow from hashes of the dish, sweep and sample, so scores do not depend on
how rows are dealt to tasks.
A sweep goes from the longest contexts to the shortest, as a restaurant's
customers are its children's tables. After BURN_IN sweeps SAMPLES are kept, and
predictive probabilities are averaged over them.

All counts cover all training texts. Words and word pairs (context, word) are
shuffled tables, counted with map-side aggregation; a pair seen once has one
table, so only the others are joined with their words and seated again, in
PAIR_SWEEPS sweeps. Byte contexts are dealt to tasks by their last byte.
Scoring sums log10 of each word's probability without its context, of each
context's weight of its parent, and each seen pair's gain over that. It looks up
at most FREQUENT words and FREQUENT pairs in memory, all others by joins on their
hashes. The spelling model is bounded by the distinct byte sequences of length
ORDER.

Null and empty texts are scored as the end token alone; without any training
text all probabilities come from the base measure.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import shared
from shelfspark.llm.words import Texts, mix, small_batches, span_hashes, texts
from shelfspark.session import scratch_path, written

ORDER = 5
DISCOUNT, STRENGTH = 0.75, 1.0
BURN_IN, SAMPLES = 2, 3
PAIR_SWEEPS = 2
FREQUENT = 1_000_000
_SHARDS = 16
_SEATED = [f"{c}{s}" for c in ("customers", "tables") for s in range(SAMPLES)]
_BEFORE, _AFTER = 0x20, 0x0A  # bytes that no word holds: before its first, after its last
_END = int(span_hashes(np.array([_AFTER], np.uint8), np.zeros(1, np.int64), np.ones(1, np.int64)).view(np.int64)[0])


def uniform(keys: np.ndarray, at: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that follow from 64-bit keys and the draw's number ``at``
    alone: the same whatever rows are in one batch, also after a lost task."""
    h = mix(keys + np.atleast_1d(np.asarray(at, np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def binomial(n: np.ndarray, p: np.ndarray, keys: np.ndarray, at: int) -> np.ndarray:
    """Binomial draws by ``keys``: customer by customer in groups of up to 64, by
    the inverse of the distribution for few successes, else by its normal limit."""
    out = np.zeros(len(n))
    small = n <= 64
    if small.any():
        some, most = np.flatnonzero(small), int(n[small].max())
        u = uniform(keys[some, None], at + np.arange(most))
        out[some] = ((u < p[some, None]) & (np.arange(most) < n[some, None])).sum(1)
    few = ~small & (n * p <= 16)
    if few.any():
        some = np.flatnonzero(few)
        u, q, m = uniform(keys[some], at), p[some], n[some].astype(np.float64)
        term = np.exp(m * np.log1p(-np.minimum(q, 0.5)))
        total, k = term.copy(), np.zeros(len(some))
        for j in range(1, 129):
            up = u > total
            if not up.any():
                break
            k[up] = j
            term = term * (m - j + 1) / j * q / (1 - q)
            total += term
        out[some] = np.minimum(k, m)
    many = ~small & ~few
    if many.any():
        some = np.flatnonzero(many)
        u, v = uniform(keys[some], at), uniform(keys[some], at + 1)
        normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
        q, m = p[some], n[some].astype(np.float64)
        out[some] = np.clip(np.rint(m * q + normal * np.sqrt(m * q * (1 - q))), 0, m)
    return out


def draw_keys(keys: np.ndarray, sweep: int, sample: int) -> np.ndarray:
    """One stream of draws for each key, sweep and sample."""
    stream = np.uint64((1 + sweep * SAMPLES + sample) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    return mix(mix(keys.astype(np.int64).view(np.uint64)) + stream)


def seat(customers: np.ndarray, fresh: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Tables of each dish after its customers sat down; ``fresh`` is the weight
    of a new table, (strength + discount * tables) * parent probability, ``keys``
    (``draw_keys``) are the dishes' streams of draws."""
    order = np.argsort(-customers, kind="stable")
    c, a, key = customers[order], fresh[order], keys[order]
    t = np.minimum(c, 1).astype(np.float64)
    seated, step = 1, 1
    live = int(np.searchsorted(-c, -1, "left"))  # those with more than one customer
    while live:
        chance = np.clip(a[:live] / (a[:live] + seated - DISCOUNT * t[:live]), 0, 1)
        if step == 1:
            t[:live] += uniform(key[:live], seated) < chance
        else:
            t[:live] += binomial(np.minimum(step, c[:live] - seated), chance, key[:live], seated)
        seated += step
        step = max(1, seated // 32) if seated >= 64 else 1
        live = int(np.searchsorted(-c[:live], -seated, "left"))
    out = np.empty(len(c))
    out[order] = t
    return out


class Restaurants:
    """All restaurants of one depth below a last context byte: cells (context,
    byte) with customers and tables, sorted, and the place of each cell's
    context and of its parent's cell."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells  # context << 8 | byte
        self.contexts, self.of = np.unique(cells >> 8, return_inverse=True)

    def totals(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, x, len(self.contexts))


def gibbs(cells: np.ndarray, counts: np.ndarray, top: np.ndarray) -> list[list[tuple]]:
    """Samples of the seating of all restaurants with contexts of 1 .. ORDER - 1
    bytes. ``top``: the probability of each byte in the empty context. Of each
    sample, for each depth: (cells, customers, tables)."""
    levels: list[Restaurants] = []
    up = []  # place of each cell of depth j in depth j - 1
    cells_j = cells
    for depth in range(ORDER - 1, 0, -1):
        levels.append(Restaurants(cells_j))
        if depth > 1:
            context = (cells_j >> 8) & ((1 << 8 * (depth - 1)) - 1)
            parents, place = np.unique(context << 8 | (cells_j & 255), return_inverse=True)
            up.append(place)
            cells_j = parents
    customers = [counts.astype(np.int64)]
    for place, level in zip(up, levels[1:]):
        customers.append(np.bincount(place, minlength=len(level.cells)))
    tables = [np.minimum(c, 1).astype(np.float64) for c in customers]
    samples = []
    for sweep in range(BURN_IN + SAMPLES):
        predictive = [None] * len(levels)
        for k in range(len(levels) - 1, -1, -1):
            level = levels[k]
            parent = top[level.cells & 255] if k == len(levels) - 1 else predictive[k + 1][up[k]]
            total, seats = level.totals(customers[k])[level.of], level.totals(tables[k])[level.of]
            predictive[k] = (customers[k] - DISCOUNT * tables[k] + (STRENGTH + DISCOUNT * seats) * parent) / (STRENGTH + total)
        for k, level in enumerate(levels):
            parent = top[level.cells & 255] if k == len(levels) - 1 else predictive[k + 1][up[k]]
            seats = level.totals(tables[k])[level.of]
            tables[k] = seat(customers[k], (STRENGTH + DISCOUNT * seats) * parent, draw_keys(level.cells * 8 + k, sweep, 0))
            if k + 1 < len(levels):
                customers[k + 1] = np.bincount(up[k], tables[k], len(levels[k + 1].cells)).astype(np.int64)
        if sweep >= BURN_IN:
            samples.append([(level.cells, customers[k].copy(), tables[k].copy()) for k, level in enumerate(levels)])
    return samples


def spelled(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (ORDER - 1 bytes before, byte) of all words with their ends, and each word's length."""
    size = ends - starts
    lead = ORDER - 1
    at = np.cumsum(size + lead + 1) - (size + lead + 1)
    line = np.full(int((size + lead + 1).sum()), _BEFORE, np.int64)
    inner = np.repeat(at + lead - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    source = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    line[inner] = raw[source]
    line[at + lead + size] = _AFTER
    cell = line[lead:].copy()
    for k in range(1, lead + 1):
        cell += line[lead - k: len(line) - k] << (8 * k)
    keep = np.ones(len(line), bool)  # a word's own leading places start no cell
    for k in range(lead):
        keep[at + k] = False
    return cell[keep[lead:]], size + 1


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(words), np.uint8), ends - size, ends


class Spelling:
    """The averaged samples of all byte restaurants, for lookups."""

    def __init__(self, top: np.ndarray, places: list[list[str]]):
        self.top, self.parts = top, {}  # (samples, 256); the files of each depth's cells
        for depth, files in enumerate(places, 1):
            cells, *seated = _arrays(files, "cell", *_SEATED)
            c, k = (np.stack(x, 1).astype(float) for x in (seated[:SAMPLES], seated[SAMPLES:]))
            contexts, first = np.unique(cells >> 8, return_index=True)
            self.parts |= {f"contexts{depth}": contexts, f"cells{depth}": cells, f"kept{depth}": c - DISCOUNT * k}
            for name, x in (("total", c), ("seats", k)):
                self.parts[f"{name}{depth}"] = np.add.reduceat(x, first, axis=0) if len(cells) else x

    def words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of each word's spelling, averaged over the samples; long words don't underflow."""
        cells, size = spelled(raw, starts, ends)
        distinct, back = np.unique(cells, return_inverse=True)
        logs = np.log(self._cells(distinct))[back]
        first = np.cumsum(size) - size
        if not len(size):
            return np.zeros(0)
        logs = np.add.reduceat(logs, first, axis=0)
        top = logs.max(1)
        return (top + np.log(np.exp(logs - top[:, None]).mean(1))) / np.log(10)

    def _cells(self, cells: np.ndarray) -> np.ndarray:
        p = self.top[:, cells & 255].T.copy()
        for depth in range(1, ORDER):
            context = (cells >> 8) & ((1 << 8 * depth) - 1)
            cell = context << 8 | (cells & 255)
            keys, known = self.parts[f"contexts{depth}"], self.parts[f"cells{depth}"]
            if not len(keys):
                continue
            u = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
            seen = keys[u] == context
            w = np.minimum(np.searchsorted(known, cell), len(known) - 1)
            own = (known[w] == cell)[:, None]
            total, seats = self.parts[f"total{depth}"][u], self.parts[f"seats{depth}"][u]
            kept = np.where(own, self.parts[f"kept{depth}"][w], 0.0)
            p = np.where(seen[:, None], (kept + (STRENGTH + DISCOUNT * seats) * p) / (STRENGTH + total), p)
        return p


@dataclass
class Model:
    spelling: tuple[np.ndarray, list[list[str]]]  # the empty context's samples, the places of each depth's cells
    vocabulary: DataFrame  # hash, c, p1, room, logs of words and end token, see _seat_words
    pairs: DataFrame  # context, word, c, tables (averaged)
    frequent: list[str]  # places of the frequent words' arrays
    at_least: int  # count from which a word is frequent
    frequent_pairs: list[str]  # places of the frequent pairs' gains
    pairs_at_least: int
    tokens: int  # N
    kinds: int  # V
    ends: int  # training texts
    unseen: float  # log10 of the weight of an unseen word's spelling
    end: float  # log10 of the end token's probability without its context, and of the start's weight of its parent


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(context.view(np.uint64)) + word.view(np.uint64)).view(np.int64)


def sequence(x: Texts, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, context, word) of all tokens, the end tokens too; ``hashes`` are the words'."""
    n = len(x)
    row = x.words_of()
    size = np.diff(x.row_word) + 1
    word = np.full(len(hashes) + n, _END, np.int64)
    word[np.arange(len(hashes)) + row] = hashes
    context = np.empty_like(word)
    context[1:], context[:1] = word[:-1], _END  # an end token comes before the next text's first
    return np.repeat(np.arange(n), size), context, word


def pair_counts(docs: DataFrame, text: str) -> DataFrame:
    """(context, word, c) over all texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(0), lower=True):
                _, context, word = sequence(t, t.hashes().view(np.int64))
                _, where, n = np.unique(pair_keys(context, word), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(context[where]), pa.array(word[where]), pa.array(n.astype(np.int64))],
                                                 names=["context", "word", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(task, "context long, word long, n long")
    return rows.groupBy("context", "word").agg(F.sum("n").alias("c"))


def _at_least(df: DataFrame, limit: int) -> int:
    """The lowest count from which at most ``limit`` rows are, by counts in steps of an eighth of a power of two."""
    bins = sorted(((r["bin"], r["n"]) for r in df.groupBy(F.floor(F.log2("c") * 8).cast("int").alias("bin")).agg(
        F.count("*").alias("n")).collect()), reverse=True)
    at_least, held = 1 << 62, 0
    for b, n in bins:
        if held + n > limit:
            break
        held, at_least = held + n, int(np.ceil(2 ** (b / 8) - 1e-9))
    return at_least


def _files(df: DataFrame, key: str, folder: str, name: str) -> list[str]:
    """Writes the columns of ``df`` as arrays sorted by ``key``; returns their places."""
    columns = df.columns

    def pack(table: pa.Table) -> pa.Table:
        out = io.BytesIO()
        order = np.argsort(table.column(key).to_numpy())
        np.savez(out, **{c: table.column(c).to_numpy()[order] for c in columns})
        return pa.table({"path": [shared.put(folder, f"{name}.npz", out.getvalue())]})

    shards = df.withColumn("shard", F.pmod(key, F.lit(_SHARDS))).groupBy("shard").applyInArrow(pack, "path string")
    return [r["path"] for r in written(shards, f"{name}-files").collect()]


def _arrays(places: list[str], key: str, *columns: str) -> list[np.ndarray]:
    """The key, sorted, and the columns of all files; a single zero row without files, whose key is never looked for."""
    parts = []
    for place in places:
        with np.load(io.BytesIO(shared.get(place))) as z:
            parts.append([z[c] for c in (key, *columns)])
    if not parts:
        return [np.zeros(0, np.int64), *[np.zeros(1)] * len(columns)]
    out = [np.concatenate(x) for x in zip(*parts)]
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _seat_words(weighed: DataFrame, single: DataFrame, more: DataFrame | None, name: str) -> tuple[DataFrame, float, float]:
    """The words' own restaurant, given the pairs' tables: ``weighed`` with p1 (the
    probability without a context), room (the weight of the parent in the word's
    restaurant as a context) and logs (log10 of p1, plus log10 of the parent's
    share in that restaurant); and this restaurant's averaged tables and customers."""
    sums = lambda by, out: more.groupBy(F.col(by).alias("hash")).agg(
        *[F.sum(f"t{s}").alias(f"{out}{s}") for s in range(SAMPLES)])
    seated = weighed.join(single, "hash", "left")
    if more is not None:
        seated = seated.join(sums("word", "k"), "hash", "left").join(sums("context", "r"), "hash", "left")
    own = lambda c: F.coalesce(F.col(c) if c in seated.columns else F.lit(None), F.lit(0)).cast("long")
    seated = written(seated.select("hash", "c", "p", *[(own("one") + own(f"k{s}")).alias(f"k{s}") for s in range(SAMPLES)], (
        own("ones") + sum(own(f"r{s}") for s in range(SAMPLES)) / F.lit(float(SAMPLES))).alias("held")), f"{name}-customers")
    all_k = [float(x) for x in seated.agg(*[F.coalesce(F.sum(f"k{s}"), F.lit(0)) for s in range(SAMPLES)]).first()]
    tables = float(seated.count())

    def sit(fresh: float, sweep: int):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h, p = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                k = [batch.column(3 + s).to_numpy() for s in range(SAMPLES)]
                t = sum(seat(x, fresh * 10.0 ** p, draw_keys(h, sweep, s)) for s, x in enumerate(k)) / SAMPLES
                yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in range(3)], pa.array(sum(k) / SAMPLES),
                                                  batch.column(3 + SAMPLES), pa.array(t)],
                                                 names=["hash", "c", "p", "k", "held", "tables"])
        return seated.mapInArrow(task, "hash long, c long, p double, k double, held double, tables double")

    for sweep in range(2):  # the second sweep's seating follows the first one's number of tables
        out = written(sit(STRENGTH + DISCOUNT * tables, sweep), name)
        tables = float(out.agg(F.coalesce(F.sum("tables"), F.lit(0.0))).first()[0])
    customers = sum(all_k) / SAMPLES
    p1 = (F.col("k") - F.lit(DISCOUNT) * F.col("tables") + F.lit(STRENGTH + DISCOUNT * tables) * F.pow(F.lit(10.0), F.col("p"))) \
        / F.lit(STRENGTH + customers)
    room = F.lit(STRENGTH) + F.lit(DISCOUNT) * F.col("held")
    out = out.select("hash", "c", p1.alias("p1"), room.alias("room"))
    return out.withColumn("logs", F.log10("p1") + F.log10(F.col("room") / (F.col("c") + F.lit(STRENGTH)))), tables, customers


def _seat_pairs(more: DataFrame, words: DataFrame, sweep: int, name: str) -> DataFrame:
    """The tables of the pairs seen more than once, SAMPLES times, given their words and contexts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pair_keys(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            c, fresh = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(j) for j in range(3)], *[pa.array(seat(c, fresh, draw_keys(keys, sweep, s)).astype(np.int64)) for s in range(SAMPLES)]],
                names=["context", "word", "c", *[f"t{s}" for s in range(SAMPLES)]])

    rows = more.select("context", "word", "c").join(words.select(F.col("hash").alias("word"), "p1"), "word").join(
        words.select(F.col("hash").alias("context"), "room"), "context")
    return written(rows.select("context", "word", "c", (F.col("p1") * F.col("room")).alias("fresh")).mapInArrow(
        task, "context long, word long, c long, " + ", ".join(f"t{s} long" for s in range(SAMPLES))), name)


def _gains(pairs: DataFrame, vocabulary: DataFrame, places: list[str], at_least: int) -> DataFrame:
    """(pair, gain): log10 of a seen pair's probability over its parent's share."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, p1, room = _arrays(places, "hash", "p1", "room")
        for batch in batches:
            context, word, own = (batch.column(k).to_numpy() for k in range(3))
            a, has_a = _find(known, context)
            b, has_b = _find(known, word)
            share = np.where(has_a & has_b, room[a] * p1[b], np.nan)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pair_keys(context, word)), batch.column(2),
                                              pa.array(share)], names=["context", "word", "pair", "own", "share"])

    kind = "context long, word long, pair long, own double, share double"
    rows = pairs.select("context", "word", (F.col("c") - F.lit(DISCOUNT) * F.col("tables")).alias("own")).mapInArrow(task, kind)
    gain = F.log10(F.col("own") / F.col("share") + 1).alias("gain")
    out = rows.where(~F.isnan("share")).select("pair", gain)
    if at_least <= 1:  # all words are in memory
        return out
    rest = rows.where(F.isnan("share")).drop("share").join(vocabulary.select(F.col("hash").alias("word"), "p1"), "word").join(
        vocabulary.select(F.col("hash").alias("context"), "room"), "context").withColumn("share", F.col("p1") * F.col("room"))
    return out.unionByName(rest.select("pair", gain))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all texts, A-Z in lower case."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(0), lower=True):
                _, where, n = np.unique(t.hashes(), return_index=True, return_counts=True)
                raw = t.data.tobytes()
                words = [raw[a:b] for a, b in zip(t.starts[where].tolist(), t.ends[where].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n.astype(np.int64))], names=["word", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(task, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("c"))


def fit(docs: DataFrame, text: str = "text", folder: str | None = None, frequent: int = FREQUENT) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "pitman-yor")
    counts = written(word_counts(docs, text), "word-counts")
    ends = docs.count()
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, n = np.unique(spelled(*_flat(batch.column(0).to_pylist()))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n.astype(np.int64))], names=["cell", "n"])

    cells = written(counts.select("word").mapInArrow(spell, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")),
                    "spelling-cells")
    by_byte = cells.groupBy(F.expr("cell & 255").cast("int").alias("byte")).agg(F.sum("n").alias("n")).collect()  # 256 rows at most
    start = np.full(256, 0.5)
    for r in by_byte:
        start[r["byte"]] += r["n"]
    start /= start.sum()

    def seats(table: pa.Table) -> pa.Table:
        cell, n = table.column("cell").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(cell)
        out = []
        for s, levels in enumerate(gibbs(cell[order], n[order], start)):
            for k, (own, customers, tables) in enumerate(levels):
                out.append(pa.table({"sample": pa.array(np.full(len(own), s, np.int32)),
                                     "depth": pa.array(np.full(len(own), ORDER - 1 - k, np.int32)), "cell": own,
                                     "customers": customers, "tables": tables.astype(np.int64)}))
        return pa.concat_tables(out)

    samples = written(cells.withColumn("shard", F.expr("(cell >> 8) & 255").cast("int")).groupBy("shard").applyInArrow(
        seats, "sample int, depth int, cell long, customers long, tables long"), "seating")
    # the empty context: its customers are the tables of the one-byte contexts
    roots = samples.where("depth = 1").groupBy("sample", F.expr("cell & 255").cast("int").alias("byte")).agg(
        F.sum("tables").alias("n")).collect()  # at most SAMPLES * 256 rows
    top = np.zeros((SAMPLES, 256))
    for s in range(SAMPLES):
        c = np.zeros(256, np.int64)
        for r in roots:
            if r["sample"] == s:
                c[r["byte"]] = r["n"]
        t = np.minimum(c, 1).astype(float)
        for sweep in range(BURN_IN):
            t = seat(c, (STRENGTH + DISCOUNT * t.sum()) / 256 * np.ones(256), draw_keys(np.arange(256), sweep, s))
        top[s] = (c - DISCOUNT * t + (STRENGTH + DISCOUNT * t.sum()) / 256) / (STRENGTH + c.sum())
    seated = [F.sum(F.when(F.col("sample") == s, F.col(c))).alias(f"{c}{s}") for c in ("customers", "tables") for s in range(SAMPLES)]
    spelling = (top, [_files(samples.where(F.col("depth") == depth).groupBy("cell").agg(*seated), "cell", folder, f"spelling{depth}")
                      for depth in range(1, ORDER)])

    one_end = 1.0 / 256  # the end token is one more word, of even weight

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Spelling(*spelling)
        for batch in batches:
            raw, a, b = _flat(batch.column(0).to_pylist())
            p = model.words(raw, a, b) + np.log10(1 - one_end)
            yield pa.RecordBatch.from_arrays([pa.array(span_hashes(raw, a, b).view(np.int64)), batch.column(1), pa.array(p)],
                                             names=["hash", "c", "p"])

    weighed = counts.select("word", "c").mapInArrow(weigh, "hash long, c long, p double")
    if ends:
        weighed = weighed.unionByName(spark.createDataFrame([(_END, ends, float(np.log10(one_end)))], "hash long, c long, p double"))
    weighed = written(weighed, "word-weights")
    pairs = written(pair_counts(docs, text), "pair-counts")
    once = pairs.where("c = 1")
    single = written(once.groupBy(F.col("word").alias("hash")).agg(F.count("*").alias("one")).join(
        once.groupBy(F.col("context").alias("hash")).agg(F.count("*").alias("ones")), "hash", "full"), "single-pairs")
    more = pairs.where("c > 1").select("context", "word", "c", *[F.lit(1).cast("long").alias(f"t{s}") for s in range(SAMPLES)])
    words, tables, customers = _seat_words(weighed, single, more, "words")
    for sweep in range(PAIR_SWEEPS):
        more = _seat_pairs(more, words, sweep, "pair-seating")
        words, tables, customers = _seat_words(weighed, single, more, "words")
    vocabulary = written(words, "vocabulary")
    mean = sum(F.col(f"t{s}") for s in range(SAMPLES)) / F.lit(float(SAMPLES))
    seated = once.select("context", "word", "c", F.lit(1.0).alias("tables")).unionByName(
        more.select("context", "word", "c", mean.alias("tables")))
    at_least, pairs_at_least = _at_least(vocabulary, frequent), _at_least(pairs, frequent)
    places = _files(vocabulary.where(F.col("c") >= at_least), "hash", folder, "words")
    gains = _files(_gains(seated.where(F.col("c") >= pairs_at_least), vocabulary, places, at_least), "pair", folder, "pairs")
    unseen = float(np.log10((STRENGTH + DISCOUNT * tables) / (STRENGTH + customers)))
    at_end = vocabulary.where(F.col("hash") == _END).first()
    return Model(spelling, vocabulary, seated, places, at_least, gains, pairs_at_least, int(total) + ends, int(kinds) + (ends > 0),
                 ends, unseen + float(np.log10(1 - one_end)), at_end["logs"] if at_end else unseen + float(np.log10(one_end)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score and score (log10 probabilities) of every text."""
    small_batches(docs.sparkSession)
    all_n, kinds, ends, unseen, end_score = model.tokens, model.kinds, model.ends, model.unseen, model.end
    denominator = all_n + 0.5 * (kinds + 1)
    end_base = float(np.log10((ends + 0.5) / denominator))
    places, pair_places, spelling = model.frequent, model.frequent_pairs, model.spelling

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = Spelling(*spelling)
        known, c, logs = _arrays(places, "hash", "c", "logs")
        base = np.log10((c + 0.5) / denominator)
        often_pairs, gains = _arrays(pair_places, "pair", "gain")
        for batch in batches:
            for x in texts(batch.column(2), lower=True):
                words, where, inverse = np.unique(x.hashes().view(np.int64), return_index=True, return_inverse=True)
                at, often = _find(known, words)
                row, place, hit = x.words_of(), at[inverse], often[inverse]
                n = len(x)
                sums = [np.bincount(row[hit], v, n).astype(float) for v in (base[place[hit]], logs[place[hit]])]
                whose, context, word = sequence(x, words[inverse])
                keys = pair_keys(context, word)
                spot, seen = _find(often_pairs, keys)
                sums[1] += np.bincount(whose[seen], gains[spot[seen]], n)
                whose, keys = whose[~seen], keys[~seen]
                order = np.lexsort((keys, whose))
                whose, keys = whose[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (whose[1:] != whose[:-1]) | (keys[1:] != keys[:-1])
                head = np.flatnonzero(new)
                held = np.searchsorted(whose[head], np.arange(n + 1)).astype(np.int32)
                rare = np.flatnonzero(~often)
                spelt = np.zeros(len(words))
                if len(rare):
                    spelt[rare] = spell.words(x.data, x.starts[where[rare]], x.ends[where[rare]])
                pair, times = np.unique(row[~hit].astype(np.int64) * len(words) + inverse[~hit], return_counts=True) \
                    if len(words) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                who, which = (pair // len(words), pair % len(words)) if len(words) else (pair, pair)
                bounds = np.searchsorted(who, np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in
                         (words[which], times.astype(np.int64), spelt[which])]
                lists += [pa.ListArray.from_arrays(pa.array(held), pa.array(v)) for v in
                          (keys[head], np.diff(head, append=len(keys)).astype(np.int32))]
                rows = batch.slice(x.first, n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(np.diff(x.row_word).astype(np.int64) + 1),
                     pa.array(np.bincount(row[hit], minlength=n).astype(np.int64)), *map(pa.array, sums), *lists],
                    names=["row", "id", "n_tokens", "n_often", "base", "logs", "hash", "n", "p", "pair", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.col(text).cast("string").alias("text"))
    first = written(rows.mapInArrow(task, "row long, id long, n_tokens long, n_often long, base double, logs double, "
                                          "hash array<long>, n array<long>, p array<double>, pair array<long>, times array<int>"), "frequent-scores")
    rare = first.where(F.size("hash") > 0).select("row", F.explode(F.arrays_zip("hash", "n", "p")).alias("x")) \
        .select("row", "x.hash", "x.n", "x.p")
    known = model.vocabulary.where(F.col("c") < model.at_least).select("hash", "c", "logs")
    c = F.coalesce("c", F.lit(0))
    own = F.coalesce("logs", F.col("p") + F.lit(unseen))  # log10: a long word's weight is below the least double
    rest = rare.join(known, "hash", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(denominator))).alias("rare_base"),
        F.sum(F.col("n") * own).alias("rare_logs"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_rare"))

    gains = _gains(model.pairs.where(F.col("c") < model.pairs_at_least), model.vocabulary, places, model.at_least)
    pairs = first.where(F.size("pair") > 0).select("row", F.explode(F.arrays_zip("pair", "times")).alias("x"))
    paired = pairs.select("row", "x.pair", "x.times").join(gains, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("gain")).alias("pair_logs"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return first.select("row", "id", "n_tokens", "n_often", "base", "logs").join(rest, "row", "left").join(paired, "row", "left").select(
        "id", "n_tokens", (F.col("n_often") + zero("n_rare") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        (F.col("base") + zero("rare_base") + F.lit(end_base)).alias("base_score"),
        (F.col("logs") + zero("rare_logs") + zero("pair_logs") + F.lit(end_score)).alias("score"))
