"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

1. One pass sketches each text: the digest of its word sequence, the size of
   its set of word shingles, and COORDINATES MinHash values from two
   permutations. The first one, a 64-bit hash, scatters the shingles over a
   universe of 2^20 places; the second, an array, is read shifted by k places
   for coordinate k, so no further hash function is computed.
2. Texts of one digest are copies: one of them stands for all.
3. Coordinates are banded. Rows that share a band meet in a bucket. The rows of
   a bucket of more than BLOCK are dealt to blocks, and about PIVOTS of them to
   each of its blocks, so no row goes to more than one block but for these.
   Within a block the signatures tell which pairs can be similar at all; of those
   a spanning forest is taken, best estimates first, not all pairs.
4. The forest's pairs are verified on their full shingle sets and the links
   joined to components. Only buckets that still hold several components go on;
   there the rows outside the bucket's largest component meet each other and all
   of that component, block by block, so the work grows with what is still open.
   Sets of up to EXACT shingles go along and settle a pair on the spot; of larger
   ones signatures of LONG coordinates do. Again a forest between components comes
   first, then every pair of different components that can be similar and was not
   tried. So no link between components is lost, and what leaves a bucket beyond
   the forests is only pairs with a larger set that lie just below the threshold.

A pair at the threshold misses all 32 bands with probability 5e-8, and falls
below the bounds of the signatures (0.65 of 128, 0.745 of 1024 at 0.8) with
probability 1e-5.

Nulls and texts without words have an empty set and are linked with nothing.
Rows of one doc_id are documents of their own; a component's id is its smallest
doc_id (null only if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import LEAN_BATCH, LEAN_SLICE, Texts, lean, mix, small_batches, texts
from shelfspark.session import written

SHINGLE, PERCENT = 5, 80
UNIVERSE_BITS = 20
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Signatures that agree in fewer than PERCENT / 100 - MARGIN of the coordinates are not verified.
MARGIN = 0.15
#: Coordinates of the signatures that settle what the first forest left open, and their margin.
LONG, LONG_MARGIN = 1024, 0.055
#: Sets of up to so many shingles go along whole, instead of a long signature.
EXACT = 1024
#: Rows of one block, and rows of a larger bucket that go to all of its blocks, about.
BLOCK, PIVOTS = 2048, 16
#: Pairs that are held at once within a block, and shingles whose coordinates are.
WAVE, GATHER = 2_000_000, 2048
#: Texts of at most so many candidates are picked by a broadcast join.
BROADCAST_ROWS = 1_000_000

_perm: list[np.ndarray] = []


def permutation() -> np.ndarray:
    """The second permutation, followed by its own first LONG values."""
    if not _perm:
        p = np.random.default_rng(20).permutation(1 << UNIVERSE_BITS).astype(np.int32)
        _perm.append(np.concatenate([p, p[:LONG]]))
    return _perm[0]


def digests(t: Texts, words: np.ndarray) -> np.ndarray:
    """(n, 2) 64-bit digests of each row's sequence of word hashes."""
    n = len(words)
    out = []
    for salt, base in ((0, 0x9E3779B97F4A7C15), (0x632BE59BD9B4E019, 0xD6E8FEB86659FD93)):
        power = np.full(n + 1, base, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ np.uint64(salt)) * power[:n])])
        a, b = t.row_word[:-1], t.row_word[1:]
        out.append(mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)))
    return np.stack(out, 1)


def shingle_sets(t: Texts, words: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's sorted distinct shingle hashes; a row of 1 to k-1 words has one shingle."""
    n = len(words)
    h = words.copy()
    for j in range(1, k):
        h[: max(0, n - j)] = mix(h[: max(0, n - j)] * np.uint64(0x9FB21C651E98DF25) + words[j:])
    out = []
    for a, b in zip(t.row_word[:-1].tolist(), t.row_word[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(h[a:b - k + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for i in range(a, b):
                one = mix(one * np.uint64(3) + words[i:i + 1])
            out.append(one)
        else:
            out.append(words[:0])
    return out


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """(n, coordinates) MinHash values; 0 for empty sets. A shingle's coordinates
    lie side by side in the second permutation, from its place in the first on."""
    out = np.zeros((len(sets), coordinates), np.int32)
    shifted = np.lib.stride_tricks.sliding_window_view(permutation(), coordinates)
    for i, own in enumerate(sets):
        place = (mix(own) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
        for at in range(0, len(place), GATHER):
            least = shifted[place[at:at + GATHER]].min(0)
            out[i] = np.minimum(out[i], least) if at else least
    return out


def _bytes(sig: np.ndarray) -> list[bytes]:
    """A byte of each coordinate, by row."""
    return [x.tobytes() for x in (mix(sig) & np.uint64(255)).astype(np.uint8)]


def sketches(docs: DataFrame, id_col: str, text: str, shingle: int, row_col: str | None = None) -> DataFrame:
    """row, id, a, b (digest), n (set size), sig (a byte per coordinate)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(2), lower=True, limit=LEAN_SLICE):
                words = t.hashes()
                digest, sets = digests(t, words).view(np.int64), shingle_sets(t, words, shingle)
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                rows = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(n),
                     pa.array(_bytes(signatures(sets).astype(np.uint64)), pa.binary())],
                    names=["row", "id", "a", "b", "n", "sig"])

    row = F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(task), "row long, id long, a long, b long, n long, sig binary")


def band_keys(sig: Column) -> Column:
    """The keys of a signature's bands: ROWS coordinates each."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda k: F.xxhash64(k, F.substring(sig, k * ROWS + 1, F.lit(ROWS))))


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many numbers two sorted arrays of distinct ones share."""
    if len(x) < len(y):
        x, y = y, x
    return int((x[np.minimum(x.searchsorted(y), len(x) - 1)] == y).sum()) if len(x) else 0


def short_set(x: np.ndarray) -> bytes:
    """The set by the upper halves of its hashes."""
    return np.unique((mix(x) >> np.uint64(32)).astype(np.uint32)).tobytes()


class Bucketed:
    """Rows of some buckets, those of one key next to each other."""

    def __init__(self, part: pa.Table, percent: int):
        self.key, self.node, self.n, self.group = (part.column(c).to_numpy() for c in ("key", "node", "n", "group"))
        self.percent = percent
        self.sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(len(self.key), -1)
        more = "shingles" in part.column_names
        self.sets = [None if x is None else np.frombuffer(x, np.uint32) for x in part.column("shingles").to_pylist()] if more else None
        self.long = [None if x is None else np.frombuffer(x, np.uint8) for x in part.column("long").to_pylist()] if more else None

    def similar(self, i: int, j: int) -> bool:
        """Whether the two sets can be similar enough by what is at hand."""
        if self.sets is None:
            return True
        x, y, n, m = self.sets[i], self.sets[j], int(self.n[i]), int(self.n[j])
        if x is not None and y is not None:
            both = _shared(x, y) + n - len(x) + m - len(y)  # at least as many as the whole hashes share
            return 100 * both >= self.percent * (n + m - both)
        if self.long[i] is not None and self.long[j] is not None:
            return (self.long[i] == self.long[j]).sum() >= int(np.ceil(LONG * (self.percent / 100 - LONG_MARGIN)))
        return True

    def waves(self) -> Iterator[np.ndarray]:
        """(i, j, agreeing coordinates) of the pairs of one key that lie in different
        groups and whose sizes and signatures allow them to be similar."""
        bound, step, held, n = int(np.ceil(COORDINATES * (self.percent / 100 - MARGIN))), 1, [], len(self.key)
        while step < n:
            i = np.flatnonzero(self.key[step:] == self.key[:-step])
            if not len(i):
                break
            j = i + step
            small, large = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
            can = (100 * small >= self.percent * large) & (self.group[i] != self.group[j])
            i, j = i[can], j[can]
            for at in range(0, len(i), 5000):
                x, y = i[at:at + 5000], j[at:at + 5000]
                agree = (self.sig[x] == self.sig[y]).sum(1)
                go = agree >= bound
                if go.any():
                    held.append(np.stack([x[go], y[go], agree[go]], 1).astype(np.int32))
            step += 1
            if sum(map(len, held)) >= WAVE:
                yield np.concatenate(held)
                held = []
        if held:
            yield np.concatenate(held)

    def pairs(self, forest: bool) -> np.ndarray:
        """(u, v) with u < v of the pairs that can be similar; with ``forest`` a
        spanning forest of each key's groups, best agreement first."""
        found: list[tuple[int, int]] = []
        place = np.zeros(0, np.int64)
        if forest:
            _, place = np.unique(np.stack([self.key, self.group], 1), axis=0, return_inverse=True)
            place = place.reshape(-1)
        parent = np.arange(int(place.max(initial=-1)) + 1)

        def root(v: int) -> int:
            while (up := parent[v]) != v:
                parent[v] = v = parent[up]
            return v

        for wave in self.waves():
            if not forest:
                found += [(i, j) for i, j in wave[:, :2].tolist() if self.similar(i, j)]
                continue
            wave = wave[np.argsort(-wave[:, 2], kind="stable")]
            for at in range(0, len(wave), 20_000):
                while (parent != parent[parent]).any():
                    parent = parent[parent]
                some = wave[at:at + 20_000, :2]
                some = some[parent[place[some[:, 0]]] != parent[place[some[:, 1]]]]
                for i, j in some.tolist():
                    if (p := root(place[i])) != (q := root(place[j])) and self.similar(i, j):
                        parent[p] = q
                        found.append((i, j))
        at = np.array(found, np.int64).reshape(-1, 2)
        u, v = self.node[at[:, 0]], self.node[at[:, 1]]
        return np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)


def first_blocks(members: DataFrame) -> DataFrame:
    """``members`` (key, bucket: its size, node, ..) with the blocks of each row as ``blocks``."""
    n = F.ceil(F.col("bucket") / BLOCK).cast("int")
    pivot = F.pmod(F.xxhash64("node", F.lit("pivot")), F.ceil(F.col("bucket") / PIVOTS).cast("int")) == 0
    own = F.array(F.pmod(F.xxhash64("node"), n).cast("int"))
    blocks = F.when((n > 1) & pivot, F.sequence(F.lit(0), n - 1)).otherwise(own)
    return members.withColumn("blocks", F.transform(blocks, lambda k: F.xxhash64("key", k)))


def open_blocks(members: DataFrame) -> DataFrame:
    """``members`` (key, node, group, ..) of the keys that hold several groups with
    ``blocks``: blocks of the rows outside the key's largest group meet each other
    and the blocks of that group, whose rows do not meet."""
    sizes = members.groupBy("key", "group").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.count("*").alias("groups"), F.sum("n").alias("rows"), F.max(F.struct("n", "group")).alias("main"))
    mixed = largest.where("groups > 1").select("key", "rows", F.col("main.group").alias("main"), F.col("main.n").alias("main_rows"))
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    rest, main = count(F.col("rows") - F.col("main_rows")), count(F.col("main_rows"))
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    among = F.transform(every(rest), lambda k: F.xxhash64("key", F.lit("rest"), F.least(place(rest), k), F.greatest(place(rest), k)))
    across = F.transform(every(main), lambda k: F.xxhash64("key", F.lit("main"), place(rest), k))
    of_main = F.transform(every(rest), lambda k: F.xxhash64("key", F.lit("main"), k, place(main)))
    blocks = (F.when(F.col("rows") <= BLOCK, F.array("key"))
              .when(F.col("group") == F.col("main"), of_main).otherwise(F.concat(among, across)))
    return members.join(mixed, "key").withColumn("blocks", blocks).drop("rows", "main", "main_rows")


def candidate_pairs(dealt: DataFrame, percent: int, forest: bool) -> DataFrame:
    """(u, v) with u < v from rows (blocks, node, n, sig, group and, if there, long and shingles)."""
    more = [c for c in ("shingles", "long") if c in dealt.columns]
    rows = dealt.select(F.explode("blocks").alias("key"), "node", "n", "group", "sig", *more)
    rows = rows.repartition("key").sortWithinPartitions("key", "node")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.Table) -> pa.RecordBatch:
            pairs = Bucketed(part, percent).pairs(forest)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part]).combine_chunks()
            key = held.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if last:
                yield work(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield work(held)

    return rows.mapInArrow(lean(task), "u long, v long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = _shared(p, q)
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(lean(task), "u long, v long")


def _are_stars(e: DataFrame) -> bool:
    """Whether each larger node has one edge and none is also a smaller one."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes that are not their component's smallest, the
    root. Large-star and small-star steps on written tables until the edges are stars."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (of ``components``) after further links: only the components that
    they join take part, each as its root."""
    own = lambda side: comp.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
    roots = links.join(own("u"), "u", "left").join(own("v"), "v", "left").select(
        F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"))
    joined = components(roots)
    onward = joined.select(F.col("node").alias("root"), F.col("root").alias("onward"))
    moved = comp.join(onward, "root", "left").select("node", F.coalesce("onward", "root").alias("root"))
    return written(moved.unionByName(joined), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, row_col: str | None = None) -> DataFrame:
    """One row per document: row (``row_col`` if given, else numbered here), id, n_shingles, component (a row number that
    its members share), component_id, and first: whether it stands for its
    component (smallest id, then row; null ids last)."""
    small_batches(docs.sparkSession, LEAN_BATCH)
    sk = written(sketches(docs, id_col, text, shingle, row_col), "sketches")
    full = sk.where("n > 0")
    node = full.groupBy("a", "b").agg(F.min("row").alias("node"), F.min_by("id", "row").alias("any_id"))
    node = written(node, "nodes")
    reps = full.join(node.select(F.col("node").alias("row")), "row").select("row", "n", "sig")
    keys = reps.select(F.col("row").alias("node"), F.explode(band_keys(F.col("sig"))).alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("bucket")).where("bucket > 1")
    shared = written(keys.join(buckets, "key"), "buckets")
    sig = reps.select(F.col("row").alias("node"), "n", "sig")
    signed = first_blocks(shared).join(sig, "node").withColumn("group", F.col("node"))
    pairs = written(candidate_pairs(signed, percent, forest=True), "pairs")

    def from_texts(some: DataFrame, long: bool) -> DataFrame:
        """(node, shingles) of ``some`` (node); with ``long`` short sets, of up to EXACT
        alone, and long signatures of those that a larger set can be similar to."""
        ids = written(some.distinct().join(node, "node"), "wanted")
        wanted = ids.select(F.col("any_id").alias("want")).distinct()
        if wanted.count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        own = own.join(wanted, F.col("id").eqNullSafe(F.col("want")), "left_semi").select("text")

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in texts(batch.column(0), lower=True, limit=LEAN_SLICE):
                    words = t.hashes()
                    d, sets = digests(t, words).view(np.int64), shingle_sets(t, words, shingle)
                    raw, sig = [x.tobytes() for x in sets], [None] * len(sets)
                    if long:
                        raw = [short_set(x) if len(x) <= EXACT else None for x in sets]
                        for k in [k for k, x in enumerate(sets) if 100 * len(x) > percent * EXACT]:
                            sig[k] = _bytes(signatures([sets[k]], LONG).astype(np.uint64))[0]
                    yield pa.RecordBatch.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(raw, pa.binary()),
                                                      pa.array(sig, pa.binary())], names=["a", "b", "shingles", "long"])

        found = own.mapInArrow(lean(task), "a long, b long, shingles binary, long binary")
        # rows of one id may hold other texts, or several copies of one: one value per digest
        one = found.join(ids.select("a", "b", "node"), ["a", "b"]).dropDuplicates(["node"])
        return one.select("node", "shingles", *(["long"] if long else []))

    def linked(some: DataFrame, name: str) -> DataFrame:
        sets = from_texts(some.select(F.explode(F.array("u", "v")).alias("node")), long=False)
        return written(verified(some, sets, percent), name)

    comp = components(linked(pairs, "links"))
    held = None
    for forest in (True, False):
        # buckets that hold rows of several components
        rest = (shared.select("key", "node") if held is None else held.drop("group", "blocks")).join(comp, "node", "left")
        rest = open_blocks(rest.withColumn("group", F.coalesce("root", "node")).drop("root"))
        if held is None:
            rest = written(rest, "open-buckets")
            sets = written(from_texts(rest.select("node"), long=True), "open-sets")
        held = rest
        several = held.join(sig, "node").join(sets, "node")
        more = written(candidate_pairs(several, percent, forest).join(pairs, ["u", "v"], "left_anti"), "more-pairs")
        if more.isEmpty():  # the forest may hold tried pairs alone, and leave others to the last turn
            continue
        late = linked(more, "more-links")
        pairs = pairs.unionByName(more)
        if not late.isEmpty():
            comp = merged(comp, late)

    rows = (sk.select("row", "id", "n", "a", "b").join(node.select("a", "b", "node"), ["a", "b"], "left")
            .join(comp, "node", "left")
            .select("row", "id", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).otherwise(F.col("row")).alias("component")))
    rows = written(rows, "members")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    heads = rows.groupBy("component").agg(F.min(order).alias("head"))
    return rows.join(heads, "component").select(
        "row", "id", F.col("n").alias("n_shingles"), "component", F.col("head.id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("first"))
