"""Collaborative filtering on the implicit-feedback matrix (MLC1).

The reference builds the ALS input (AGG1) and only *claims* a model; this
trains ``pyspark.ml`` ALS with implicit preferences on it, ranks all items
for every user, and measures the ranking on held-out pairs.

* Ids of any size: ALS wants 32-bit numbers, so users and products are
  numbered by ``frames.assign_ids`` (distributed) and named again at the end.
* ``top_items`` finds each user's best items without scoring users x items.
  Item factors are written once in blocks of falling norm. A user's score of an
  item is at most |user| * |item|, so a task reads blocks in that order and
  stops for a user once the largest norm of a block's part cannot reach the
  user's ``n``-th score. The result equals full scoring; nothing is cut. A worker
  holds one block and one batch of users; nothing passes the driver.
* ALS is iterative; its lineage is cut with checkpoints in the session's
  shared checkpoint folder every ``checkpoint_interval`` iterations.

Ties are ranked by ProductID. Rows with a NULL user or product are no feedback.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.frames import assign_ids
from shelfspark.session import scratch_path, written

BLOCK_ITEMS = 16_384
#: Items that a batch of users is scored against at once: their bound is that of the first one.
PART_ITEMS = 2_048
BATCH_USERS = 1_024
RECS = "CustomerID long, rank int, ProductID long, rating double"


def _numbered(data: DataFrame, col: str, name: str) -> DataFrame:
    """(col, name): the distinct values numbered 1, 2, ... in their order."""
    ids = data.select(col).distinct()
    return written(assign_ids(ids, ids.where("false"), col, [col], name).select(col, F.col(name).cast("int").alias(name)),
                   f"als-{name}")


def als_factors(interactions: DataFrame, rank: int = 10, max_iter: int = 5, reg: float = 0.1, alpha: float = 1.0,
                seed: int = 42, checkpoint_interval: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train on (CustomerID, ProductID, interaction_score); returns
    (CustomerID, features) and (ProductID, features)."""
    from pyspark.ml.recommendation import ALS

    # written: the users, the items and the ratings are three readings of one plan
    data = written(interactions.where(F.col("CustomerID").isNotNull() & F.col("ProductID").isNotNull()).select(
        "CustomerID", "ProductID", F.col("interaction_score").cast("float").alias("rating")), "als-interactions")
    users, items = _numbered(data, "CustomerID", "user"), _numbered(data, "ProductID", "item")
    rows = written(data.join(users, "CustomerID").join(items, "ProductID").select("user", "item", "rating"), "als-ratings")
    if rows.isEmpty():
        empty = "array<float>"
        return (users.select("CustomerID", F.lit(None).cast(empty).alias("features")),
                items.select("ProductID", F.lit(None).cast(empty).alias("features")))
    model = ALS(userCol="user", itemCol="item", ratingCol="rating", implicitPrefs=True, rank=rank, maxIter=max_iter,
                regParam=reg, alpha=alpha, seed=seed, coldStartStrategy="drop",
                checkpointInterval=checkpoint_interval).fit(rows)
    named = lambda ids, name, factors: ids.join(factors.withColumnRenamed("id", name), name).drop(name)
    return (written(named(users, "user", model.userFactors), "als-users"),
            written(named(items, "item", model.itemFactors), "als-items"))


def norm_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS) -> str:
    """Writes (ProductID, features) as blocks of falling norm; returns the folder."""
    path = scratch_path(items.sparkSession, "als-blocks")
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    ranked = assign_ids(items.withColumn("norm", norm).withColumn("less", -F.col("norm")), items.where("false"), "ProductID",
                        ["less", "ProductID"], "place")
    block = F.floor((F.col("place") - 1) / block_items).cast("int")
    ranked.select("ProductID", "features", "norm", block.alias("block")).repartition("block").write.partitionBy("block").parquet(path)
    return path


class _Blocks:
    """The blocks of a folder, in order; the last one read is kept."""

    def __init__(self, folder: str):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.held: tuple[int, tuple | None] = (-1, None)

    def __call__(self, k: int):
        """Parts (ids, factors, largest norm) of block ``k`` by falling norm; None beyond the last."""
        if self.held[0] != k:
            files = [f.path for f in self.store.get_file_info(fs.FileSelector(f"{self.path}/block={k}", allow_not_found=True))
                     if f.path.endswith(".parquet")]
            tables = []
            for name in sorted(files):
                with self.store.open_input_file(name) as f:
                    tables.append(pq.ParquetFile(f).read(columns=["ProductID", "features", "norm"]))
            table = pa.concat_tables(tables) if tables else None
            self.held = k, None if table is None else self._parts(table)
        return self.held[1]

    @staticmethod
    def _parts(table: pa.Table) -> list[tuple]:
        norm = table.column("norm").to_numpy()
        order = np.argsort(-norm, kind="stable")
        ids, factors, norm = table.column("ProductID").to_numpy()[order], _matrix(table.column("features"))[order], norm[order]
        return [(ids[a:a + PART_ITEMS], factors[a:a + PART_ITEMS], float(norm[a])) for a in range(0, len(ids), PART_ITEMS)]


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _seen_places(item: np.ndarray, order: np.ndarray, who: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``item``) of the pairs (``who``: row, ``what``: item) whose item is there; ``order`` sorts ``item``."""
    at = order[np.minimum(np.searchsorted(item, what, sorter=order), len(item) - 1)]
    there = item[at] == what
    return who[there], at[there]


def _best(users: np.ndarray, seen: list, blocks: _Blocks, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores (users x n, -inf where a user has fewer) and how many scores were worked out."""
    score, ids = np.full((len(users), n), -np.inf), np.full((len(users), n), np.iinfo(np.int64).max)
    norm, k, live, done = np.linalg.norm(users, axis=1), 0, np.arange(len(users)), 0
    size = [0 if x is None else len(x) for x in seen]
    who, what = np.repeat(np.arange(len(users)), size), np.concatenate([np.zeros(0, np.int64), *[x for x in seen if x is not None]])
    while len(live) and (block := blocks(k)) is not None:
        for item, factors, largest in block:
            live = live[norm[live] * largest * (1 + 1e-9) >= score[live, -1]]  # no later item scores higher
            if not len(live):
                break
            own = users[live] @ factors.T
            done += own.size
            row = np.full(len(users), -1)
            row[live] = np.arange(len(live))
            mine = row[who] >= 0
            own[_seen_places(item, np.argsort(item), row[who[mine]], what[mine])] = -np.inf
            # only what reaches the n-th score so far counts; of more than n, ties at the n-th are kept for the order by id
            least = score[live, -1:]
            if len(item) > n:
                least = np.maximum(least, -np.partition(-own, n - 1, axis=1)[:, n - 1:n])
            i, j = np.nonzero((own >= least) & (own > -np.inf))
            better, i = live[np.unique(i)], live[i]
            # the rows' earlier best and these, by row, falling score and id: the first n of each row
            i = np.concatenate([np.repeat(better, n), i])
            s, d = np.concatenate([score[better].reshape(-1), own[row[i[len(better) * n:]], j]]), np.concatenate([ids[better].reshape(-1), item[j]])
            order = np.lexsort((d, -s, i))
            i, s, d = i[order], s[order], d[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            top = place < n
            score[i[top], place[top]], ids[i[top], place[top]] = s[top], d[top]
        k += 1
    return ids, score, done


def top_items(users: DataFrame, items: DataFrame, n: int = 10, seen: DataFrame | None = None,
              block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Each user's ``n`` best items by the product of factors: (CustomerID, rank,
    ProductID, rating). ``seen`` (CustomerID, ProductID) pairs are not recommended."""
    folder = norm_blocks(items, block_items)
    rows = users.where("features IS NOT NULL").select("CustomerID", "features")
    if seen is not None:
        known = seen.groupBy("CustomerID").agg(F.collect_set("ProductID").alias("seen"))
        rows = rows.join(known, "CustomerID", "left")
    else:
        rows = rows.withColumn("seen", F.lit(None).cast("array<bigint>"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(folder)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_USERS):
                part = batch.slice(k, BATCH_USERS)
                known = [None if x is None else np.array(x, np.int64) for x in part.column(2).to_pylist()]
                ids, score, _ = _best(_matrix(part.column(1)), known, blocks, n)
                user, place = np.nonzero(score > -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(user)), pa.array((place + 1).astype(np.int32)),
                     pa.array(ids[user, place]), pa.array(score[user, place])], names=["CustomerID", "rank", "ProductID", "rating"])

    return rows.mapInArrow(task, RECS)


def als_recommendations(interactions: DataFrame, n: int = 10, **params) -> DataFrame:
    """Top-``n`` ALS recommendations per user: (CustomerID, rank, ProductID, rating)."""
    users, items = als_factors(interactions, **params)
    return top_items(users, items, n)


def ranking_quality(recs: DataFrame, held_out: DataFrame, n: int = 10) -> DataFrame:
    """How well ranked ``recs`` (CustomerID, rank, ProductID) find ``held_out``
    (CustomerID, ProductID) pairs: one row with users, pairs, hits and the means
    over users of hit_rate, precision, recall and ndcg at ``n``. Users with held-out
    pairs and without recommendations count with zeros."""
    truth = held_out.select("CustomerID", "ProductID").distinct()
    total = truth.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("pairs"))
    gain = F.log(F.lit(2.0)) / F.log(F.col("rank") + 1.0)
    found = (recs.where(F.col("rank") <= n).join(truth, ["CustomerID", "ProductID"]).groupBy("CustomerID")
                 .agg(F.count(F.lit(1)).alias("hits"), F.sum(gain).alias("dcg")))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("pairs", F.lit(n)).cast("int")), F.lit(0.0),
                        lambda s, k: s + F.log(F.lit(2.0)) / F.log(k + 1.0))
    hits = F.coalesce("hits", F.lit(0))
    return total.join(found, "CustomerID", "left").agg(
        F.count(F.lit(1)).alias("users"), F.sum("pairs").alias("pairs"), F.sum(hits).alias("hits"),
        F.avg((hits > 0).cast("double")).alias("hit_rate"), F.avg(hits / F.lit(n)).alias("precision"),
        F.avg(hits / F.col("pairs")).alias("recall"), F.avg(F.coalesce("dcg", F.lit(0.0)) / ideal).alias("ndcg"))


def held_out_ranking(interactions: DataFrame, n: int = 10, every: int = 5, **params) -> DataFrame:
    """Train without every ``every``-th (user, product) pair, chosen by the pair's
    hash, rank the products a user did not train on, and measure the rest; the
    same measure of the most bought products beside it. Rows: model, then the
    columns of ``ranking_quality``."""
    out = F.pmod(F.xxhash64("CustomerID", "ProductID"), F.lit(every)) == 0
    data = written(interactions.where(F.col("CustomerID").isNotNull() & F.col("ProductID").isNotNull())
                               .select("CustomerID", "ProductID", "interaction_score", out.alias("held_out")), "als-split")
    train, test = data.where(~F.col("held_out")), data.where("held_out")
    users, items = als_factors(train, **params)
    # popularity as a one-factor model: every user is 1, a product its number of buyers
    one = lambda x: F.array(x.cast("float")).alias("features")
    buyers = train.groupBy("ProductID").agg(F.count(F.lit(1)).alias("c")).select("ProductID", one(F.col("c")))
    everyone = train.select("CustomerID").distinct().select("CustomerID", one(F.lit(1)))
    return (ranking_quality(top_items(users, items, n, train), test, n).select(F.lit("als").alias("model"), "*")
            .unionByName(ranking_quality(top_items(everyone, buyers, n, train), test, n).select(F.lit("popularity").alias("model"), "*")))
