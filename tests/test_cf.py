"""ALS on 64-bit ids, norm-bounded ranking against full scoring, ranking measures."""

import math

import numpy as np
import pytest

from shelfspark.operators import cf


def factors(spark, rng, n, key, base, spread=1.0):
    rows = [(base + i, [float(x) for x in rng.normal(0, math.exp(spread * rng.normal()), 4).astype(np.float32)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{key} long, features array<float>")


@pytest.mark.parametrize("block_items", [7, 64, 10_000])
def test_top_items_equal_full_scoring(spark, block_items):
    rng = np.random.default_rng(3)
    users, udf = factors(spark, rng, 40, "CustomerID", 1 << 40)
    items, _ = factors(spark, rng, 150, "ProductID", 1 << 41)
    items += [((1 << 42) + k, items[k][1]) for k in range(20)]  # equal scores: lower id first
    users.append((5, [0.0, 0.0, 0.0, 0.0]))
    idf = spark.createDataFrame(items, "ProductID long, features array<float>").repartition(3)
    udf = spark.createDataFrame(users, "CustomerID long, features array<float>").repartition(3)
    seen = [(users[0][0], items[k][0]) for k in range(0, 150, 2)] + [(users[1][0], i) for i, _ in items[3:]]
    sdf = spark.createDataFrame(seen, "CustomerID long, ProductID long")
    for pairs in (set(), set(seen)):
        want = []
        for u, f in users:
            all_ = sorted((-round(float(np.dot(np.array(f), np.array(g))), 9), i) for i, g in items if (u, i) not in pairs)
            want += [(u, k + 1, -s) for k, (s, _) in enumerate(all_[:10])]
        got = cf.top_items(udf, idf, 10, sdf if pairs else None, block_items).collect()
        assert sorted((r.CustomerID, r["rank"], round(r.rating, 9) + 0.0) for r in got) == sorted((a, b, c + 0.0) for a, b, c in want)
        assert not {(r.CustomerID, r.ProductID) for r in got} & pairs
    zero = [r.ProductID for r in cf.top_items(udf, idf, 10, None, block_items).where("CustomerID = 5").orderBy("rank").collect()]
    assert zero == sorted(i for i, _ in items)[:10]


def test_bound_spares_scores(spark):
    rng = np.random.default_rng(5)
    items, idf = factors(spark, rng, 3000, "ProductID", 0, 2.0)
    blocks = cf._Blocks(cf.norm_blocks(idf, 100))
    users = rng.normal(size=(50, 4))
    ids, score, done = cf._best(users, [None] * 50, blocks, 10)
    full = users @ np.array([f for _, f in items]).T
    assert np.allclose(score, -np.sort(-full, axis=1)[:, :10])
    assert done < 0.5 * full.size


def test_als_takes_any_ids(spark):
    rng = np.random.default_rng(1)
    rows = [((1 << 50) + int(u), (1 << 60) + int(i), 1) for u in range(30) for i in rng.choice(20, 6, False)] + [(None, 3, 1), (4, None, 1)]
    data = spark.createDataFrame(rows, "CustomerID long, ProductID long, interaction_score long")
    got = cf.als_recommendations(data, n=5, max_iter=2).collect()
    assert {r.CustomerID for r in got} == {(1 << 50) + u for u in range(30)}
    assert all((1 << 60) <= r.ProductID < (1 << 60) + 20 for r in got) and len(got) == 150
    assert cf.als_recommendations(data.where("false")).collect() == []


def test_ranking_quality(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 1, 10), (9, 1, 10)], "CustomerID long, rank int, ProductID long")
    truth = spark.createDataFrame([(1, 11), (1, 12), (1, 99), (2, 98), (3, 10)], "CustomerID long, ProductID long")
    r = cf.ranking_quality(recs, truth, 3).first()
    g = [1 / math.log2(k + 1) for k in (1, 2, 3)]
    assert (r.users, r.pairs, r.hits) == (3, 5, 2)
    assert r.hit_rate == pytest.approx(1 / 3) and r.precision == pytest.approx(2 / 9) and r.recall == pytest.approx(2 / 9)
    assert r.ndcg == pytest.approx((g[1] + g[2]) / sum(g) / 3)


def test_held_out_ranking_finds_structure(spark):
    """Users of one half buy products of one half only: ALS must beat popularity."""
    rng = np.random.default_rng(2)
    rows = [(int(u), int(i) * 2 + u % 2, 1) for u in range(120) for i in rng.choice(30, 12, False)]
    got = {r.model: r for r in cf.held_out_ranking(spark.createDataFrame(rows, "CustomerID long, ProductID long, interaction_score long")).collect()}
    assert got["als"].recall > 1.3 * got["popularity"].recall > 0


def test_training_reads_its_rows_once(spark):
    """The interactions may be a long plan: users, items and ratings come from one run of it."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = [(u, i, 1) for u in range(12) for i in range(5)]
    data = spark.createDataFrame(rows, "CustomerID long, ProductID long, interaction_score long")
    cf.als_factors(data.mapInArrow(count, data.schema), max_iter=1)
    assert runs.value == len(rows)


def test_parts_of_a_block_have_their_own_bound(spark):
    """A user is done within a block, not only at the end of one."""
    rng = np.random.default_rng(6)
    items, idf = factors(spark, rng, 6000, "ProductID", 0, 2.0)
    blocks = cf._Blocks(cf.norm_blocks(idf, 10_000))
    users = rng.normal(size=(50, 4))
    seen = [np.array([i for i, _ in items[:40]]) if k % 2 else None for k in range(50)]
    ids, score, done = cf._best(users, seen, blocks, 10)
    full = users @ np.array([f for _, f in items]).T
    full[1::2, :40] = -np.inf
    assert np.allclose(score, -np.sort(-full, axis=1)[:, :10])
    assert done < full.size
