"""Generic helpers: top_n with a hot key, histogram, assign_ids."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.functions.frames import assign_ids, histogram, latest_by, top_k, top_n


def test_top_n_hot_key(spark):
    # one key holds a third of all rows
    df = spark.range(0, 3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                     F.col("id").alias("v"))
    out = top_n(df, "k", F.col("v").desc(), 5).where("k = 0").orderBy(F.desc("v")).collect()
    assert [r.v for r in out] == [2997, 2994, 2991, 2988, 2985]
    plan = top_n(df, "k", F.col("v").desc(), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_by_and_top_k(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (2, 2)], "k int, v int")
    assert sorted(tuple(r) for r in latest_by(df, "k", F.col("v").desc()).collect()) == [(1, 3), (2, 2)]
    assert [r.v for r in top_k(df, [F.col("v").desc()], 2).collect()] == [3, 2]


def test_histogram_matches_numpy(spark):
    vals = [0.0, 0.5, 1.0, 2.5, 3.3, 9.9, 10.0, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.bin: r.n for r in histogram(df, "x", 5).collect()}
    counts, _ = np.histogram([v for v in vals if v is not None], bins=5)
    assert got == {i: int(c) for i, c in enumerate(counts) if c}


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [(r.bin, r.n) for r in histogram(df, "x", 10).collect()] == [(0, 2)]


def test_histogram_of_spread_and_skewed_values(spark):
    """Cells that edges cross, tiny and negative values, many equal ones."""
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(0, 1, 4000), np.exp(rng.normal(0, 8, 1000)) * 1e-9, [0.0] * 2000, [-5.0, 5.0, 5e-324, -1e-310]])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(7)
    for bins in (1, 7, 50, 1000):
        got = {r.bin: r.n for r in histogram(df, "x", bins).collect()}
        lo, hi = vals.min(), vals.max()
        at = np.minimum(np.floor((vals - lo) / ((hi - lo) / bins)).astype(int), bins - 1)
        assert got == {int(b): int(c) for b, c in zip(*np.unique(at, return_counts=True))}
    plan = histogram(df, "x", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan  # the input itself is not read again: its values were written once


def test_histogram_of_an_empty_table(spark):
    assert histogram(spark.createDataFrame([(None,)], "x double"), "x", 5).collect() == []


def test_assign_ids_equals_row_number(spark):
    new = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("key")).repartition(9)
    existing = spark.createDataFrame([(5,), (41,)], "cid long")
    got = sorted((r.key, r.NewID) for r in assign_ids(new, existing, "cid", ["key"]).collect())
    want = sorted((r.key, r.NewID) for r in new.select(
        "key", (F.row_number().over(Window.orderBy("key")) + 41).alias("NewID")).collect())
    assert got == want


def test_sample_is_the_same_under_every_partitioning(spark):
    from shelfspark.operators.explore import sample_rows
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("OrderID"), (F.col("id") % 7).alias("ProductID"),
                                      F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))
    one = sorted(map(tuple, sample_rows(df, 0.1).collect()))
    assert one == sorted(map(tuple, sample_rows(df.repartition(13, "kind"), 0.1).collect()))
    assert 1800 < len(one) < 2200 and one != sorted(map(tuple, sample_rows(df, 0.1, seed=1).collect()))
    assert sample_rows(df, 1.0).count() == 20000 and sample_rows(df, 0.0).count() == 0
    by = {r.kind: r["count"] for r in sample_rows(df, 0.0, stratum="kind", fractions={"a": 0.5}).groupBy("kind").count().collect()}
    assert set(by) == {"a"} and 3100 < by["a"] < 3600
    # a smaller share is part of a larger one
    assert sample_rows(df, 0.05).exceptAll(sample_rows(df, 0.1)).isEmpty()
