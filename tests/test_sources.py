"""Sources: inferred single-file read (SRC4), schema enforcement with rejects (STR5)."""

import os

from pyspark.sql import functions as F

from shelfspark.schemas import BRONZE_CUSTOMERS, CUSTOMER_COLUMNS
from shelfspark.session import scratch_path
from shelfspark.sources import fixtures as fx
from shelfspark.sources.csv import read_csv_inferred, read_feed, read_feed_checked, write_feed
from shelfspark.sources.tables import BUCKETS, Tables, write_bucketed

from conftest import SF_SMALL


def test_inferred_read(spark):
    path = scratch_path(spark, "t-infer")
    fx.customers(spark, SF_SMALL).write.option("header", "true").csv(path)
    df = read_csv_inferred(spark, path)
    types = dict(df.dtypes)
    assert types["CustomerID"] in ("int", "bigint") and types["AvgReviewRating"] == "double"
    assert df.count() == fx.customers(spark, SF_SMALL).count()


def test_schema_enforcement_rejects(spark):
    path = scratch_path(spark, "t-reject")
    raw = fx.raw_customers(spark, SF_SMALL)
    # every 5th line gets an extra unquoted field: a malformed row
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in CUSTOMER_COLUMNS])
    bad = F.col("CustomerID").cast("long") % 5 == 0
    lines = raw.select(F.when(bad, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"))
    header = spark.createDataFrame([(",".join(CUSTOMER_COLUMNS),)], "value string")
    # one small test file: header line first, then the data lines
    header.unionAll(lines).coalesce(1).write.text(os.path.join(path, "feed"))
    good, rejected = read_feed_checked(spark, os.path.join(path, "feed"), BRONZE_CUSTOMERS)
    n_bad = raw.where(bad).count()
    rej = rejected.where("error = 'malformed_line'")
    assert rej.count() == n_bad and n_bad > 0
    assert rej.where(F.col("_corrupt_record").endswith(",extra")).count() == n_bad
    others = raw.where(~F.coalesce(bad, F.lit(False)) & F.col("CustomerID").isNull()).count()
    assert rejected.count() == n_bad + others and good.count() == raw.count() - n_bad - others


def test_tables_roundtrip(spark):
    t = Tables(spark, scratch_path(spark, "t-tables"))
    df = t.write(fx.products(spark, SF_SMALL), "products")
    assert df.count() == fx.products(spark, SF_SMALL).count()


def test_quotes_and_line_breaks_survive_a_feed(spark):
    odd = spark.createDataFrame([('say "hi", twice', "a\nb"), ("back\\slash", None)], "CustomerID string, CustomerName string")
    for c in CUSTOMER_COLUMNS[2:]:
        odd = odd.withColumn(c, F.lit("x"))
    path = scratch_path(spark, "t-quotes")
    write_feed(odd, path)
    got = read_feed(spark, path, BRONZE_CUSTOMERS, multi_line=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, odd.select(*got.columns).collect()))


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_joins_of_bucketed_sinks_need_no_shuffle(spark):
    """SNK1, SNK2: candidates, interactions and the labels made from them."""
    from shelfspark.operators import features as fea
    from shelfspark.plans.layers import Layers
    L = Layers.from_fixtures(spark, SF_SMALL)
    pairs = L.interactions
    cands = (pairs.select("CustomerID", F.explode(F.array("ProductID", F.col("ProductID") + 1)).alias("ProductID"))
                  .where("CustomerID IS NOT NULL").distinct().withColumn("candidate_source", F.lit("user_history")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [write_bucketed(cands, "t_cands"), write_bucketed(pairs, "t_pairs")]
        labeled = fea.labeled_features(*stored)
        assert _exchanges(labeled) == 0 and _exchanges(fea.labeled_features(cands, pairs)) > 0
        again = write_bucketed(labeled, "t_labeled", dealt=True)
        joined = again.join(stored[1].select("CustomerID", "ProductID", "interaction_score"), ["CustomerID", "ProductID"], "left")
        assert _exchanges(joined) == 0
        assert sorted(map(str, again.collect())) == sorted(map(str, fea.labeled_features(cands, pairs).collect()))
        # one file per bucket
        assert len(again.inputFiles()) <= BUCKETS
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
