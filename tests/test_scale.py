"""Plans and layouts that keep a task's share of the work bounded."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfspark.operators import candidates as cnd
from shelfspark.operators import features as fea
from shelfspark.plans.layers import Layers
from shelfspark.sources.tables import BUCKET_ROWS, buckets_for

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def L(spark):
    return Layers.from_fixtures(spark, SF_SMALL).materialize("silver_sales", "interactions", "features")


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def _small(spark):
    lists = spark.createDataFrame([(1, [10, 20, 30], [1, 4, 3]), (2, [10], [128]), (3, [40], [2])],
                                  "CustomerID long, ids array<long>, masks array<short>")
    ui = spark.createDataFrame([(1, 10, 2, 5), (1, 30, 1, 6), (1, 30, 7, 8), (1, 99, 1, 1), (2, 11, 1, 1), (None, 40, 1, 1)],
                               "CustomerID long, ProductID long, interaction_events long, d int").select(
        "CustomerID", "ProductID", "interaction_events",
        F.expr("timestamp_ntz'2001-11-01 00:00:00' + make_interval(0, 0, 0, d)").alias("last_interaction_ts"))
    features = spark.createDataFrame([(10, 1.0, 2, 3.0), (20, 4.0, 5, 6.0), (99, 7.0, 8, 9.0)],
                                     "ProductID long, ProductRating double, ReviewsCount int, DiscountPercent double")
    customers = spark.createDataFrame([(1, "a", 1.0, 1), (1, "b", 2.0, 2), (3, "c", None, 3)],
                                      "CustomerID long, AgeGroup string, AvgReviewRating double, PreviousPurchases int")
    return lists, ui, features, customers


def test_lists_and_pairs_give_the_same_features(spark):
    """Repeated interactions and customers, users and products without attributes."""
    lists, ui, features, customers = _small(spark)
    pairs = cnd.pairs_of(lists)
    assert pairs.count() == 5
    assert _rows(fea.final_features(lists, ui, features, customers, "2001-11-05")) == _rows(
        fea.final_features(pairs, ui, features, customers, "2001-11-05"))
    assert _rows(fea.labeled_features(lists, ui)) == _rows(fea.labeled_features(pairs, ui))


def test_pairs_are_not_shuffled_for_features(L):
    """Nothing is exchanged once the lists have become pairs."""
    lists = L.candidate_lists
    for df in (fea.final_features(lists, L.interactions, L.features, L.customers_age, L.as_of),
               fea.labeled_features(lists, L.interactions)):
        plan = _plan(df)
        above = plan[:plan.index("arrays_zip")]  # what is done after the unpacking comes first
        assert "Exchange hashpartitioning" not in above and "SortMergeJoin" not in above, above


def test_users_are_dealt_over_tasks_by_their_number(spark, L, monkeypatch):
    monkeypatch.setattr(cnd, "TASK_USERS", 10)
    lists = cnd.candidate_lists(L.gold_inputs(), 20, 5)
    assert len(lists.inputFiles()) > 5
    assert lists.select("CustomerID").distinct().count() == lists.count() == L.active.count()


def test_dedup_of_sales_needs_no_second_shuffle(L, spark, no_broadcast):
    plan = _plan(Layers.from_fixtures(spark, SF_SMALL).silver_sales)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan


def test_last_sales_are_taken_before_the_joins(spark):
    plan = E.queries()["top_sales_by_time"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("GlobalLimit 50") == 2


def test_buckets_follow_the_rows():
    assert buckets_for(10) == 16
    assert buckets_for(100 * BUCKET_ROWS) == 100


def test_rejects_are_not_dealt_by_class(spark, no_broadcast):
    plan = _plan(E.queries()["feed_rejects"](spark, SF_SMALL))
    assert plan.lstrip().split("\n")[1].count("BroadcastHashJoin") or "BroadcastHashJoin" in plan


@pytest.mark.parametrize("source", ["same_category", "brand_affinity", "age_group", "location"])
def test_fan_out_of_a_source_is_dealt_evenly(spark, monkeypatch, source):
    """One group with nearly all users and products: every pair comes as often as in the
    plain join (repeated and NULL keys too), and no task has a large share of them."""
    monkeypatch.setattr(cnd, "BLOCK_USERS", 7)
    monkeypatch.setattr(cnd, "BLOCK_PRODUCTS", 7)
    monkeypatch.setattr(cnd, "TASK_PAIRS", 300)
    users = [(u, "all") for u in range(60)] + [(u, "few") for u in range(0, 60, 9)] + [(3, "all"), (4, None), (None, "all"), (5, "none")]
    products = [(p, "all") for p in range(80)] + [(p, "few") for p in range(0, 80, 7)] + [(2, "all"), (2, "all"), (6, None), (None, "few")]
    u = spark.createDataFrame(users, "CustomerID long, g string")
    p = spark.createDataFrame(products, "ProductID long, g string")
    active = spark.createDataFrame([(i,) for i in range(50)], "CustomerID long")
    both = {"same_category": lambda a: cnd.same_category(u.withColumnRenamed("g", "Category"), p.withColumnRenamed("g", "Category"), a),
            "brand_affinity": lambda a: cnd.brand_affinity(u.withColumnRenamed("g", "Brand"), p.withColumnRenamed("g", "Brand"), a),
            "age_group": lambda a: cnd.age_group(u.withColumnRenamed("g", "AgeGroup"), p.withColumnRenamed("g", "AgeGroup"), a),
            "location": lambda a: cnd.location(p.withColumnRenamed("g", "CustomerLocation"), u.withColumnRenamed("g", "Location"), a)}[source]
    once = u.distinct() if source == "brand_affinity" else u
    for a in (active, None):
        mine = once.where("CustomerID IS NOT NULL") if a is None else once.join(a, "CustomerID", "left_semi")
        want = mine.join(p, "g").select("CustomerID", "ProductID", F.lit(source))
        assert _rows(both(a).toDF(*want.columns)) == _rows(want)
    sizes = [r["count"] for r in both(active).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * 300, sizes


def test_candidates_read_groups_without_product_attributes(spark, no_broadcast):
    """Products of age groups and locations are those of the gold tables, made without the product dimension."""
    L = Layers.from_fixtures(spark, SF_SMALL)
    narrow = L.gold_inputs()
    for name, group in (("agegroup_popular", "AgeGroup"), ("location_pop", "CustomerLocation")):
        assert "part.parquet" not in _plan(narrow[name]), name
        assert _rows(narrow[name].select(group, "ProductID")) == _rows(getattr(L, name).select(group, "ProductID"))
