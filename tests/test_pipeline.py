"""Invariants of the gold / scoring / candidate / feature layers."""

import pytest
import numpy as np
from pyspark.sql import functions as F

from shelfspark.operators import candidates as cnd
from shelfspark.plans.layers import Layers

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def L(spark):
    return Layers.from_fixtures(spark, SF_SMALL)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pairs_ordered(L):
    assert L.fbt.where(F.col("ProductID_A") >= F.col("ProductID_B")).count() == 0


def test_trending_window_edge(spark):
    import datetime as dt
    from shelfspark.operators.gold import trending_products
    rows = [(1, 1, "purchase", 1, dt.datetime(2001, 10, 6, 0, 0, 0)),     # exactly as_of - 30 days
            (2, 1, "purchase", 1, dt.datetime(2001, 10, 5, 23, 59, 59)),  # one second before
            (3, 1, "PURCHASE", 1, dt.datetime(2001, 12, 1, 0, 0, 0))]     # after as_of
    df = (spark.createDataFrame(rows, "ProductID long, CustomerID long, InteractionType string, "
                                      "Quantity int, EventTime timestamp")
          .withColumn("EventTime", F.col("EventTime").cast("timestamp_ntz"))
          .withColumn("ProductName", F.lit("p")).withColumn("Category", F.lit("c"))
          .withColumn("Brand", F.lit("b")))
    got = {r.ProductID for r in trending_products(df, "2001-11-05").collect()}
    assert got == {1, 3}


def test_hybrid_is_sum_of_parts_and_onepass_equal(L):
    h = L.hybrid
    bad = h.where(F.abs(F.col("hybrid_score") - F.col("cf_weighted_score") - F.col("recency_weighted_score")
                        - F.col("content_similarity_score")) > 1e-9).count()
    assert bad == 0
    r6 = lambda df: df.select("CustomerID", "ProductID",
                              *[F.round(c, 9).alias(c) for c in df.columns[2:]])
    assert _rows(r6(L.hybrid)) == _rows(r6(L.hybrid_joined))


def test_recommendations_bounded_and_ordered(L):
    r = L.ranked_recs
    assert r.groupBy("CustomerID").count().where("count > 10").count() == 0
    lists = {row.CustomerID: row.recommended_products for row in L.final_recs.collect()}
    for row in r.where("rank = 1").collect():
        assert lists[row.CustomerID][0] == row.ProductID


def _naive_candidates(L, limit=200, top_list=50):
    g = L.gold_inputs()
    a = L.active
    frames = [cnd.user_history(g["interactions"]),
              cnd.same_category(g["preferences"], g["features"], a, None),
              cnd.brand_affinity(g["enriched"], g["features"], a, None),
              cnd.bought_together(g["interactions"], g["fbt"]),
              cnd.age_group(g["customers_age"], g["agegroup_popular"], a, None),
              cnd.trending(a, g["trending"], top_list),
              cnd.discount(a, g["features"], top_list),
              cnd.location(g["location_pop"], g["customers_age"], a, None)]
    from shelfspark.functions.frames import union_all
    return cnd.candidate_provenance(union_all(frames), limit)


def test_bounded_fanout_equals_naive(L):
    """Same pairs AND same provenance with and without the per-group cut."""
    def key(df):
        return _rows(df.select("CustomerID", "ProductID", "candidate_source", "num_sources",
                               F.array_join("candidate_sources", ",")))
    assert key(L.candidate_sources) == key(_naive_candidates(L))


def test_candidate_invariants(L):
    c = L.candidate_sources
    assert c.groupBy("CustomerID").count().where("count > 200").count() == 0
    assert c.count() == c.select("CustomerID", "ProductID").distinct().count()
    assert c.where(F.size("candidate_sources") < 1).count() == 0
    assert c.where(~F.array_contains("candidate_sources", F.col("candidate_source"))).count() == 0


def test_labels_match_interactions(L):
    lab = L.labeled
    pos = lab.where("label = 1").select("CustomerID", "ProductID")
    inter = L.interactions.select("CustomerID", "ProductID")
    assert pos.subtract(inter).count() == 0
    assert lab.join(inter, ["CustomerID", "ProductID"], "left_semi").where("label = 0").count() == 0
    assert lab.where(F.abs(F.col("user_product_affinity")
                           - F.col("interaction_count") / (F.col("user_total_interactions") + 1)) > 1e-12).count() == 0


def test_price_band_counts_sum(L):
    assert L.price_bands.count() == L.features.count()


def test_results_unchanged_by_repartitioning(spark, L):
    sales = L.silver_sales.repartition(11)
    L2 = Layers(L.silver_customers, L.silver_products, sales)
    assert _rows(L2.ranked_recs) == _rows(L.ranked_recs)


def test_hot_order_salting_equals_plain(spark):
    """A single order holding a third of all items: cut into chunks it gives
    the same pairs and supports as in one piece and as plain Python."""
    from collections import Counter
    from itertools import combinations

    from shelfspark.operators.gold import frequently_bought_together
    rows = [("hot", p, "purchase") for p in range(60)]
    rows += [(f"o{i}", p, "purchase") for i in range(40) for p in (i % 7, 7 + i % 5, 20 + i % 3)]
    df = spark.createDataFrame(rows, "OrderID string, ProductID long, InteractionType string")
    orders = {}
    for o, p, _ in rows:
        orders.setdefault(o, set()).add(p)
    brute = Counter(pair for items in orders.values() for pair in combinations(sorted(items), 2))
    plain = frequently_bought_together(df)
    salted = frequently_bought_together(df, chunk_items=10)
    for found in (plain, salted):
        assert sorted(map(tuple, found.collect())) == sorted((a, b, n) for (a, b), n in brute.items())
    assert plain.where("ProductID_A < 60 AND ProductID_B < 60").count() >= 60 * 59 // 2 - 1


def test_candidates_with_many_lists_per_user(L, monkeypatch):
    """Users with more lists than one step merges."""
    monkeypatch.setattr(cnd, "MERGED_LISTS", 3)
    def key(df):
        return _rows(df.select("CustomerID", "ProductID", "candidate_source", "num_sources",
                               F.array_join("candidate_sources", ",")))
    assert key(cnd.candidates_with_sources(L.gold_inputs(), 20, 5)) == key(_naive_candidates(L, 20, 5))


@pytest.mark.parametrize("source", ["same_category", "brand_affinity", "age_group", "location"])
def test_classes_expand_to_the_source(L, source):
    """Users x classes x lists are the rows of the source as defined; num_candidates counts them."""
    g, a = L.gold_inputs(), L.active
    full = {"same_category": lambda: cnd.same_category(g["preferences"], g["features"], a),
            "brand_affinity": lambda: cnd.brand_affinity(g["enriched"], g["features"], a),
            "age_group": lambda: cnd.age_group(g["customers_age"], g["agegroup_popular"], a),
            "location": lambda: cnd.location(g["location_pop"], g["customers_age"], a)}[source]()
    users, classes = cnd.source_classes(g, source)
    lists = cnd.group_products(g).where(F.col("candidate_source") == source)
    pairs = users.join(classes, "class_id").join(lists, "grp").select("CustomerID", "ProductID", F.lit(source))
    assert _rows(pairs) == _rows(full)
    assert _rows(users.select("CustomerID", "num_candidates")) == _rows(full.groupBy("CustomerID").count())
    assert classes.where("class_id is null or num_users < 1").count() == 0


def test_classes_of_shared_groups(spark):
    members = spark.createDataFrame([(5, "a"), (5, "b"), (3, "b"), (3, "a"), (4, "a"), (9, "none"), (8, "a"), (8, "none")],
                                    "CustomerID long, grp string")
    products = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("c", 7)], "grp string, ProductID long")
    users, classes = cnd.group_classes(members, products)
    assert _rows(users) == [(3, 3, 3), (4, 4, 2), (5, 3, 3), (8, 4, 2)]
    assert _rows(classes) == [(3, "a", 2, 2), (3, "b", 2, 1), (4, "a", 2, 2)]


@pytest.mark.parametrize("slack", [0.05, 50.0])
def test_adaptive_fallback_and_loose_threshold_exact(L, slack):
    """Tiny slack: most users fail the round-1 check and take the fallback;
    huge slack: round 1 takes nearly everything. Both equal the naive plan."""
    got = cnd.candidates_with_sources(L.gold_inputs(), 200, 50, slack=slack)
    def key(df):
        return _rows(df.select("CustomerID", "ProductID", "candidate_source", "num_sources",
                               F.array_join("candidate_sources", ",")))
    assert key(got) == key(_naive_candidates(L))


def test_hot_user_candidates_exact(spark):
    """One customer holds a third of all interactions (every brand, category,
    many products): the adaptive cut still equals the naive full fan-out."""
    from shelfspark.operators.clean import conform_sales
    products = spark.range(400).select(
        F.col("id").alias("ProductID"), F.concat(F.lit("p"), F.col("id")).alias("ProductName"),
        (F.col("id") % 5).cast("string").alias("Category"), (F.col("id") % 13).cast("string").alias("Brand"),
        (F.col("id") * 10.0).alias("Price"), (F.col("id") % 4 * 10.0).alias("DiscountPercent"))
    customers = spark.range(30).select(
        F.col("id").alias("CustomerID"), (F.lit(18) + F.col("id") * 2).cast("int").alias("Age"),
        (F.col("id") % 4).cast("string").alias("Location"))
    n = 3000
    hot = spark.range(n // 3).select(
        F.lit(0).cast("long").alias("CustomerID"), (F.col("id") * 7 % 400).alias("ProductID"),
        (F.col("id") % 50).alias("o"), F.col("id").alias("i"))
    rest = spark.range(n - n // 3).select(
        (F.lit(1) + F.col("id") % 29).alias("CustomerID"), (F.col("id") * 11 % 400).alias("ProductID"),
        (F.lit(100) + F.col("id") % 400).alias("o"), F.col("id").alias("i"))
    typed = hot.unionByName(rest).select(
        F.concat(F.lit("o"), F.col("o")).alias("OrderID"), "CustomerID", "ProductID",
        F.when(F.col("i") % 3 == 0, "view").otherwise("purchase").alias("InteractionType"),
        F.lit(1).alias("Quantity"), F.lit(5.0).alias("PriceAtPurchase"),
        F.lit("2001-10-20 00:00:00").cast("timestamp_ntz").alias("EventTime"))
    L = Layers(customers, products, conform_sales(typed))
    def key(df):
        return _rows(df.select("CustomerID", "ProductID", "candidate_source", "num_sources",
                               F.array_join("candidate_sources", ",")))
    got = key(L.candidate_sources)
    assert got == key(_naive_candidates(L))
    assert sum(1 for r in got if r[0] == 0) == 200


def test_min_support_prunes_before_the_self_join(spark):
    """A-priori: rare products leave first; the pairs are those of the plain result."""
    from shelfspark.operators import gold
    rng = np.random.default_rng(3)
    lines = {(str(o), int(p)) for o in range(300) for p in rng.zipf(1.3, 6) if p < 400}
    df = spark.createDataFrame([(o, p, "Purchase") for o, p in sorted(lines)], "OrderID string, ProductID long, InteractionType string")
    plain = gold.frequently_bought_together(df)
    for support in (2, 5, 20):
        want = plain.where(F.col("together_orders") >= support)
        got = gold.frequently_bought_together(df, min_support=support)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    items = gold.order_items(df)
    frequent = gold.frequent_items(items, 20)
    assert gold._pairs(frequent, 1000).count() < gold._pairs(items, 1000).count() / 2


def test_rows_without_a_customer_and_hot_customers_are_spread(spark):
    """JN1: a third of the rows have no customer, a fifth one customer: no task holds twice the median."""
    from shelfspark.operators.facts import join_customers
    i = F.col("id")
    sales = spark.range(0, 60000).select(
        i.cast("string").alias("OrderID"), i.alias("ProductID"), F.lit("2001-01-01").cast("timestamp_ntz").alias("EventTime"),
        F.when(i % 3 == 0, F.lit(None)).when(i % 5 == 0, F.lit(7)).otherwise(i % 4001).cast("long").alias("CustomerID"))
    customers = spark.range(0, 4001).select(F.col("id").alias("CustomerID"), F.concat(F.lit("c"), "id").alias("CustomerName"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = join_customers(sales, customers, hot_share=0.01).withColumn("_task", F.spark_partition_id())
        sizes = sorted(r["count"] for r in got.groupBy("_task").count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
        want = sales.join(customers, "CustomerID", "left")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        nulls_only = join_customers(sales, customers)
        assert sorted(map(str, nulls_only.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_positive_labels_are_not_cut_to_the_lowest_candidates(spark):
    """A buyer of more products than the cut keeps every positive label; the labelled
    table itself stays cut. Candidates among given pairs are those of the full fan-out."""
    from shelfspark.operators.clean import conform_sales
    products = spark.range(40).select(
        F.col("id").alias("ProductID"), F.lit("p").alias("ProductName"), (F.col("id") % 3).cast("string").alias("Category"),
        (F.col("id") % 4).cast("string").alias("Brand"), (F.col("id") * 1.0).alias("Price"), (F.col("id") % 2 * 10.0).alias("DiscountPercent"))
    customers = spark.range(6).select(F.col("id").alias("CustomerID"), (F.lit(18) + F.col("id") * 9).cast("int").alias("Age"),
                                      (F.col("id") % 2).cast("string").alias("Location"))
    bought = [(f"o{c}-{p % 5}", c, p, "view" if p % 7 == 0 else "purchase") for c in (0, 1, 2, None) for p in range(c or 0, 40, 1 + 2 * (c or 0))]
    typed = spark.createDataFrame(bought + bought[:9], "OrderID string, CustomerID long, ProductID long, InteractionType string").select(
        "*", F.lit(1).alias("Quantity"), F.lit(5.0).alias("PriceAtPurchase"), F.lit("2001-10-20 00:00:00").cast("timestamp_ntz").alias("EventTime"))
    L = Layers(customers, products, conform_sales(typed), limit=5, top_list=3)
    want = sorted({(p, c, 1) for _, c, p, kind in bought if c is not None and kind == "purchase"})
    assert _rows(L.positives) == want
    assert len(_rows(L.labeled.where("label = 1"))) < len(want)
    def key(df):
        return _rows(df.select("CustomerID", "ProductID", "candidate_source", "num_sources", F.array_join("candidate_sources", ",")))
    met = L.interactions.select("CustomerID", "ProductID")
    assert key(L.met_candidates) == key(_naive_candidates(L, None, 3).join(met, ["CustomerID", "ProductID"], "left_semi"))


def test_label_positive_equals_its_sql(spark):
    import __spark_entry__ as E
    from oracle_compare import compare, duck
    r = compare(spark, duck(SF_SMALL), SF_SMALL, "label_positive", E.queries()["label_positive"], E.oracle_sql()["label_positive"])
    assert r["cols_match"] and r["values_match"], r
