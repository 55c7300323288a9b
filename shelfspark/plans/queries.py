"""Registered queries: one per operator of the inventory, each
``(spark, sf_dir) -> DataFrame`` over the whole driver tables, and the
matching DuckDB oracle SQL.

Compared outputs show floating columns at twelve significant digits and render arrays as
sorted comma strings (both sides), so value hashes are engine-neutral.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.columns import as_of_timestamp
from shelfspark.functions.frames import top_k
from shelfspark.operators import candidates as cnd
from shelfspark.operators import clean, dims, explore, facts, features as fea, gold
from shelfspark.plans import oracle as O
from shelfspark.plans.layers import EVENTS_AS_OF, ORDERS_AS_OF, Layers
from shelfspark.sources import fixtures as fx
from shelfspark.sources.tables import buckets_for, write_bucketed

Query = Callable[[SparkSession, str], DataFrame]


SHIFT = 1.00000000000037


def round6(c):
    """A floating column at twelve significant digits, whatever its magnitude.
    SHIFT moves values that lie half way between two of them to one side.

    Summation order moves a value by an ulp; both engines print twelve digits
    and read them back, so equal results are equal doubles and tiny scores
    stay what they are."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.format_string("%.11e", c.cast("double") * F.lit(SHIFT)).cast("double"))


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating column (engine-neutral comparison)."""
    return df.select(*[
        round6(f.name).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def _L(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers.from_fixtures(spark, sf_dir)


# Gold tables read by many branches of the candidate and feature jobs.
SHARED_GOLD = ("silver_sales", "interactions", "features")


def _Lm(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers whose shared gold tables are written once (as the medallion
    runner does) before the multi-branch candidate / feature plans."""
    return Layers.from_fixtures(spark, sf_dir).materialize(*SHARED_GOLD)


def _ingest():
    return as_of_timestamp(ORDERS_AS_OF)


def _top(df: DataFrame, col, tiebreak: list[str], k: int = 50) -> DataFrame:
    return top_k(df, [col.desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak], k)


def _sorted_str(col: str):
    return F.array_join(F.sort_array(F.col(col)), ",")


# ---------------------------------------------------------------- queries
def q_clean_customers(spark, d):
    return rounded(clean.clean_customers(fx.raw_customers(spark, d), _ingest()))


def q_clean_products(spark, d):
    return rounded(clean.clean_products(fx.raw_products(spark, d), _ingest()))


def q_clean_sales(spark, d):
    return rounded(clean.clean_sales(fx.raw_sales(spark, d), _ingest()))


def q_dedup_latest_product(spark, d):
    return rounded(clean.latest_product(fx.product_versions(spark, d)))


def q_dedup_order_item(spark, d):
    return rounded(_L(spark, d).silver_sales)


def q_age_groups(spark, d):
    return rounded(_L(spark, d).customers_age)


def q_sales_enriched(spark, d):
    return rounded(_L(spark, d).enriched)


def q_user_product_interactions(spark, d):
    return _L(spark, d).interactions


def q_product_features(spark, d):
    return rounded(_L(spark, d).features)


def q_frequently_bought_together(spark, d):
    return _L(spark, d).fbt


def q_trending_30d(spark, d):
    return _L(spark, d).trending


def q_user_category_preferences(spark, d):
    return _L(spark, d).preferences


def q_user_price_profile(spark, d):
    return rounded(_L(spark, d).price_profile)


def q_price_bands(spark, d):
    return rounded(_L(spark, d).price_bands)


def q_agegroup_popular(spark, d):
    return _L(spark, d).agegroup_popular


def q_agegroup_popular_joined(spark, d):
    L = _L(spark, d)
    return gold.agegroup_popular_products(L.enriched, L.customers_age)


def q_interactions_weighted(spark, d):
    return rounded(_L(spark, d).weighted)


def q_events_interactions_weighted(spark, d):
    return rounded(gold.user_product_interactions_weighted(fx.interactions(spark, d), EVENTS_AS_OF))


def q_hybrid_scores(spark, d):
    return rounded(_L(spark, d).hybrid_joined)


def q_hybrid_scores_onepass(spark, d):
    return rounded(_L(spark, d).hybrid)


def q_final_recommendations(spark, d):
    return rounded(_L(spark, d).ranked_recs)


def q_final_recommendation_lists(spark, d):
    recs = _L(spark, d).final_recs
    return recs.select("CustomerID",
                       F.array_join(F.transform("recommended_products", lambda x: x.cast("string")), ",")
                       .alias("recommended_products"))


def q_active_users(spark, d):
    return _L(spark, d).active


def q_cand_user_history(spark, d):
    return cnd.user_history(_L(spark, d).interactions)


def _source_classes(spark, d, source):
    return cnd.source_classes(_L(spark, d).gold_inputs(), source)[1]


def q_cand_same_category(spark, d):
    """CND2: every pair of a user and a product of the user's categories."""
    L = _L(spark, d)
    return cnd.same_category(L.preferences, L.features, L.active)


def q_cand_same_category_classes(spark, d):
    return _source_classes(spark, d, "same_category")


def q_cand_brand_affinity(spark, d):
    """CND3: every pair of a user and a product of the user's brands."""
    L = _L(spark, d)
    return cnd.brand_affinity(L.fact_products, L.features, L.active)


def q_cand_brand_affinity_classes(spark, d):
    return _source_classes(spark, d, "brand_affinity")


def q_cand_group_products(spark, d):
    """The candidate list of each group, once: classes link to it by grp."""
    return cnd.group_products(_L(spark, d).gold_inputs())


def q_cand_fbt(spark, d):
    L = _L(spark, d)
    return cnd.bought_together(L.interactions, L.fbt)


def q_cand_age_group(spark, d):
    """CND5: every pair of a user and a product bought in the user's age group."""
    L = _L(spark, d)
    return cnd.age_group(L.customers_age, L.agegroup_popular, L.active)


def q_cand_age_group_classes(spark, d):
    return _source_classes(spark, d, "age_group")


def q_cand_trending(spark, d):
    L = _L(spark, d)
    return cnd.trending(L.active, L.trending)


def q_cand_discount(spark, d):
    L = _L(spark, d)
    return cnd.discount(L.active, L.features)


def q_cand_location(spark, d):
    """CND8: every pair of a user and a product met in the user's location."""
    L = _L(spark, d)
    return cnd.location(L.location_pop, L.customers_age, L.active)


def q_cand_location_classes(spark, d):
    return _source_classes(spark, d, "location")


def q_candidates_final(spark, d):
    return _Lm(spark, d).candidates


def q_location_popularity(spark, d):
    return _L(spark, d).location_pop


def q_candidate_sources(spark, d):
    cs = _Lm(spark, d).candidate_sources
    return cs.select("CustomerID", "ProductID", "num_sources",
                     _sorted_str("candidate_sources").alias("candidate_sources"))


def q_features_final(spark, d):
    ff = _Lm(spark, d).final_features
    return rounded(ff.withColumn("candidate_sources", _sorted_str("candidate_sources")))


def q_features_labeled(spark, d):
    return rounded(_Lm(spark, d).labeled)


def q_label_positive(spark, d):
    """FLT8 over every candidate of a user, not the lowest 200 alone."""
    return _Lm(spark, d).positives


def q_feature_profile(spark, d):
    return rounded(fea.feature_profile(_Lm(spark, d).labeled))


def q_feature_counts(spark, d):
    return fea.feature_counts(_Lm(spark, d).final_features)


def q_top_sales_by_time(spark, d):
    """TOP2: the order has columns of the sales alone, and both joins are left joins,
    so the last rows of the enriched fact come from the last rows of the sales."""
    L = _L(spark, d)
    last = lambda df: _top(df, F.col("EventTime"), ["OrderID", "ProductID"])
    return rounded(last(facts.sales_enriched(last(L.fact), L.customers_age, L.silver_products)))


def q_top_pairs(spark, d):
    return _top(_L(spark, d).fbt, F.col("together_orders"), ["ProductID_A", "ProductID_B"])


def q_top_interactions(spark, d):
    return _top(_L(spark, d).interactions, F.col("interaction_score"), ["CustomerID", "ProductID"])


def q_top_trending(spark, d):
    return _top(_L(spark, d).trending, F.col("purchase_count"), ["ProductID"])


def q_top_category_prefs(spark, d):
    return _top(_L(spark, d).preferences, F.col("purchase_count"), ["CustomerID", "Category"])


def q_top_agegroup_popular(spark, d):
    return _top(_L(spark, d).agegroup_popular, F.col("purchase_count"), ["AgeGroup", "ProductID"])


def q_top_weighted(spark, d):
    w = _L(spark, d).weighted
    return rounded(_top(w, round6("recency_weighted_score"), ["CustomerID", "ProductID"]))


def q_top_products_by_quantity(spark, d):
    return explore.top_products_by_quantity(_L(spark, d).enriched)


def q_preview_customers(spark, d):
    return rounded(explore.preview(_L(spark, d).customers_age, "CustomerID"))


def q_preview_price_profile(spark, d):
    return rounded(explore.preview(_L(spark, d).price_profile, "CustomerID"))


def q_preview_product_features(spark, d):
    return rounded(explore.preview(_L(spark, d).features, "ProductID"))


def q_preview_price_bands(spark, d):
    return rounded(explore.preview(_L(spark, d).price_bands, "ProductID"))


def q_top_discounted(spark, d):
    return rounded(cnd.top_discounted(_L(spark, d).features))


def q_eda_interaction_types(spark, d):
    return explore.interaction_type_counts(_L(spark, d).enriched)


def q_eda_user_activity_hist(spark, d):
    return rounded(explore.user_activity_histogram(_L(spark, d).interactions))


def q_eda_recency_hist(spark, d):
    return rounded(explore.recency_histogram(
        gold.user_product_interactions_weighted(fx.interactions(spark, d), EVENTS_AS_OF)))


def q_eda_price_band_share(spark, d):
    return rounded(explore.price_band_share(_L(spark, d).price_bands))


def q_eda_age_purchases(spark, d):
    return explore.age_group_purchases(_L(spark, d).agegroup_popular)


def q_eda_hybrid_hist(spark, d):
    return rounded(explore.hybrid_histogram(_L(spark, d).hybrid))


def q_eda_rec_length(spark, d):
    return explore.recommendation_lengths(_L(spark, d).final_recs)


def q_eda_user_recency_volume(spark, d):
    w = gold.user_product_interactions_weighted(fx.interactions(spark, d), EVENTS_AS_OF)
    return explore.user_recency_volume(w, EVENTS_AS_OF)


def q_product_variants(spark, d):
    return dims.product_variants(clean.latest_product(fx.product_versions(spark, d)))


def q_discount_percent(spark, d):
    latest = clean.latest_product(fx.product_versions(spark, d))
    return dims.with_discount_percent(latest).select("ProductID", "MRP", "Price", "DiscountPercent")


def q_activity_class(spark, d):
    c = clean.clean_customers(fx.raw_customers(spark, d), _ingest())
    return dims.with_activity_class(c).select("CustomerID", "FrequencyOfPurchases", "activity_class")


def q_assigned_ids(spark, d):
    """Onboard every supplier as a new customer: ids continue after max(c_custkey)."""
    sup = fx.table(spark, d, "supplier").select("s_suppkey", "s_name")
    cust = fx.table(spark, d, "customer").select("c_custkey")
    return dims.assign_new_ids(sup, cust, "c_custkey", ["s_suppkey"])


SAMPLE_STRATA = {"purchase": 0.25, "view": 0.05}


def q_sample_sales(spark, d):
    return rounded(explore.sample_rows(_L(spark, d).enriched, 0.1))


def q_sample_sales_strata(spark, d):
    """SMP1 by interaction type: a share of its own for each stratum."""
    return rounded(explore.sample_rows(_L(spark, d).enriched, 0.1, stratum="InteractionType", fractions=SAMPLE_STRATA))


def _bucketed_candidates(lists: DataFrame, buckets: int) -> DataFrame:
    """The candidate pairs as a bucketed table: users' lists are dealt into the
    buckets, and become pairs there."""
    pairs = cnd.pairs_of(lists.repartition(buckets, "CustomerID")).select("CustomerID", "ProductID", "candidate_source")
    return write_bucketed(pairs, "candidates", buckets=buckets, dealt=True)


def _candidate_buckets(lists: DataFrame) -> int:
    return buckets_for(lists.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0])


def q_sink_candidates(spark, d):
    """SNK1: the final candidates as the bucketed table that later jobs join."""
    lists = _Lm(spark, d).candidate_lists
    return _bucketed_candidates(lists, _candidate_buckets(lists))


def q_sink_labeled(spark, d):
    """SNK2: features and labels from bucketed candidates and interactions (their
    joins and counts need no shuffle), written into the same buckets."""
    L = _Lm(spark, d)
    buckets = _candidate_buckets(L.candidate_lists)
    cands = _bucketed_candidates(L.candidate_lists, buckets)
    pairs = write_bucketed(L.interactions, "interactions", buckets=buckets)
    return rounded(write_bucketed(fea.labeled_features(cands, pairs), "labeled", buckets=buckets, dealt=True))


def _medallion(spark, d, *only):
    """A run of the medallion pipeline over the raw feeds, then a refresh with the
    second half of the sales files and the updated products."""
    import os
    from shelfspark.plans import medallion
    from shelfspark.session import scratch_path, shuffles_dropped
    from shelfspark.sources.csv import write_feed
    root = scratch_path(spark, "medallion")
    feeds = [os.path.join(root, x) for x in ("customers", "products", "sales")]
    sales, products = fx.raw_sales(spark, d), fx.raw_products(spark, d)
    late, updated = F.col("Season").isin("Summer", "Fall"), F.col("IsUpdated") == "Yes"
    with shuffles_dropped(spark):
        write_feed(fx.raw_customers(spark, d), feeds[0], compression="gzip")
        write_feed(products.where(~updated), feeds[1], compression="gzip")
        write_feed(sales.where(~late), feeds[2], compression="gzip")
    run = lambda names: medallion.run(spark, *feeds, os.path.join(root, "tables"), as_of=ORDERS_AS_OF, only=names,
                                      grain="month")
    run(["gold_sales_enriched"])
    with shuffles_dropped(spark):
        write_feed(products.where(updated), feeds[1], mode="append", compression="gzip")
        write_feed(sales.where(late), feeds[2], mode="append", compression="gzip")
    return run(only)


def q_medallion_recommendations(spark, d):
    """SNK3: recommendations of the pipeline after an incremental refresh."""
    recs = _medallion(spark, d, "gold_final_recommendations").read("gold_final_recommendations")
    return recs.select("CustomerID", F.array_join(F.transform("recommended_products", lambda x: x.cast("string")), ",")
                       .alias("recommended_products"))


def q_medallion_enriched(spark, d):
    """SNK3 + FLT5: the fact table by day after an incremental refresh."""
    return rounded(_medallion(spark, d).read("gold_sales_enriched"))


def q_medallion_trending(spark, d):
    """FLT5: trending products of the pipeline, from the days of its window alone."""
    return _medallion(spark, d, "gold_trending_products_30d").read("gold_trending_products_30d")


def q_als_recommendations(spark, d):
    from shelfspark.operators.cf import als_recommendations
    return als_recommendations(_L(spark, d).interactions)


def q_als_heldout_ranking(spark, d):
    from shelfspark.operators.cf import held_out_ranking
    return rounded(held_out_ranking(_L(spark, d).interactions))


def _streaming():
    from shelfspark.streaming import ingest
    return ingest


def q_csv_roundtrip_customers(spark, d):
    return _streaming().csv_roundtrip(spark, fx.raw_customers(spark, d), "customers", _ingest())


def q_csv_inferred_customers(spark, d):
    """SRC4: a CSV feed of the customer table, read back with inferred types."""
    from shelfspark.session import scratch_path
    from shelfspark.sources.csv import read_csv_inferred, write_feed
    path = scratch_path(spark, "csv-inferred-customers")
    write_feed(spark.read.parquet(f"{d}/customer.parquet")
               .select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    return read_csv_inferred(spark, path)


def q_stream_bronze_sales(spark, d):
    return _streaming().stream_bronze_roundtrip(spark, fx.raw_sales(spark, d))


def q_stream_dedup_sales(spark, d):
    return rounded(_streaming().stream_dedup_roundtrip(spark, fx.raw_sales(spark, d), _ingest()))


def q_feed_rejects(spark, d):
    """STR5: each row of a damaged sales feed with its error class."""
    number = F.col("OrderID").cast("bigint")
    raw = fx.raw_sales(spark, d).withColumn("ProductID", F.when(number % 73 == 0, F.concat(F.lit("P-"), "ProductID"))
                                            .when(number % 79 != 0, F.col("ProductID")))
    return _streaming().feed_rejects_roundtrip(spark, raw, number % 71 == 0)


def q_stream_snapshot_products(spark, d):
    return rounded(_streaming().stream_snapshot_roundtrip(spark, fx.raw_products(spark, d), _ingest()))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


# ----------------------------------------------------------------- oracle
def _top_sql(table: str, col: str, tiebreak: list[str], cols: str = "*", k: int = 50) -> str:
    order = ", ".join([f"{col} DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in tiebreak])
    return f"SELECT {cols} FROM {table} ORDER BY {order} LIMIT {k}"


def R6(x: str) -> str:
    """SQL twin of ``round6``."""
    return f"CAST(printf('%.11e', CAST(({x}) AS DOUBLE) * {SHIFT!r}e0) AS DOUBLE)"


def _r(cols: list[str]) -> str:
    return ", ".join(f"{R6(c)} AS {c}" for c in cols)


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""
, vals AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL)
, st AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM vals)
, b AS (SELECT CASE WHEN st.hi = st.lo THEN 0
          ELSE least(CAST(floor((x - st.lo) / ((st.hi - st.lo) / {float(bins)})) AS INTEGER), {bins - 1}) END AS bin,
          st.lo, st.hi FROM vals, st)
SELECT bin, {R6(f"lo + bin * ((hi - lo) / {float(bins)})")} AS bin_start,
  {R6(f"lo + (bin + 1) * ((hi - lo) / {float(bins)})")} AS bin_end, COUNT(*) AS n
FROM b GROUP BY bin, lo, hi"""


def _ev_weighted() -> str:
    return (f"SELECT CustomerID, ProductID, SUM(ifnull(points, 0.5e0) * {O._decay('EventTime', EVENTS_AS_OF)}) "
            "AS recency_weighted_score, COUNT(*) AS interaction_events, MAX(EventTime) AS last_interaction_ts "
            "FROM fx_interactions LEFT JOIN type_weights ON kind = lower(InteractionType) "
            "WHERE CustomerID IS NOT NULL AND ProductID IS NOT NULL GROUP BY CustomerID, ProductID")


HYB = "CustomerID, ProductID, " + _r(["cf_weighted_score", "recency_weighted_score",
                                      "content_similarity_score", "hybrid_score"])


def _cols_r(spec: str) -> str:
    """Column list where names marked with ``~`` are rounded (R6)."""
    out = []
    for c in (x.strip() for x in spec.split(",")):
        out.append(f"{R6(c[1:])} AS {c[1:]}" if c.startswith("~") else c)
    return ", ".join(out)


ENRICHED_R = _cols_r("OrderID, CustomerID, CustomerName, Age, Gender, CustomerLocation, AgeGroup, ProductID, "
                     "ProductName, Category, Brand, ~CurrentProductPrice, ~PriceAtPurchase, ~DiscountPercent, "
                     "Stock, ~ProductRating, ReviewsCount, InteractionType, Quantity, "
                     "PaymentMethod, SizeSelected, ColorSelected, Season, EventTime")
PRODUCTS_R = _cols_r("ProductID, ProductName, Category, Brand, Description, AvailableColors, AvailableSizes, "
                     "~MRP, ~Price, ~DiscountPercent, Stock, ~Rating, ReviewsCount, IsUpdated, LastUpdated, ingest_ts")
SALES_R = _cols_r("OrderID, CustomerID, ProductID, InteractionType, Quantity, ~PriceAtPurchase, "
                  "PaymentMethod, SizeSelected, ColorSelected, Category, Brand, DiscountUsed, Season, EventTime, ingest_ts")
CUST_AGE_R = _cols_r("CustomerID, CustomerName, Age, Gender, Location, SubscriptionStatus, PaymentMethod, "
                     "PreviousPurchases, FrequencyOfPurchases, PreferredSeason, ~AvgReviewRating, AgeGroup")
CUST_CLEAN_R = _cols_r("CustomerID, CustomerName, ContactNumber, Age, Gender, Location, SubscriptionStatus, "
                       "PaymentMethod, PreviousPurchases, FrequencyOfPurchases, PreferredSeason, ~AvgReviewRating, "
                       "ingest_ts")
VERSIONS_R = _cols_r("ProductID, ProductName, Brand, AvailableColors, AvailableSizes, ~MRP, ~Price, "
                     "LastUpdated, Version")

W = O.with_ctes

def _sample_sql(share: str) -> str:
    """Rows whose hash, as a number from 0 to 1, lies below ``share``."""
    return ("CAST('0x' || substr(md5(concat('42|', ifnull(OrderID, ''), '|', ifnull(CAST(ProductID AS VARCHAR), ''))), 1, 8) "
            f"AS BIGINT) < floor(({share}) * 4294967296e0)")


# source -> the CTE with all its pairs, each active user's groups, each group's products
GROUP_SOURCES = {
    "same_category": ("c_cat", "SELECT CustomerID, Category AS grp FROM preferences",
                      "SELECT Category AS grp, ProductID FROM features", ["preferences", "features"]),
    "brand_affinity": ("c_brand", "SELECT DISTINCT CustomerID, Brand AS grp FROM enriched",
                       "SELECT Brand AS grp, ProductID FROM features", ["enriched", "features"]),
    "age_group": ("c_age", "SELECT CustomerID, AgeGroup AS grp FROM customers_age",
                  "SELECT AgeGroup AS grp, ProductID FROM agegroup_popular", ["customers_age", "agegroup_popular"]),
    "location": ("c_loc", "SELECT CustomerID, Location AS grp FROM customers_age",
                 "SELECT CustomerLocation AS grp, ProductID FROM location_pop", ["customers_age", "location_pop"]),
}


def _class_sql(source: str, body: str) -> str:
    """``body`` over ``sets``: each user of the source, the sorted list of the
    user's groups that have products, the lowest user with that list, and how many have it."""
    pairs, members, products, needs = GROUP_SOURCES[source]
    return W(f"""SELECT * FROM (
WITH prods AS ({products}),
sets AS (SELECT CustomerID, groups, MIN(CustomerID) OVER (PARTITION BY groups) AS class_id,
    COUNT(*) OVER (PARTITION BY groups) AS num_users
  FROM (SELECT m.CustomerID, list_sort(list(m.grp)) AS groups FROM ({members}) m
        WHERE m.CustomerID IN (SELECT CustomerID FROM active) AND m.grp IN (SELECT grp FROM prods)
        GROUP BY m.CustomerID) g)
{body.format(pairs=pairs)}) t""", pairs, "active", *needs)


def _class_rows(source: str) -> str:
    return _class_sql(source, """SELECT r.class_id, r.grp, r.num_users, n.num_products
FROM (SELECT class_id, num_users, unnest(groups) AS grp FROM sets WHERE CustomerID = class_id) r
JOIN (SELECT grp, COUNT(*) AS num_products FROM prods GROUP BY grp) n ON r.grp = n.grp""")


ORACLE: dict[str, str] = {
    "clean_customers": W(f"SELECT {CUST_CLEAN_R} FROM clean_customers", "clean_customers"),
    "clean_products": W(f"SELECT {PRODUCTS_R} FROM clean_products", "clean_products"),
    "clean_sales": W(f"SELECT {SALES_R} FROM clean_sales", "clean_sales"),
    "dedup_latest_product": W(f"SELECT {VERSIONS_R} FROM latest_versions", "latest_versions"),
    "dedup_order_item": W(f"SELECT {SALES_R} FROM silver_sales", "silver_sales"),
    "age_groups": W(f"SELECT {CUST_AGE_R} FROM customers_age", "customers_age"),
    "sales_enriched": W(f"SELECT {ENRICHED_R} FROM enriched", "enriched"),
    "user_product_interactions": W("SELECT * FROM interactions", "interactions"),
    "product_features": W("SELECT ProductID, ProductName, Category, Brand, "
                          + _r(["CurrentProductPrice", "DiscountPercent"]) + ", Stock, "
                          + _r(["ProductRating"]) + ", ReviewsCount FROM features", "features"),
    "frequently_bought_together": W("SELECT * FROM fbt", "fbt"),
    "trending_30d": W("SELECT * FROM trending", "trending"),
    "user_category_preferences": W("SELECT * FROM preferences", "preferences"),
    "user_price_profile": W("SELECT CustomerID, " + _r(["avg_price_paid", "min_price_paid", "max_price_paid",
                                                        "total_spent"]) + ", total_orders FROM price_profile",
                            "price_profile"),
    "price_bands": W("SELECT ProductID, ProductName, Category, Brand, " + _r(["CurrentProductPrice"])
                     + ", price_band FROM price_bands", "price_bands"),
    "agegroup_popular": W("SELECT * FROM agegroup_popular", "agegroup_popular"),
    "agegroup_popular_joined": W("SELECT * FROM agegroup_popular", "agegroup_popular"),
    "interactions_weighted": W("SELECT CustomerID, ProductID, " + _r(["recency_weighted_score"])
                               + ", interaction_events, last_interaction_ts FROM weighted", "weighted"),
    "events_interactions_weighted": W("SELECT CustomerID, ProductID, " + _r(["recency_weighted_score"])
                                      + f", interaction_events, last_interaction_ts FROM ({_ev_weighted()}) t",
                                      "fx_interactions", "type_weights"),
    "hybrid_scores": W(f"SELECT {HYB} FROM hybrid", "hybrid"),
    "hybrid_scores_onepass": W(f"SELECT {HYB} FROM hybrid", "hybrid"),
    "final_recommendations": W("SELECT CustomerID, CAST(rn AS INTEGER) AS rank, ProductID, "
                               + R6("hybrid_score") + " AS hybrid_score FROM ranked_recs WHERE rn <= 10",
                               "ranked_recs"),
    "final_recommendation_lists": W("SELECT CustomerID, string_agg(CAST(ProductID AS VARCHAR), ',' ORDER BY rn) "
                                    "AS recommended_products FROM ranked_recs WHERE rn <= 10 GROUP BY CustomerID",
                                    "ranked_recs"),
    "active_users": W("SELECT * FROM active", "active"),
    "cand_user_history": W("SELECT * FROM c_hist", "c_hist"),
    "cand_same_category": W("SELECT * FROM c_cat", "c_cat"),
    "cand_same_category_classes": _class_rows("same_category"),
    "cand_brand_affinity": W("SELECT * FROM c_brand", "c_brand"),
    "cand_brand_affinity_classes": _class_rows("brand_affinity"),
    "cand_fbt": W("SELECT i.CustomerID, b.ProductID_B AS ProductID, 'fbt' AS candidate_source "
                  "FROM interactions i JOIN fbt b ON i.ProductID = b.ProductID_A WHERE i.CustomerID IS NOT NULL",
                  "interactions", "fbt"),
    "cand_age_group": W("SELECT * FROM c_age", "c_age"),
    "cand_age_group_classes": _class_rows("age_group"),
    "cand_group_products": W(" UNION ALL ".join(
        f"SELECT '{k}' AS candidate_source, grp, ProductID FROM ({v[2]}) x WHERE grp IS NOT NULL"
        for k, v in GROUP_SOURCES.items()), "features", "agegroup_popular", "location_pop"),
    "cand_trending": W("SELECT * FROM c_trend", "c_trend"),
    "cand_discount": W("SELECT * FROM c_disc", "c_disc"),
    "cand_location": W("SELECT * FROM c_loc", "c_loc"),
    "cand_location_classes": _class_rows("location"),
    "candidates_final": W("SELECT CustomerID, ProductID, candidate_source FROM c_final", "c_final"),
    "location_popularity": W("SELECT * FROM location_pop", "location_pop"),
    "candidate_sources": W("SELECT CustomerID, ProductID, num_sources, candidate_sources FROM c_final", "c_final"),
    "features_final": W("SELECT CustomerID, ProductID, num_sources, candidate_sources, interaction_events, "
                        "last_interaction_ts, is_repeat_interaction, recency_days, "
                        + _r(["ProductRating"]) + ", ReviewsCount, " + _r(["DiscountPercent"])
                        + ", AgeGroup, " + _r(["AvgReviewRating"]) + ", PreviousPurchases FROM final_features",
                        "final_features"),
    "features_labeled": W("SELECT CustomerID, ProductID, candidate_source, user_total_interactions, "
                          "interaction_count, has_interacted, " + _r(["user_product_affinity"])
                          + ", is_repeat_interaction, label FROM labeled", "labeled"),
    "label_positive": W("SELECT ProductID, CustomerID, label FROM labeled WHERE label = 1", "labeled", instead=O.ALL_CANDIDATES),
    "feature_profile": W("SELECT column_name, " + R6("value") + " AS value, COUNT(*) AS n_rows FROM ("
                         + " UNION ALL ".join(
                             f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM labeled"
                             for c in fea.PROFILE_COLUMNS)
                         + ") p GROUP BY column_name, value", "labeled"),
    "feature_counts": W("SELECT COUNT(*) FILTER (WHERE interaction_events IS NULL) AS null_count, "
                        "COUNT(*) FILTER (WHERE interaction_events = 0) AS zero_count, "
                        "COUNT(*) FILTER (WHERE interaction_events = 1) AS one_count, "
                        "COUNT(*) AS total_rows FROM final_features", "final_features"),
    "top_sales_by_time": W(_top_sql("enriched", "EventTime", ["OrderID", "ProductID"], ENRICHED_R), "enriched"),
    "top_pairs": W(_top_sql("fbt", "together_orders", ["ProductID_A", "ProductID_B"]), "fbt"),
    "top_interactions": W(_top_sql("interactions", "interaction_score", ["CustomerID", "ProductID"]),
                          "interactions"),
    "top_trending": W(_top_sql("trending", "purchase_count", ["ProductID"]), "trending"),
    "top_category_prefs": W(_top_sql("preferences", "purchase_count", ["CustomerID", "Category"]), "preferences"),
    "top_agegroup_popular": W(_top_sql("agegroup_popular", "purchase_count", ["AgeGroup", "ProductID"]),
                              "agegroup_popular"),
    "top_weighted": W(_top_sql("weighted", R6("recency_weighted_score"), ["CustomerID", "ProductID"],
                               "CustomerID, ProductID, " + _r(["recency_weighted_score"])
                               + ", interaction_events, last_interaction_ts"), "weighted"),
    "top_products_by_quantity": W("SELECT ProductID, CAST(SUM(Quantity) AS BIGINT) AS total_quantity FROM enriched "
                                  "GROUP BY ProductID ORDER BY total_quantity DESC, ProductID ASC LIMIT 50",
                                  "enriched"),
    "preview_customers": W(f"SELECT {CUST_AGE_R} FROM customers_age ORDER BY CustomerID LIMIT 50", "customers_age"),
    "preview_price_profile": W("SELECT CustomerID, " + _r(["avg_price_paid", "min_price_paid", "max_price_paid",
                                                           "total_spent"])
                               + ", total_orders FROM price_profile ORDER BY CustomerID NULLS FIRST LIMIT 50",
                               "price_profile"),
    "preview_product_features": W("SELECT ProductID, ProductName, Category, Brand, "
                                  + _r(["CurrentProductPrice", "DiscountPercent"]) + ", Stock, "
                                  + _r(["ProductRating"]) + ", ReviewsCount FROM features "
                                  "ORDER BY ProductID LIMIT 50", "features"),
    "preview_price_bands": W("SELECT ProductID, ProductName, Category, Brand, " + _r(["CurrentProductPrice"])
                             + ", price_band FROM price_bands ORDER BY ProductID LIMIT 50", "price_bands"),
    "top_discounted": W("SELECT ProductID, ProductName, Category, Brand, "
                        + _r(["CurrentProductPrice", "DiscountPercent"]) + ", Stock, "
                        + _r(["ProductRating"]) + ", ReviewsCount FROM features WHERE DiscountPercent > 0 "
                        "ORDER BY DiscountPercent DESC, ProductID ASC LIMIT 50", "features"),
    "eda_interaction_types": W("SELECT InteractionType, COUNT(*) AS n FROM enriched GROUP BY InteractionType",
                               "enriched"),
    "eda_user_activity_hist": "",
    "eda_recency_hist": "",
    "eda_price_band_share": W("SELECT price_band, COUNT(*) AS n, "
                              + R6("COUNT(*) * 100.0e0 / (SELECT COUNT(*) FROM price_bands)")
                              + " AS share_pct FROM price_bands "
                              "GROUP BY price_band", "price_bands"),
    "eda_age_purchases": W("SELECT AgeGroup, CAST(SUM(purchase_count) AS BIGINT) AS purchases FROM agegroup_popular "
                           "WHERE AgeGroup IS NOT NULL GROUP BY AgeGroup", "agegroup_popular"),
    "eda_hybrid_hist": "",
    "eda_rec_length": W("SELECT rec_len, COUNT(*) AS users FROM (SELECT CustomerID, CAST(COUNT(*) AS INTEGER) "
                        "AS rec_len FROM ranked_recs WHERE rn <= 10 GROUP BY CustomerID) t GROUP BY rec_len",
                        "ranked_recs"),
    "eda_user_recency_volume": W(
        "SELECT CustomerID, CAST(SUM(interaction_events) AS BIGINT) AS total_interactions, "
        "MAX(last_interaction_ts) AS last_interaction, "
        f"CAST(floor(date_diff('second', MAX(last_interaction_ts), TIMESTAMP '{EVENTS_AS_OF} 00:00:00') / 86400.0e0) AS BIGINT) "
        f"AS days_since_last_interaction FROM ({_ev_weighted()}) w GROUP BY CustomerID", "fx_interactions", "type_weights"),
    "product_variants": W(
        "SELECT ProductID, 'color' AS variant_type, trim(v) AS variant FROM (SELECT ProductID, "
        "unnest(string_split(AvailableColors, ',')) AS v FROM latest_versions WHERE AvailableColors <> 'NA') a "
        "WHERE trim(v) <> '' UNION ALL "
        "SELECT ProductID, 'size' AS variant_type, trim(v) AS variant FROM (SELECT ProductID, "
        "unnest(string_split(AvailableSizes, ',')) AS v FROM latest_versions WHERE AvailableSizes <> 'NA') b "
        "WHERE trim(v) <> ''", "latest_versions"),
    "discount_percent": W("SELECT ProductID, " + R6("MRP") + " AS MRP, " + R6("Price") + " AS Price, "
                          "CASE WHEN MRP <> 0 THEN round((MRP - Price) / MRP * 100, 2) END AS DiscountPercent "
                          "FROM latest_versions", "latest_versions"),
    "activity_class": W("SELECT CustomerID, FrequencyOfPurchases, CASE WHEN lower(COALESCE(FrequencyOfPurchases, '')) "
                        "IN ('very frequent', 'high') THEN 'power' WHEN lower(COALESCE(FrequencyOfPurchases, '')) "
                        "IN ('medium') THEN 'active' ELSE 'casual' END AS activity_class FROM clean_customers",
                        "clean_customers"),
    "assigned_ids": "SELECT s_suppkey, s_name, (SELECT COALESCE(MAX(c_custkey), 0) FROM customer) "
                    "+ ROW_NUMBER() OVER (ORDER BY s_suppkey) AS NewID FROM supplier",
    "csv_roundtrip_customers": W(f"SELECT {CUST_CLEAN_R} FROM clean_customers", "clean_customers"),
    "csv_inferred_customers": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "sample_sales": W(f"SELECT {ENRICHED_R} FROM enriched WHERE {_sample_sql('0.1')}", "enriched"),
    "sample_sales_strata": W(f"SELECT {ENRICHED_R} FROM enriched WHERE " + _sample_sql(
        "CASE InteractionType " + " ".join(f"WHEN '{k}' THEN {f}" for k, f in SAMPLE_STRATA.items()) + " ELSE 0.1 END"), "enriched"),
    "sink_candidates": W("SELECT CustomerID, ProductID, candidate_source FROM c_final", "c_final"),
    "sink_labeled": W("SELECT CustomerID, ProductID, candidate_source, user_total_interactions, "
                      "interaction_count, has_interacted, " + _r(["user_product_affinity"])
                      + ", is_repeat_interaction, label FROM labeled", "labeled"),
    "medallion_recommendations": W("SELECT CustomerID, string_agg(CAST(ProductID AS VARCHAR), ',' ORDER BY rn) "
                                   "AS recommended_products FROM ranked_recs WHERE rn <= 10 GROUP BY CustomerID",
                                   "ranked_recs", instead=O.FROM_FEEDS),
    "medallion_enriched": W(f"SELECT {ENRICHED_R} FROM enriched", "enriched", instead=O.FROM_FEEDS),
    "medallion_trending": W("SELECT * FROM trending", "trending", instead=O.FROM_FEEDS),
    "feed_rejects": W("""SELECT *, COUNT(*) OVER (PARTITION BY error) AS stream_rows, COUNT(*) OVER (PARTITION BY error) AS batch_rows
FROM (SELECT OrderID, ProductID, "Timestamp", CASE WHEN n % 71 = 0 THEN 'malformed_line' WHEN ProductID IS NULL THEN 'missing_key'
        WHEN starts_with(ProductID, 'P-') THEN 'unparsable_key' WHEN "Timestamp" = 'junk' THEN 'bad_time'
        WHEN Quantity = '0' THEN 'bad_quantity' WHEN PriceAtPurchase IS NULL THEN 'bad_price' ELSE '' END AS error
      FROM (SELECT * REPLACE (CASE WHEN n % 73 = 0 THEN concat('P-', ProductID) WHEN n % 79 = 0 THEN NULL ELSE ProductID END
              AS ProductID) FROM (SELECT *, CAST(OrderID AS BIGINT) AS n FROM fx_raw_sales)))""", "fx_raw_sales"),
    "stream_bronze_sales": W("SELECT * FROM fx_raw_sales", "fx_raw_sales"),
    "stream_dedup_sales": W(f"SELECT {SALES_R} FROM clean_sales", "clean_sales"),
    "stream_snapshot_products": W(f"SELECT {PRODUCTS_R} FROM clean_products", "clean_products"),
}


def _hist_query(pre: str, needs: list[str], src: str, col: str, bins: int) -> str:
    body = _hist_sql(src, col, bins)
    sql = W("SELECT 1", *needs)
    # splice the extra CTEs (pre + histogram helpers) after the shared ones
    head = sql[: sql.rindex("\nSELECT 1")]
    if head:
        return head + ",\n" + pre + body
    return "WITH " + pre + body


ORACLE["eda_user_activity_hist"] = _hist_query(
    "per_user AS (SELECT CustomerID, SUM(interaction_score) AS total_score FROM interactions GROUP BY CustomerID)",
    ["interactions"], "per_user", "total_score", 50)
ORACLE["eda_recency_hist"] = _hist_query(
    f"evw AS ({_ev_weighted()})", ["fx_interactions", "type_weights"], "evw", "recency_weighted_score", 30)
ORACLE["eda_hybrid_hist"] = _hist_query("hy AS (SELECT * FROM hybrid)", ["hybrid"], "hy", "hybrid_score", 50)

# Rows-only (no SQL oracle): iterative models.
ROWS_ONLY = {"als_recommendations", "als_heldout_ranking"}
ORACLE = {k: v for k, v in ORACLE.items() if k in QUERIES and k not in ROWS_ONLY}
