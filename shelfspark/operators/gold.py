"""Gold aggregates over the enriched fact.

AGG1-AGG8, JN2 (order self-join), JN3 (age-group join), PRJ2 (price
bands), FLT4-FLT6. Every aggregate is a ``groupBy().agg()``: partial
(map-side) aggregation runs before the shuffle, so a hot key costs one
pre-aggregated row per task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import (
    TYPE_KEY, as_of_date, interaction_weight, is_type, price_band, recency_decay,
)
from shelfspark.sources.days import period


def purchases(df: DataFrame) -> DataFrame:
    """FLT4: case-insensitive ``InteractionType = 'purchase'``; a fact stored with its
    types in lower case (``with_type_key``) is filtered by equality, in the scan."""
    if TYPE_KEY in df.columns:
        return df.where(F.col(TYPE_KEY) == "purchase")
    return df.where(is_type("InteractionType", "purchase"))


def user_product_interactions(enriched: DataFrame) -> DataFrame:
    """AGG1 gold_user_product_interactions (the implicit-feedback matrix)."""
    return (purchases(enriched)
            .groupBy("CustomerID", "ProductID")
            .agg(F.sum(F.coalesce(F.col("Quantity"), F.lit(1))).cast("long").alias("interaction_score"),
                 F.count(F.lit(1)).alias("interaction_events"),
                 F.max("EventTime").alias("last_interaction_ts")))


def _labelled_agg(df: DataFrame, keys: list[str], labels: list[str], aggs: list,
                  merges: list) -> DataFrame:
    """``groupBy(keys).agg(max(labels)..., aggs...)`` without sorting the input.

    String MAX cannot use a hash aggregate (Spark falls back to a sort
    aggregate over every input row). Labels are constant per key in
    practice, so the heavy pass groups by keys + labels with hash
    aggregation (partial, map-side), and only its reduced output goes
    through the MAX over labels. ``merges`` re-aggregate ``aggs`` by name.
    """
    first = df.groupBy(*keys, *labels).agg(*aggs)
    return first.groupBy(*keys).agg(*[F.max(c).alias(c) for c in labels], *merges)


def product_features(enriched: DataFrame) -> DataFrame:
    """AGG2 gold_product_features: MAX of 8 attributes over all interaction types."""
    nums = ["CurrentProductPrice", "DiscountPercent", "Stock", "ProductRating", "ReviewsCount"]
    out = _labelled_agg(enriched, ["ProductID"], ["ProductName", "Category", "Brand"],
                        [F.max(c).alias(c) for c in nums],
                        [F.max(c).alias(c) for c in nums])
    return out.select("ProductID", "ProductName", "Category", "Brand", *nums)


def order_items(enriched: DataFrame) -> DataFrame:
    """DED4: distinct (OrderID, ProductID) of purchases."""
    return purchases(enriched).select("OrderID", "ProductID").distinct()


def frequent_items(items: DataFrame, min_support: int) -> DataFrame:
    """Rows of ``order_items`` whose product is in at least ``min_support`` orders."""
    support = items.groupBy("ProductID").agg(F.count(F.lit(1)).alias("_support"))
    return items.join(support.where(F.col("_support") >= min_support).select("ProductID"), "ProductID", "left_semi")


def _pairs(items: DataFrame, chunk_items: int) -> DataFrame:
    """Each order's pairs a < b. An order has ceil(items / ``chunk_items``)
    buckets, one in ordinary orders; item p is in bucket h(p). The left side
    is replicated over every right bucket and vice versa, so the pair (p, q)
    meets exactly once, on key (order, h(p), h(q))."""
    sizes = items.groupBy("OrderID").agg(F.ceil(F.count(F.lit(1)) / chunk_items).alias("_k"))
    dealt = items.join(sizes, "OrderID")
    h = F.pmod(F.xxhash64("ProductID"), F.col("_k"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))
    a = dealt.select("OrderID", F.col("ProductID").alias("ProductID_A"),
                     h.alias("_ba"), every.alias("_bb"))
    b = dealt.select("OrderID", F.col("ProductID").alias("ProductID_B"),
                     every.alias("_ba"), h.alias("_bb"))
    return (a.join(b, ["OrderID", "_ba", "_bb"])
             .where(F.col("ProductID_A") < F.col("ProductID_B"))
             .select("ProductID_A", "ProductID_B"))


def frequently_bought_together(enriched: DataFrame, min_support: int = 1,
                               chunk_items: int = 1_000) -> DataFrame:
    """JN2 + AGG3 gold_frequently_bought_together.

    Items are distinct per order, so ``COUNT(DISTINCT OrderID)`` per pair is
    ``COUNT(*)``: one aggregate level instead of two. One join key holds about
    ``chunk_items`` items a side, whatever the size of its order (``_pairs``).
    The output is inherently every co-purchased pair.

    With ``min_support`` above 1, products in fewer orders than that leave before
    the self-join: a pair is in no more orders than either of its products
    (a-priori), so no pair of the result is lost and rare products make no pairs.
    """
    items = order_items(enriched)
    if min_support > 1:
        items = frequent_items(items, min_support)
    return (_pairs(items, chunk_items).groupBy("ProductID_A", "ProductID_B")
                 .agg(F.count(F.lit(1)).alias("together_orders"))
                 .where(F.col("together_orders") >= min_support))


def trending_products(enriched: DataFrame, as_of=None, days: int = 30, grain: str = "day") -> DataFrame:
    """AGG4 + FLT5 gold_trending_products_30d: purchases on or after
    ``as_of - days`` (midnight, inclusive; no upper bound). ``grain``: of a fact
    that is stored by period (``sources.days``)."""
    start = F.date_sub(as_of_date(as_of), days)
    recent = purchases(enriched).where(F.col("EventTime") >= start)
    if "event_date" in enriched.columns:
        # a fact stored partitioned by event date: the bound's own period on the
        # partition column lets the scan skip older partitions
        recent = recent.where(F.col("event_date") >= period(start, grain))
    # One pass, three levels: (product, customer, labels) with hash
    # aggregation over the raw rows, then (product, customer), then product:
    # the distinct-customer count is the number of non-NULL customers left
    # at level two, and string MAX only runs on reduced rows.
    labels = ["ProductName", "Category", "Brand"]
    lvl1 = recent.groupBy("ProductID", "CustomerID", *labels).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("Quantity").alias("_q"), F.max("EventTime").alias("_ts"))
    lvl2 = lvl1.groupBy("ProductID", "CustomerID").agg(
        *[F.max(c).alias(c) for c in labels], F.sum("_n").alias("_n"), F.sum("_q").alias("_q"),
        F.max("_ts").alias("_ts"))
    return lvl2.groupBy("ProductID").agg(
        *[F.max(c).alias(c) for c in labels],
        F.sum("_n").cast("long").alias("purchase_count"),
        F.sum("_q").cast("long").alias("total_quantity"),
        F.count("CustomerID").alias("unique_customers"),
        F.max("_ts").alias("last_purchase_ts"))


def user_category_preferences(enriched: DataFrame) -> DataFrame:
    """AGG5 + FLT6 gold_user_category_preferences."""
    return (purchases(enriched).where(F.col("Category").isNotNull())
            .groupBy("CustomerID", "Category")
            .agg(F.count(F.lit(1)).alias("purchase_count"),
                 F.sum("Quantity").cast("long").alias("total_quantity"),
                 F.max("EventTime").alias("last_purchase_ts")))


def user_price_profile(enriched: DataFrame) -> DataFrame:
    """AGG6 gold_user_price_profile (``total_orders`` counts purchase lines)."""
    return (purchases(enriched).groupBy("CustomerID")
            .agg(F.avg("PriceAtPurchase").alias("avg_price_paid"),
                 F.min("PriceAtPurchase").alias("min_price_paid"),
                 F.max("PriceAtPurchase").alias("max_price_paid"),
                 F.sum(F.col("PriceAtPurchase") * F.col("Quantity")).alias("total_spent"),
                 F.count(F.lit(1)).alias("total_orders")))


def product_price_bands(features: DataFrame, bounds=None) -> DataFrame:
    """PRJ2 gold_product_price_bands."""
    band = price_band("CurrentProductPrice") if bounds is None else price_band("CurrentProductPrice", bounds)
    return features.select("ProductID", "ProductName", "Category", "Brand",
                           "CurrentProductPrice", band.alias("price_band"))


def agegroup_popular_products(enriched: DataFrame, customers_age: DataFrame | None = None) -> DataFrame:
    """AGG7 (+ JN3) gold_agegroup_popular_products.

    The enriched fact already carries ``AgeGroup`` from the same left join on
    the (unique) CustomerID, so by default no second join is made. Passing
    ``customers_age`` performs the explicit left join instead (same result
    for a dimension with unique keys). Unknown customers form a NULL group.
    """
    p = purchases(enriched)
    if customers_age is not None:
        p = (p.drop("AgeGroup")
              .join(customers_age.select("CustomerID", "AgeGroup"), "CustomerID", "left"))
    out = _labelled_agg(p, ["AgeGroup", "ProductID"], ["ProductName", "Category"],
                        [F.count(F.lit(1)).alias("purchase_count"),
                         F.sum("Quantity").cast("long").alias("total_quantity")],
                        [F.sum("purchase_count").cast("long").alias("purchase_count"),
                         F.sum("total_quantity").cast("long").alias("total_quantity")])
    return out.select("AgeGroup", "ProductID", "ProductName", "Category",
                      "purchase_count", "total_quantity")


def user_product_interactions_weighted(enriched: DataFrame, as_of=None, weights=None,
                                       rate: float = 0.1) -> DataFrame:
    """AGG8 gold_user_product_interactions_weighted:
    Σ weight(type)·exp(−rate·days), events, last time, per (user, product)."""
    w = interaction_weight("InteractionType", weights)
    score = w * recency_decay("EventTime", as_of, rate)
    return (enriched.where(F.col("CustomerID").isNotNull() & F.col("ProductID").isNotNull())
            .groupBy("CustomerID", "ProductID")
            .agg(F.sum(score).alias("recency_weighted_score"),
                 F.count(F.lit(1)).alias("interaction_events"),
                 F.max("EventTime").alias("last_interaction_ts")))


def location_popularity(enriched: DataFrame) -> DataFrame:
    """AGG10: interactions of all types per (CustomerLocation, ProductID)."""
    return (enriched.groupBy("CustomerLocation", "ProductID")
            .agg(F.count(F.lit(1)).alias("interaction_count")))
