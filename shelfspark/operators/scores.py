"""Hybrid user-product score (SCR1-SCR4, JN4).

``hybrid_scores`` is the table-level definition: interactions ⟕ weighted
(2 keys) ⟕ product features ⟕ silver products. The content term compares
the feature row of a product with the product row of the *same* product,
so it is 1.0 unless Brand is NULL (then 0.7 if Category is known, else
0.2); kept as defined.

``hybrid_scores_from_fact`` computes the same table from the enriched
fact in ONE aggregation by (CustomerID, ProductID): the purchase
aggregate, the recency sum and the (per-product constant) content term
are conditional aggregates of the same group, so the three joins and
their shuffles disappear. Equality with ``hybrid_scores`` is a test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import (
    DEFAULT_CONTENT_MATCH, DEFAULT_HYBRID_WEIGHTS, content_match, interaction_weight,
    is_type, recency_decay,
)

HYBRID_COLUMNS = ["CustomerID", "ProductID", "cf_weighted_score", "recency_weighted_score",
                  "content_similarity_score", "hybrid_score"]


def _combine(df: DataFrame, score, recency, content, weights) -> DataFrame:
    wi, wr, wc = weights
    cf = score.cast("double") * F.lit(wi)
    rec = F.coalesce(recency, F.lit(0.0)) * F.lit(wr)
    con = content * F.lit(wc)
    return df.select("CustomerID", "ProductID",
                     cf.alias("cf_weighted_score"),
                     rec.alias("recency_weighted_score"),
                     con.alias("content_similarity_score"),
                     (cf + rec + con).alias("hybrid_score"))


def hybrid_scores(interactions: DataFrame, weighted: DataFrame, features: DataFrame,
                  products: DataFrame, weights=DEFAULT_HYBRID_WEIGHTS,
                  strengths=DEFAULT_CONTENT_MATCH) -> DataFrame:
    """SCR4 + JN4 gold_hybrid_user_product_scores from the gold tables."""
    up = interactions.select("CustomerID", "ProductID", "interaction_score")
    w = weighted.select("CustomerID", "ProductID", F.col("recency_weighted_score").alias("_rws"))
    pf = features.select("ProductID", F.col("Brand").alias("_pf_brand"),
                         F.col("Category").alias("_pf_cat"))
    sp = products.select("ProductID", F.col("Brand").alias("_sp_brand"),
                         F.col("Category").alias("_sp_cat"))
    j = (up.join(w, ["CustomerID", "ProductID"], "left")
           .join(pf, "ProductID", "left")
           .join(sp, "ProductID", "left"))
    content = content_match("_pf_brand", "_sp_brand", "_pf_cat", "_sp_cat", strengths)
    return _combine(j, F.col("interaction_score"), F.col("_rws"), content, weights)


def hybrid_scores_from_fact(fact: DataFrame, as_of=None, weights=DEFAULT_HYBRID_WEIGHTS,
                            strengths=DEFAULT_CONTENT_MATCH, type_weights=None,
                            rate: float = 0.1) -> DataFrame:
    """The same table as ``hybrid_scores`` from the enriched fact in one pass.

    ``fact`` needs CustomerID, ProductID, InteractionType, Quantity,
    EventTime, Brand, Category (see ``facts.sales_with_products``).
    """
    is_p = is_type("InteractionType", "purchase")
    decay = interaction_weight("InteractionType", type_weights) * recency_decay("EventTime", as_of, rate)
    same_brand, same_cat, other = strengths
    agg = (fact.groupBy("CustomerID", "ProductID")
               .agg(F.sum(F.when(is_p, F.coalesce(F.col("Quantity"), F.lit(1)))).cast("long").alias("_score"),
                    F.sum(decay).alias("_rws"),
                    F.max(F.col("Brand").isNotNull().cast("int")).alias("_brand"),
                    F.max(F.col("Category").isNotNull().cast("int")).alias("_cat"))
               .where(F.col("_score").isNotNull()))
    # The weighted table drops NULL users, so their recency term is 0.
    rws = F.when(F.col("CustomerID").isNotNull(), F.col("_rws"))
    content = (F.when(F.col("_brand") == 1, F.lit(same_brand))
                .when(F.col("_cat") == 1, F.lit(same_cat))
                .otherwise(F.lit(other)))
    return _combine(agg, F.col("_score"), rws, content, weights)
