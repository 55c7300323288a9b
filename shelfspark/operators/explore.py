"""Exploratory tables (EDA1-EDA9), previews and global top-k (TOP1-TOP6),
repeatable sampling by hash (SMP1).

The reference draws charts from pandas copies of whole tables; here the
tables behind the charts are computed in Spark and stay distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import as_of_timestamp, elapsed_days
from shelfspark.functions.frames import histogram, top_k

PREVIEW_ROWS = 50


def preview(df: DataFrame, key, n: int = PREVIEW_ROWS) -> DataFrame:
    """TOP1: first ``n`` rows by key (the reference's unordered LIMIT, made stable)."""
    return top_k(df, key, n)


def top_products_by_quantity(enriched: DataFrame, k: int = PREVIEW_ROWS) -> DataFrame:
    """TOP5 / EDA3: top-k products by total quantity over all interactions."""
    agg = enriched.groupBy("ProductID").agg(F.sum("Quantity").cast("long").alias("total_quantity"))
    return top_k(agg, [F.col("total_quantity").desc(), F.col("ProductID").asc()], k)


def _share(fraction: float) -> str:
    """The first eight hex digits below which that share of all hashes lies."""
    return format(min(int(fraction * (1 << 32)), (1 << 32) - 1), "08x")


def sample_rows(df: DataFrame, fraction: float = 0.1, keys=("OrderID", "ProductID"), seed: int = 42,
                stratum: str | None = None, fractions: dict | None = None) -> DataFrame:
    """SMP1: a sample by the hash of each row's key: the same rows on every run and
    under every partitioning, and rows of one key stay together.

    A row is taken if the MD5 of seed and key starts below ``fraction``. With
    ``stratum``, ``fractions`` gives the share of a stratum's value (others:
    ``fraction``). Without bias for any key; NULL key parts count as empty.
    ``fraction`` 1 takes everything.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    digest = F.substring(F.md5(text), 1, 8)
    taken = lambda f: F.lit(True) if f >= 1 else digest < F.lit(_share(f))
    keep = taken(fraction)
    for value, f in (fractions or {}).items():
        keep = F.when(F.col(stratum) == value, taken(f)).otherwise(keep)
    return df.where(keep)


def interaction_type_counts(enriched: DataFrame) -> DataFrame:
    """EDA1: rows per interaction type."""
    return enriched.groupBy("InteractionType").agg(F.count(F.lit(1)).alias("n"))


def user_activity_histogram(interactions: DataFrame, bins: int = 50) -> DataFrame:
    """EDA2: per-user total interaction score, equal-width histogram."""
    per_user = interactions.groupBy("CustomerID").agg(F.sum("interaction_score").alias("total_score"))
    return histogram(per_user, "total_score", bins)


def recency_histogram(weighted: DataFrame, bins: int = 30) -> DataFrame:
    """EDA4: histogram of the recency-weighted score."""
    return histogram(weighted, "recency_weighted_score", bins)


def price_band_share(bands: DataFrame) -> DataFrame:
    """EDA5: products per price band and percent of all products.

    The grand total is a scalar subquery (one row), not a window over the
    whole table."""
    counts = bands.groupBy("price_band").agg(F.count(F.lit(1)).alias("n"))
    total = bands.agg(F.count(F.lit(1))).scalar()
    return counts.select("price_band", "n", (F.col("n") * 100.0 / total).alias("share_pct"))


def age_group_purchases(agegroup_popular: DataFrame) -> DataFrame:
    """EDA6: purchases per age group (NULL group excluded)."""
    return (agegroup_popular.where(F.col("AgeGroup").isNotNull())
            .groupBy("AgeGroup").agg(F.sum("purchase_count").cast("long").alias("purchases")))


def hybrid_histogram(hybrid: DataFrame, bins: int = 50) -> DataFrame:
    """EDA7: histogram of hybrid_score over the whole table."""
    return histogram(hybrid, "hybrid_score", bins)


def recommendation_lengths(final_recs: DataFrame) -> DataFrame:
    """EDA8: users per recommendation-list length."""
    return (final_recs.groupBy(F.size("recommended_products").alias("rec_len"))
            .agg(F.count(F.lit(1)).alias("users")))


def user_recency_volume(weighted: DataFrame, as_of=None) -> DataFrame:
    """EDA9: per user total events, last interaction, whole days since it."""
    per_user = weighted.groupBy("CustomerID").agg(
        F.sum("interaction_events").cast("long").alias("total_interactions"),
        F.max("last_interaction_ts").alias("last_interaction"))
    return per_user.withColumn(
        "days_since_last_interaction",
        elapsed_days(F.col("last_interaction"), as_of_timestamp(as_of)))
