"""Ranking features and labels (FEA1-FEA10, JN12-JN14, AGG11-AGG14, FLT8).

Both reference paths stay in Spark: the pandas path (collect both tables
to the driver, merge, ship back) becomes two left joins and column
expressions; nothing is collected.

Candidates come as pairs, or as one row per user (``candidates.candidate_lists``).
In the second form everything that is joined by user is joined before the lists
become pairs, so no pair is shuffled or sorted: a user's own interactions travel
as a map of the products on the user's list, and product attributes are cut to the
products on any list (a table that is broadcast where it is small enough).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import as_of_date
from shelfspark.operators.candidates import sources_of

# Fixed value: recency of a pair that never met.
NEVER_DAYS = 999


def in_lists(cands: DataFrame) -> bool:
    """Whether candidates come as one row per user."""
    return "ids" in cands.columns


def _met(lists: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """``lists`` (one row per user) with ``_met``: for each product on the user's list that has rows in
    ``pairs``, their ``columns`` (an array: a pair may come twice). Rows of products
    that are not on the list go before anything is gathered."""
    own = lists.select("CustomerID", "ids")
    hits = pairs.join(own, "CustomerID").where(F.array_contains("ids", F.col("ProductID")))
    rows = hits.groupBy("CustomerID", "ProductID").agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    met = rows.groupBy("CustomerID").agg(F.map_from_entries(F.collect_list(F.struct("ProductID", "_rows"))).alias("_met"))
    return lists.join(met, "CustomerID", "left")


def _unpacked(lists: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """One row per candidate and matching row of ``_met`` (one with NULLs if none):
    CustomerID, ``keep``, ProductID, _mask, ``columns``."""
    each = lists.select("CustomerID", *keep, "_met", F.explode(F.arrays_zip("ids", "masks")).alias("_p"))
    rows = each.select("CustomerID", *keep, F.col("_p.ids").alias("ProductID"), F.col("_p.masks").alias("_mask"),
                       F.explode_outer(F.try_element_at("_met", F.col("_p.ids"))).alias("_row"))
    return rows.select("CustomerID", *keep, "ProductID", "_mask", *[F.col(f"_row.{c}").alias(c) for c in columns])


def _listed_products(features: DataFrame, lists: DataFrame) -> DataFrame:
    """The attributes of products on any list, written: their size is known when the join is planned."""
    from shelfspark.session import written
    ids = lists.select(F.explode("ids").alias("ProductID")).distinct()
    return written(features.join(ids, "ProductID", "left_semi"), "listed-products")


EVENT_COLUMNS = ["interaction_events", "last_interaction_ts"]


def interaction_features(cands: DataFrame, interactions: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """FEA2 / JN12: events (0 when none), last time, repeat flag (events > 0).
    ``users``: columns by CustomerID that candidates in lists get before they become pairs."""
    ui = interactions.select("CustomerID", "ProductID", *EVENT_COLUMNS)
    if in_lists(cands):
        met = _met(cands, ui, EVENT_COLUMNS)
        keep = [] if users is None else [c for c in users.columns if c != "CustomerID"]
        j = _unpacked(met if users is None else met.join(users, "CustomerID", "left"), keep, EVENT_COLUMNS)
    else:
        j = cands.join(ui, ["CustomerID", "ProductID"], "left")
    ev = F.coalesce(F.col("interaction_events"), F.lit(0))
    return (j.withColumn("interaction_events", ev)
             .withColumn("is_repeat_interaction", F.when(ev > 0, 1).otherwise(0)))


def with_recency_days(df: DataFrame, as_of=None) -> DataFrame:
    """FEA3: calendar days since the last interaction, 999 when never."""
    d = F.datediff(as_of_date(as_of), F.col("last_interaction_ts"))
    return df.withColumn("recency_days",
                         F.when(F.col("last_interaction_ts").isNotNull(), d).otherwise(NEVER_DAYS))


def with_attributes(df: DataFrame, features: DataFrame, customers_age: DataFrame) -> DataFrame:
    """FEA4 / JN13: product and customer attributes (left joins)."""
    pf = features.select("ProductID", *PRODUCT_ATTRIBUTES)
    cu = customers_age.select("CustomerID", *CUSTOMER_ATTRIBUTES)
    return df.join(pf, "ProductID", "left").join(cu, "CustomerID", "left")


PRODUCT_ATTRIBUTES = ["ProductRating", "ReviewsCount", "DiscountPercent"]
CUSTOMER_ATTRIBUTES = ["AgeGroup", "AvgReviewRating", "PreviousPurchases"]
FINAL_FEATURE_COLUMNS = [
    "CustomerID", "ProductID", "num_sources", "candidate_sources", "interaction_events",
    "last_interaction_ts", "is_repeat_interaction", "recency_days", "ProductRating",
    "ReviewsCount", "DiscountPercent", "AgeGroup", "AvgReviewRating", "PreviousPurchases",
]


def final_features(cand_sources: DataFrame, interactions: DataFrame, features: DataFrame,
                   customers_age: DataFrame, as_of=None) -> DataFrame:
    """final_features: FEA1 provenance + FEA2 + FEA3 + FEA4.

    ``cand_sources`` has CustomerID, ProductID, num_sources, candidate_sources
    (``candidates.candidates_with_sources``), or is ``candidates.candidate_lists``.
    """
    if in_lists(cand_sources):
        own = customers_age.select("CustomerID", *CUSTOMER_ATTRIBUTES)
        pf = _listed_products(features.select("ProductID", *PRODUCT_ATTRIBUTES), cand_sources)
        df = interaction_features(cand_sources, interactions, own)
        return (sources_of(with_recency_days(df, as_of).join(pf, "ProductID", "left"))
                .select(*FINAL_FEATURE_COLUMNS))
    base = cand_sources.select("CustomerID", "ProductID", "num_sources", "candidate_sources")
    df = with_recency_days(interaction_features(base, interactions), as_of)
    return with_attributes(df, features, customers_age).select(*FINAL_FEATURE_COLUMNS)


LABELED_COLUMNS = [
    "CustomerID", "ProductID", "candidate_source", "user_total_interactions",
    "interaction_count", "has_interacted", "user_product_affinity",
    "is_repeat_interaction", "label",
]


def labeled_features(candidates: DataFrame, interactions: DataFrame) -> DataFrame:
    """FEA5-FEA9 _gold_candidate_features_labeled.

    user_total_interactions: products the user interacted with (AGG12);
    interaction_count: rows per pair (AGG13, always 1 on a unique input);
    NULLs in numeric features become 0 (FEA5); affinity = count / (total+1)
    (FEA6); repeat = count > 1 (FEA7); label = has_interacted (FEA8; note it
    is also a feature). NULL keys never match (pandas would match NaN keys).
    """
    ui = interactions.where(F.col("CustomerID").isNotNull() & F.col("ProductID").isNotNull())
    user_stats = ui.groupBy("CustomerID").agg(F.count("ProductID").alias("user_total_interactions"))
    pair_stats = (ui.groupBy("CustomerID", "ProductID")
                    .agg(F.count("ProductID").alias("interaction_count"))
                    .withColumn("has_interacted", F.lit(1)))
    if in_lists(candidates):
        counts = ["interaction_count", "has_interacted"]
        df = sources_of(_unpacked(_met(candidates, pair_stats, counts).join(user_stats, "CustomerID", "left"),
                                  ["user_total_interactions"], counts))
    else:
        df = (candidates.select("CustomerID", "ProductID", "candidate_source")
                        .join(user_stats, "CustomerID", "left")
                        .join(pair_stats, ["CustomerID", "ProductID"], "left"))
    df = df.fillna(0, subset=["user_total_interactions", "interaction_count", "has_interacted"])
    return (df.withColumn("user_product_affinity",
                          F.col("interaction_count") / (F.col("user_total_interactions") + 1))
              .withColumn("is_repeat_interaction", F.when(F.col("interaction_count") > 1, 1).otherwise(0))
              .withColumn("label", F.col("has_interacted"))
              .select(*LABELED_COLUMNS))


def positive_labels(labeled: DataFrame) -> DataFrame:
    """FLT8: label == 1, three columns."""
    return labeled.where(F.col("label") == 1).select("ProductID", "CustomerID", "label")


PROFILE_COLUMNS = ["user_total_interactions", "interaction_count", "has_interacted",
                   "user_product_affinity", "is_repeat_interaction", "label"]


def feature_profile(labeled: DataFrame, columns=PROFILE_COLUMNS) -> DataFrame:
    """FEA10: distinct values per column with their row counts, in one pass
    (explode of (name, value) pairs, then one partial-aggregated count)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns]))
    return (labeled.select(pairs.alias("_p"))
                   .groupBy(F.col("_p.column_name").alias("column_name"),
                            F.col("_p.value").alias("value"))
                   .agg(F.count(F.lit(1)).alias("n_rows")))


def feature_counts(features: DataFrame) -> DataFrame:
    """AGG14: the two sanity counters (NULL events, exactly one event) in one pass."""
    ev = F.col("interaction_events")
    return features.agg(F.count_if(ev.isNull()).alias("null_count"),
                        F.count_if(ev == 0).alias("zero_count"),
                        F.count_if(ev == 1).alias("one_count"),
                        F.count(F.lit(1)).alias("total_rows"))
