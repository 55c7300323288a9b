"""Dimensions and per-row derivations.

PRJ1 (age group), FN14 (product variants), FN15 (discount percent),
FN16 (activity class), FN17 (surrogate ids), plus conforming typed
inputs to the silver column sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.columns import activity_class, age_group, discount_percent
from shelfspark.functions.frames import assign_ids

SILVER_CUSTOMER_TYPES = [
    ("CustomerID", T.LongType()), ("CustomerName", T.StringType()),
    ("Age", T.IntegerType()), ("Gender", T.StringType()), ("Location", T.StringType()),
    ("SubscriptionStatus", T.StringType()), ("PaymentMethod", T.StringType()),
    ("PreviousPurchases", T.IntegerType()), ("FrequencyOfPurchases", T.StringType()),
    ("PreferredSeason", T.StringType()), ("AvgReviewRating", T.DoubleType()),
]
SILVER_PRODUCT_TYPES = [
    ("ProductID", T.LongType()), ("ProductName", T.StringType()),
    ("Category", T.StringType()), ("Brand", T.StringType()),
    ("Description", T.StringType()), ("AvailableColors", T.StringType()),
    ("AvailableSizes", T.StringType()), ("MRP", T.DoubleType()), ("Price", T.DoubleType()),
    ("DiscountPercent", T.DoubleType()), ("Stock", T.IntegerType()),
    ("Rating", T.DoubleType()), ("ReviewsCount", T.IntegerType()),
    ("IsUpdated", T.StringType()), ("LastUpdated", T.TimestampNTZType()),
]


def _conform(df: DataFrame, spec) -> DataFrame:
    return df.select(*[
        (F.col(n).cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n)
        for n, t in spec])


def conform_customers(df: DataFrame) -> DataFrame:
    """Typed customers -> the silver customer columns (missing ones NULL)."""
    return _conform(df, SILVER_CUSTOMER_TYPES)


def conform_products(df: DataFrame) -> DataFrame:
    """Typed products -> the silver product columns (missing ones NULL)."""
    return _conform(df, SILVER_PRODUCT_TYPES)


def customers_with_age_group(silver_customers: DataFrame) -> DataFrame:
    """PRJ1 gold_customers_with_age_group: 11 customer columns + AgeGroup."""
    c = conform_customers(silver_customers)
    return (c.where(F.col("CustomerID").isNotNull())
             .withColumn("AgeGroup", age_group("Age")))


def product_variants(products: DataFrame) -> DataFrame:
    """FN14: one row per (ProductID, variant_type, variant) from the comma
    lists; 'NA' and empty entries give no rows."""
    def one(col: str, kind: str) -> DataFrame:
        v = F.trim(F.col("_v"))
        return (products.where(F.col(col) != "NA")
                        .select("ProductID", F.explode(F.split(F.col(col), ",")).alias("_v"))
                        .select("ProductID", F.lit(kind).alias("variant_type"), v.alias("variant"))
                        .where(F.col("variant").isNotNull() & (F.col("variant") != "")))
    return one("AvailableColors", "color").unionByName(one("AvailableSizes", "size"))


def with_discount_percent(products: DataFrame, scale: int = 2) -> DataFrame:
    """FN15: DiscountPercent recomputed from MRP and Price."""
    return products.withColumn("DiscountPercent", discount_percent("MRP", "Price", scale))


def with_activity_class(customers: DataFrame) -> DataFrame:
    """FN16: power / active / casual from FrequencyOfPurchases."""
    return customers.withColumn("activity_class", activity_class("FrequencyOfPurchases"))


def assign_new_ids(new: DataFrame, existing: DataFrame, existing_id: str,
                   order, id_col: str = "NewID") -> DataFrame:
    """FN17: next surrogate ids after max(existing), consecutive in ``order``."""
    return assign_ids(new, existing, existing_id, order, id_col)
