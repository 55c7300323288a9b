"""Bronze -> silver: typing, cleaning, validity, deterministic dedup.

CLN1-3 (cleaning), FLT1-2 (NULL key, validity), DED1-3 (latest per key),
PRJ3 (helper rank dropped), FN1-FN8 (trim, regexp, try_cast, coalesce,
searched CASE).

Typing uses ``try_cast`` everywhere: a malformed key gives NULL and the
row is dropped by the key filter instead of failing the whole job.
Dedup is deterministic: ``ingest_ts`` (one constant per run) is only
the first sort key; business time and then every remaining column break
the tie, all DESC NULLS LAST. Each dedup is one shuffle on its key with
a per-task group limit before the shuffle (hot keys ship one row per
task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import digits_only
from shelfspark.functions.frames import latest_by

# Dedup order after ingest_ts (all DESC NULLS LAST).
CUSTOMER_TIEBREAK = [
    "CustomerName", "ContactNumber", "Age", "Gender", "Location",
    "SubscriptionStatus", "PaymentMethod", "PreviousPurchases",
    "FrequencyOfPurchases", "PreferredSeason", "AvgReviewRating",
]
PRODUCT_ORDER = [
    "LastUpdated", "ingest_ts", "ProductName", "Category", "Brand", "Description",
    "AvailableColors", "AvailableSizes", "MRP", "Price", "DiscountPercent",
    "Stock", "Rating", "ReviewsCount", "IsUpdated",
]
SALES_ORDER = [
    "ingest_ts", "EventTime", "LineNo", "CustomerID", "InteractionType", "Quantity",
    "PriceAtPurchase", "PaymentMethod", "SizeSelected", "ColorSelected",
    "Category", "Brand", "DiscountUsed", "Season",
]


def _ingest(ingest_ts: Column | None) -> Column:
    return F.localtimestamp() if ingest_ts is None else ingest_ts


def _desc(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in names if c in df.columns]


def cast_customers(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """CLN1 + FLT1 without dedup: typed, trimmed customers."""
    rating = F.col("AvgReviewRating").try_cast("double")
    typed = bronze.where(F.col("CustomerID").isNotNull()).select(
        F.col("CustomerID").try_cast("bigint").alias("CustomerID"),
        F.trim("CustomerName").alias("CustomerName"),
        digits_only("ContactNumber").alias("ContactNumber"),
        F.col("Age").try_cast("int").alias("Age"),
        F.trim("Gender").alias("Gender"),
        F.trim("Location").alias("Location"),
        F.trim("SubscriptionStatus").alias("SubscriptionStatus"),
        F.trim("PaymentMethod").alias("PaymentMethod"),
        F.coalesce(F.col("PreviousPurchases").try_cast("int"), F.lit(0)).alias("PreviousPurchases"),
        F.trim("FrequencyOfPurchases").alias("FrequencyOfPurchases"),
        F.trim("PreferredSeason").alias("PreferredSeason"),
        F.when(rating.between(0, 5), rating).alias("AvgReviewRating"),
        _ingest(ingest_ts).alias("ingest_ts"),
    )
    return typed.where(F.col("CustomerID").isNotNull())


def clean_customers(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """silver_customers: CLN1 + DED1 (latest row per CustomerID)."""
    typed = cast_customers(bronze, ingest_ts)
    order = [F.col("ingest_ts").desc_nulls_last()] + _desc(typed, CUSTOMER_TIEBREAK)
    return latest_by(typed, "CustomerID", order)


def cast_products(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """CLN2 + FLT1 without dedup: typed, trimmed product versions."""
    typed = bronze.where(F.col("ProductID").isNotNull()).select(
        F.col("ProductID").try_cast("bigint").alias("ProductID"),
        F.trim("ProductName").alias("ProductName"),
        F.trim("Category").alias("Category"),
        F.trim("Brand").alias("Brand"),
        F.trim("Description").alias("Description"),
        F.trim("AvailableColors").alias("AvailableColors"),
        F.trim("AvailableSizes").alias("AvailableSizes"),
        F.col("MRP").try_cast("double").alias("MRP"),
        F.col("Price").try_cast("double").alias("Price"),
        F.col("DiscountPercent").try_cast("double").alias("DiscountPercent"),
        F.col("Stock").try_cast("int").alias("Stock"),
        F.col("Rating").try_cast("double").alias("Rating"),
        F.col("ReviewsCount").try_cast("int").alias("ReviewsCount"),
        F.trim("IsUpdated").alias("IsUpdated"),
        F.col("LastUpdated").try_cast("timestamp_ntz").alias("LastUpdated"),
        _ingest(ingest_ts).alias("ingest_ts"),
    )
    return typed.where(F.col("ProductID").isNotNull())


def latest_product(versions: DataFrame) -> DataFrame:
    """DED2: latest snapshot per ProductID by LastUpdated, then ingest_ts."""
    return latest_by(versions, "ProductID", _desc(versions, PRODUCT_ORDER))


def clean_products(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """silver_products: CLN2 + DED2."""
    return latest_product(cast_products(bronze, ingest_ts))


def cast_sales(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """CLN3 + FLT1: typed sales (Quantity defaults to 1, tolerant timestamp)."""
    return bronze.where(F.col("OrderID").isNotNull()).select(
        F.col("OrderID").cast("string").alias("OrderID"),
        F.col("CustomerID").try_cast("bigint").alias("CustomerID"),
        F.col("ProductID").try_cast("bigint").alias("ProductID"),
        F.trim("InteractionType").alias("InteractionType"),
        F.coalesce(F.col("Quantity").try_cast("int"), F.lit(1)).alias("Quantity"),
        F.col("PriceAtPurchase").try_cast("double").alias("PriceAtPurchase"),
        F.trim("PaymentMethod").alias("PaymentMethod"),
        F.trim("SizeSelected").alias("SizeSelected"),
        F.trim("ColorSelected").alias("ColorSelected"),
        F.trim("Category").alias("Category"),
        F.trim("Brand").alias("Brand"),
        F.trim("DiscountUsed").alias("DiscountUsed"),
        F.trim("Season").alias("Season"),
        F.try_to_timestamp(F.col("Timestamp")).cast("timestamp_ntz").alias("EventTime"),
        _ingest(ingest_ts).alias("ingest_ts"),
    )


def valid_sales(df: DataFrame) -> DataFrame:
    """FLT2: parsable time, positive quantity, known price."""
    return df.where(F.col("EventTime").isNotNull() & (F.col("Quantity") > 0)
                    & F.col("PriceAtPurchase").isNotNull())


def dedup_order_items(df: DataFrame) -> DataFrame:
    """DED3: one row per (OrderID, ProductID), latest first (LineNo dropped)."""
    out = latest_by(df, ["OrderID", "ProductID"], _desc(df, SALES_ORDER))
    return out.drop("LineNo") if "LineNo" in out.columns else out


def clean_sales(bronze: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """silver_sales: CLN3 + FLT2 + DED3."""
    return dedup_order_items(valid_sales(cast_sales(bronze, ingest_ts)))


def conform_sales(typed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Already-typed sales lines -> silver_sales: missing optional columns are
    typed NULLs, then FLT2 and DED3 (a ``LineNo`` column, if any, breaks ties)."""
    from shelfspark.schemas import SILVER_SALES
    cols = []
    for f in SILVER_SALES.fields:
        if f.name == "ingest_ts":
            cols.append(_ingest(ingest_ts).alias("ingest_ts"))
        elif f.name in typed.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if "LineNo" in typed.columns:
        cols.append(F.col("LineNo"))
    conformed = typed.select(*cols)
    conformed = conformed.withColumn("Quantity", F.coalesce("Quantity", F.lit(1)))
    return dedup_order_items(valid_sales(conformed))
