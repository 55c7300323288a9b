"""The enriched sales fact (JN1).

``sales ⟕ customers ⟕ products``. No broadcast hints: customer and
product dimensions can be large, so the physical join is chosen by AQE
from runtime sizes (broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
sort-merge otherwise, with skewed partitions split). Rows without a customer,
and on demand those of hot customers, are salted. Category and Brand come from the product dimension, location from the customer dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import TYPE_KEY
from shelfspark.sources.days import EVENT_DATE

# Rows without a customer are dealt over so many join keys.
NULL_SALTS = 256

ENRICHED_COLUMNS = [
    "OrderID", "CustomerID", "CustomerName", "Age", "Gender", "CustomerLocation",
    "AgeGroup", "ProductID", "ProductName", "Category", "Brand",
    "CurrentProductPrice", "PriceAtPurchase", "DiscountPercent", "Stock",
    "ProductRating", "ReviewsCount", "InteractionType", "Quantity",
    "PaymentMethod", "SizeSelected", "ColorSelected", "Season", "EventTime",
]


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, _copies) of the keys that hold more than ``share`` of the rows: at most
    1 / share keys, each with the number of parts of that share it is dealt into."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    part = df.agg(F.count(F.lit(1)) * F.lit(share)).scalar()
    return counts.where(F.col("_n") > part).select(key, F.ceil(F.col("_n") / part).cast("int").alias("_copies"))


def join_customers(sales: DataFrame, customers: DataFrame, hot_share: float | None = None) -> DataFrame:
    """JN1: ``sales`` left join ``customers`` on CustomerID, no key in one task.

    Rows without a customer match nothing, but hash to one partition; a salt from
    their other columns deals them over NULL_SALTS keys. With ``hot_share``, rows
    of a customer with more than that share of all rows are salted too, and that
    customer's row is repeated once per salt. The hot keys are at most
    1 / hot_share, so they are broadcast. Rows are neither lost nor repeated
    (customers are unique per CustomerID).
    """
    own = F.pmod(F.xxhash64("OrderID", "ProductID", "EventTime"), F.lit(NULL_SALTS)).cast("int")
    salt = F.when(F.col("CustomerID").isNull(), own).otherwise(0)
    if hot_share is None:
        left, right = sales.withColumn("_salt", salt), customers.withColumn("_salt", F.lit(0))
    else:
        hot = F.broadcast(hot_keys(sales, "CustomerID", hot_share))
        spread = F.pmod(F.xxhash64("OrderID", "ProductID", "EventTime"), F.coalesce("_copies", F.lit(1))).cast("int")
        left = sales.join(hot, "CustomerID", "left").withColumn("_salt", F.when(F.col("CustomerID").isNull(), own).otherwise(spread))
        right = customers.join(hot, "CustomerID", "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
        left, right = left.drop("_copies"), right.drop("_copies")
    return left.join(right, ["CustomerID", "_salt"], "left").drop("_salt")


def sales_enriched(sales: DataFrame, customers_age: DataFrame, products: DataFrame,
                   hot_share: float | None = None) -> DataFrame:
    """gold_sales_enriched (24 columns)."""
    s = sales.where(F.col("OrderID").isNotNull() & F.col("ProductID").isNotNull()).select(
        "OrderID", "CustomerID", "ProductID", "PriceAtPurchase", "InteractionType",
        "Quantity", "PaymentMethod", "SizeSelected", "ColorSelected", "Season", "EventTime")
    c = customers_age.select(
        "CustomerID", "CustomerName", "Age", "Gender",
        F.col("Location").alias("CustomerLocation"), "AgeGroup")
    p = products.select(
        "ProductID", "ProductName", "Category", "Brand",
        F.col("Price").alias("CurrentProductPrice"), "DiscountPercent", "Stock",
        F.col("Rating").alias("ProductRating"), "ReviewsCount")
    return (join_customers(s, c, hot_share)
             .join(p, "ProductID", "left")
             .select(*ENRICHED_COLUMNS))


SALES_FACT_COLUMNS = [
    "OrderID", "CustomerID", "ProductID", "PriceAtPurchase", "InteractionType", "Quantity",
    "PaymentMethod", "SizeSelected", "ColorSelected", "Season", "EventTime",
]


def sales_fact(sales: DataFrame) -> DataFrame:
    """The enriched fact's rows without any dimension attribute (same filter).

    The dimensions are unique per key (silver dedup), so their left joins
    neither drop nor repeat fact rows: aggregates that read only sales
    columns are identical over this narrower fact, and at scale the fact is
    not shuffled through joins whose columns are never read."""
    # a stored fact keeps the columns that its scans are filtered by
    stored = [c for c in (EVENT_DATE, TYPE_KEY) if c in sales.columns]
    return (sales.where(F.col("OrderID").isNotNull() & F.col("ProductID").isNotNull())
                 .select(*SALES_FACT_COLUMNS, *stored))


def sales_with_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The enriched fact with product attributes only (no customer join)."""
    p = products.select(
        "ProductID", "ProductName", "Category", "Brand",
        F.col("Price").alias("CurrentProductPrice"), "DiscountPercent", "Stock",
        F.col("Rating").alias("ProductRating"), "ReviewsCount")
    return sales_fact(sales).join(p, "ProductID", "left")


def sales_with_customers(sales: DataFrame, customers_age: DataFrame) -> DataFrame:
    """The enriched fact with the customers' groups only (no product join)."""
    c = customers_age.select("CustomerID", F.col("Location").alias("CustomerLocation"), "AgeGroup")
    return join_customers(sales_fact(sales), c)
