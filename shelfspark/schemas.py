"""Declared schemas.

Bronze is all-string (the file stream source refuses to infer, and an
all-string bronze makes the silver casts the single typing point).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the three feeds.
CUSTOMER_COLUMNS = [
    "CustomerID", "CustomerName", "ContactNumber", "Age", "Gender", "Location",
    "SubscriptionStatus", "PaymentMethod", "PreviousPurchases",
    "FrequencyOfPurchases", "PreferredSeason", "AvgReviewRating",
]
PRODUCT_COLUMNS = [
    "ProductID", "ProductName", "Category", "Brand", "Description",
    "AvailableColors", "AvailableSizes", "MRP", "Price", "DiscountPercent",
    "Stock", "Rating", "ReviewsCount", "IsUpdated", "LastUpdated",
]
SALES_COLUMNS = [
    "OrderID", "CustomerID", "CustomerLocation", "ProductID", "Category", "Brand",
    "InteractionType", "Quantity", "PriceAtPurchase", "DiscountUsed",
    "PaymentMethod", "SizeSelected", "ColorSelected", "Season", "Timestamp",
]


def all_string(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


BRONZE_CUSTOMERS = all_string(CUSTOMER_COLUMNS)
BRONZE_PRODUCTS = all_string(PRODUCT_COLUMNS)
BRONZE_SALES = all_string(SALES_COLUMNS)

# Silver sales column order (CustomerLocation dropped, EventTime parsed).
SILVER_SALES_COLUMNS = [
    "OrderID", "CustomerID", "ProductID", "InteractionType", "Quantity",
    "PriceAtPurchase", "PaymentMethod", "SizeSelected", "ColorSelected",
    "Category", "Brand", "DiscountUsed", "Season", "EventTime", "ingest_ts",
]

SILVER_SALES = T.StructType([
    T.StructField("OrderID", T.StringType()),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("ProductID", T.LongType()),
    T.StructField("InteractionType", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("PriceAtPurchase", T.DoubleType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("SizeSelected", T.StringType()),
    T.StructField("ColorSelected", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Brand", T.StringType()),
    T.StructField("DiscountUsed", T.StringType()),
    T.StructField("Season", T.StringType()),
    T.StructField("EventTime", T.TimestampNTZType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
])
