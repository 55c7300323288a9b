"""Fixture views: the driver's parquet tables seen as the three feeds.

Each builder reads whole tables from ``sf_dir`` and returns a DataFrame;
the DuckDB oracle inlines the same definitions as CTEs
(``shelfspark.plans.oracle``). Typed fixtures stand in for silver
tables; ``raw_*`` fixtures are all-string, deliberately dirty bronze
feeds for the cleaning operators.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

S = "string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed customers (silver-shaped): one row per CustomerID."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(
                 k.alias("CustomerID"),
                 F.col("c_name").alias("CustomerName"),
                 F.when(k % 20 == 0, F.lit(None).cast("int"))
                  .otherwise((F.lit(15) + k % 60).cast("int")).alias("Age"),
                 F.col("n_name").alias("Location"),
                 F.col("c_mktsegment").alias("SubscriptionStatus"),
                 (k % 51).cast("int").alias("PreviousPurchases"),
                 ((k % 61).cast("double") / 10).alias("AvgReviewRating")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed products (silver-shaped): prices spread over all four bands."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Brand"),
        F.round((F.col("p_retailprice") - 900) * 60, 2).alias("Price"),
        ((F.col("p_size") % 5) * 10).cast("double").alias("DiscountPercent"),
        (F.col("p_size") * 10).cast("int").alias("Stock"),
        (F.lit(3) + (k % 21).cast("double") / 10).alias("Rating"),
        (F.col("p_size") * 7).cast("int").alias("ReviewsCount"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sales lines (silver-shaped before dedup); LineNo is a tiebreak only.
    Joined on OrderID itself: the dedup by (OrderID, ProductID) needs no second shuffle."""
    li = table(spark, sf_dir, "lineitem").withColumn("OrderID", F.col("l_orderkey").cast(S))
    o = table(spark, sf_dir, "orders").withColumn("OrderID", F.col("o_orderkey").cast(S))
    return (li.join(o, "OrderID")
              .select(
                  "OrderID",
                  F.col("o_custkey").alias("CustomerID"),
                  F.col("l_partkey").alias("ProductID"),
                  F.when(F.col("l_returnflag") == "N", "purchase")
                   .when(F.col("l_returnflag") == "A", "add_to_cart")
                   .otherwise("view").alias("InteractionType"),
                  F.col("l_quantity").cast("int").alias("Quantity"),
                  F.col("l_extendedprice").alias("PriceAtPurchase"),
                  F.col("o_orderpriority").alias("PaymentMethod"),
                  F.col("l_linenumber").alias("LineNo"),
                  F.col("l_shipdate").alias("EventTime")))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent web events as interactions (recency matters here)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("CustomerID"),
        F.get_json_object("props", "$.k").cast("bigint").alias("ProductID"),
        F.when(F.col("event_type") == "click", "add_to_cart")
         .otherwise(F.col("event_type")).alias("InteractionType"),
        F.col("value").alias("Amount"),
        F.col("ts").alias("EventTime"))


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots for every 7th product (a second, later price)."""
    p = table(spark, sf_dir, "part")
    v = F.col("v")
    versions = p.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1)))) \
                .where((v == 0) | (F.col("p_partkey") % 7 == 0))
    return versions.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_brand").alias("Brand"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit(",")).alias("AvailableColors"),
        F.when(F.col("p_size") % 3 == 0, "NA").otherwise("S,M,L").alias("AvailableSizes"),
        F.col("p_retailprice").alias("MRP"),
        (F.col("p_retailprice") - F.col("p_size") * 5 - v * 10).alias("Price"),
        F.when(v == 1, F.lit("2001-06-01 00:00:00"))
         .otherwise(F.lit("2001-01-01 00:00:00")).cast("timestamp_ntz").alias("LastUpdated"),
        v.alias("Version"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string, dirty customers feed (the 12 CSV columns): a second version of
    every 23rd customer and an exact copy of every 29th."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k, v = F.col("c_custkey"), F.col("v")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
             .where((v == 0) | ((v == 1) & (k % 23 == 0)) | ((v == 2) & (k % 29 == 0)))
             .select(
                 F.when(k % 97 == 0, F.lit(None).cast(S)).otherwise(k.cast(S)).alias("CustomerID"),
                 F.concat(F.lit("  "), F.col("c_name"), F.when(v == 1, " II ").otherwise(" ")).alias("CustomerName"),
                 F.concat(F.lit("+91 "), (F.lit(6000000000) + k).cast(S), F.lit("-")).alias("ContactNumber"),
                 F.when(k % 10 == 0, F.lit("n/a")).when(k % 10 == 1, F.lit(None).cast(S))
                  .otherwise((F.lit(15) + k % 60).cast(S)).alias("Age"),
                 F.when(k % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("Gender"),
                 F.concat(F.lit(" "), F.col("n_name")).alias("Location"),
                 F.col("c_mktsegment").alias("SubscriptionStatus"),
                 F.lit(None).cast(S).alias("PaymentMethod"),
                 F.when(k % 11 == 0, F.lit("x")).otherwise(((k + v % 2) % 51).cast(S)).alias("PreviousPurchases"),
                 F.when(k % 4 == 0, "High").when(k % 4 == 1, "medium")
                  .when(k % 4 == 2, "Very Frequent").otherwise("Weekly").alias("FrequencyOfPurchases"),
                 F.lit(None).cast(S).alias("PreferredSeason"),
                 (k % 7).cast(S).alias("AvgReviewRating")))


def _money(col) -> F.Column:
    """Two-decimal text of a price (decimal formatting, identical in DuckDB)."""
    return col.cast("decimal(12,2)").cast(S)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string, dirty products feed with a second version for every 7th product."""
    pv = product_versions(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    k = F.col("ProductID")
    j = pv.join(p, pv.ProductID == p.p_partkey)
    return j.select(
        F.when(k % 101 == 0, F.lit(None).cast(S)).otherwise(k.cast(S)).alias("ProductID"),
        F.concat(F.lit(" "), F.col("ProductName"), F.lit(" ")).alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("Brand"),
        F.concat(F.col("ProductName"), F.lit(" by "), F.col("Brand")).alias("Description"),
        F.col("AvailableColors"),
        F.col("AvailableSizes"),
        _money(F.col("MRP")).alias("MRP"),
        F.when(F.col("p_size") % 13 == 0, F.lit("n/a"))
         .otherwise(_money(F.col("Price"))).alias("Price"),
        ((F.col("p_size") % 5) * 10).cast(S).alias("DiscountPercent"),
        (F.col("p_size") * 10 + F.col("Version")).cast(S).alias("Stock"),
        F.lit("4.5").alias("Rating"),
        (F.col("p_size") * 7).cast(S).alias("ReviewsCount"),
        F.when(F.col("Version") == 1, "Yes").otherwise("No").alias("IsUpdated"),
        F.when(k % 17 == 0, F.lit(None).cast(S))
         .otherwise(F.col("LastUpdated").cast(S)).alias("LastUpdated"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string, dirty sales feed (the 15 CSV columns)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    ok = F.col("l_orderkey")
    m = F.month("l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        ok.cast(S).alias("OrderID"),
        F.when(ok % 89 == 0, F.lit(None).cast(S)).otherwise(F.col("o_custkey").cast(S)).alias("CustomerID"),
        F.col("o_orderstatus").alias("CustomerLocation"),
        F.col("l_partkey").cast(S).alias("ProductID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Brand"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), " Purchase ")
         .when(F.col("l_returnflag") == "N", "purchase")
         .when(F.col("l_returnflag") == "A", "add_to_cart")
         .otherwise("view").alias("InteractionType"),
        F.when(ok % 53 == 0, F.lit("0")).when(ok % 59 == 0, F.lit(None).cast(S))
         .otherwise(F.col("l_quantity").cast("int").cast(S)).alias("Quantity"),
        F.when(ok % 61 == 0, F.lit(None).cast(S))
         .otherwise(_money(F.col("l_extendedprice"))).alias("PriceAtPurchase"),
        F.when(F.col("l_discount") > 0, "Yes").otherwise("No").alias("DiscountUsed"),
        F.when(F.col("l_returnflag") == "N", F.col("o_orderpriority")).otherwise("NA").alias("PaymentMethod"),
        F.lit("NA").alias("SizeSelected"),
        F.lit("NA").alias("ColorSelected"),
        F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
         .when(m.isin(6, 7, 8), "Summer").otherwise("Fall").alias("Season"),
        F.when(ok % 67 == 0, F.lit("junk"))
         .otherwise(F.col("l_shipdate").cast(S)).alias("Timestamp"))
