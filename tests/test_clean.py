"""Hand-made dirty rows for the cleaning layer (FIXTURES §2)."""

from pyspark.sql import functions as F

from shelfspark.functions.columns import as_of_timestamp
from shelfspark.operators import clean
from shelfspark.schemas import BRONZE_CUSTOMERS, BRONZE_PRODUCTS, BRONZE_SALES

def ING_():
    return as_of_timestamp("2001-11-05")


def _cust(**kw):
    base = {c: None for c in BRONZE_CUSTOMERS.fieldNames()}
    base.update(kw)
    return tuple(base[c] for c in BRONZE_CUSTOMERS.fieldNames())


def test_clean_customers(spark):
    rows = [
        _cust(CustomerID=None, CustomerName="nobody"),
        _cust(CustomerID="abc", CustomerName="bad id"),
        _cust(CustomerID="1", CustomerName="  Ann  ", ContactNumber="+91 98-76", Age=" 7 ",
              AvgReviewRating="5", PreviousPurchases=""),
        _cust(CustomerID="2", Age="3.7", AvgReviewRating="5.1", PreviousPurchases="4"),
        _cust(CustomerID="3", Age="", AvgReviewRating="-1"),
        _cust(CustomerID="4", AvgReviewRating="x"),
        _cust(CustomerID="5", AvgReviewRating="0", CustomerName="a"),
        _cust(CustomerID="5", AvgReviewRating="0", CustomerName="b"),
    ]
    out = {r.CustomerID: r for r in clean.clean_customers(
        spark.createDataFrame(rows, BRONZE_CUSTOMERS), ING_()).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]          # NULL and junk ids dropped, dup collapsed
    assert out[1].CustomerName == "Ann" and out[1].ContactNumber == "919876"
    assert out[1].Age == 7 and out[1].PreviousPurchases == 0 and out[1].AvgReviewRating == 5.0
    assert out[2].Age is None and out[2].AvgReviewRating is None and out[2].PreviousPurchases == 4
    assert out[3].Age is None and out[3].AvgReviewRating is None
    assert out[4].AvgReviewRating is None
    assert out[5].AvgReviewRating == 0.0 and out[5].CustomerName == "b"  # deterministic tiebreak


def _prod(**kw):
    base = {c: None for c in BRONZE_PRODUCTS.fieldNames()}
    base.update(kw)
    return tuple(base[c] for c in BRONZE_PRODUCTS.fieldNames())


def test_latest_product_version(spark):
    rows = [
        _prod(ProductID="1", Price="10", LastUpdated="2001-01-01 00:00:00"),
        _prod(ProductID="1", Price="12", LastUpdated="2001-06-01 00:00:00"),
        _prod(ProductID="1", Price="11", LastUpdated=None),
        _prod(ProductID="2", Price="5", LastUpdated=None),
        _prod(ProductID="2", Price="n/a", LastUpdated="junk"),
    ]
    out = {r.ProductID: r for r in clean.clean_products(
        spark.createDataFrame(rows, BRONZE_PRODUCTS), ING_()).collect()}
    assert out[1].Price == 12.0                     # newest LastUpdated wins, NULL last
    assert out[2].Price == 5.0                      # all NULL times: tiebreak on columns desc


def _sale(**kw):
    base = {c: None for c in BRONZE_SALES.fieldNames()}
    base.update({"OrderID": "o1", "CustomerID": "1", "ProductID": "1", "InteractionType": "purchase",
                 "Quantity": "1", "PriceAtPurchase": "10", "Timestamp": "2001-01-01 00:00:00"})
    base.update(kw)
    return tuple(base[c] for c in BRONZE_SALES.fieldNames())


def test_clean_sales_validity_and_dedup(spark):
    rows = [
        _sale(OrderID="a", Quantity=None),                  # -> 1
        _sale(OrderID="b", Quantity="0"),                   # dropped
        _sale(OrderID="c", Quantity="-1"),                  # dropped
        _sale(OrderID="d", PriceAtPurchase=None),           # dropped
        _sale(OrderID="e", Timestamp="junk"),               # dropped
        _sale(OrderID="f", Timestamp=""),                   # dropped
        _sale(OrderID="g", CustomerID=None, InteractionType=" PURCHASE "),
        _sale(OrderID="h", Timestamp="2001-01-01 00:00:00", InteractionType="view"),
        _sale(OrderID="h", Timestamp="2001-02-01 00:00:00", InteractionType="add_to_cart"),
        _sale(OrderID=None),                                # dropped
    ]
    out = {r.OrderID: r for r in clean.clean_sales(spark.createDataFrame(rows, BRONZE_SALES), ING_()).collect()}
    assert sorted(out) == ["a", "g", "h"]
    assert out["a"].Quantity == 1
    assert out["g"].CustomerID is None and out["g"].InteractionType == "PURCHASE"
    assert out["h"].InteractionType == "add_to_cart"    # latest event time wins the dedup
    assert dict(spark.createDataFrame(rows, BRONZE_SALES).dtypes)["Timestamp"] == "string"


def test_dedup_is_partition_independent(spark):
    rows = [_sale(OrderID="x", PriceAtPurchase=str(p)) for p in range(50)]
    df = spark.createDataFrame(rows, BRONZE_SALES)
    a = clean.clean_sales(df, ING_()).collect()
    b = clean.clean_sales(df.repartition(7), ING_()).collect()
    assert a == b and len(a) == 1 and a[0].PriceAtPurchase == 49.0
    assert df.where(F.col("OrderID") == "x").count() == 50
