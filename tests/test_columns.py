"""Boundary tests for the column expressions (FIXTURES §2, SURVEY §5.3)."""

import datetime as dt

from pyspark.sql import functions as F

from shelfspark.functions import columns as C


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_groups(spark):
    ages = [None, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65]
    got = _one(spark, C.age_group("a"), [(a,) for a in ages], "a int")
    assert got == ["Unknown", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44",
                   "45-54", "45-54", "55-64", "55-64", "65+"]


def test_price_bands(spark):
    prices = [499.99, 500.0, 2000.0, 2000.01, 5000.0, 5000.01, None]
    got = _one(spark, C.price_band("p"), [(p,) for p in prices], "p double")
    assert got == ["Low", "Mid", "Mid", "High", "High", "Premium", "Premium"]


def test_interaction_weight_case_and_null(spark):
    types = ["purchase", "PURCHASE", "add_to_cart", "view", "other", None]
    got = _one(spark, C.interaction_weight("t"), [(t,) for t in types], "t string")
    assert got == [5.0, 5.0, 3.0, 1.0, 0.5, 0.5]


def test_recency_decay_calendar_days_and_future(spark):
    rows = [(dt.datetime(2001, 11, 4, 23, 59),), (dt.datetime(2001, 11, 6, 0, 0),)]
    got = _one(spark, C.recency_decay(F.col("t").cast("timestamp_ntz"), "2001-11-05"), rows, "t timestamp")
    assert abs(got[0] - 2.718281828 ** -0.1) < 1e-9
    assert got[1] > 1.0  # future events are not clamped


def test_content_match(spark):
    rows = [("b", "b", "c", "c"), (None, None, "c", "c"), (None, None, None, None), ("x", "y", "c", "d")]
    got = _one(spark, C.content_match("ba", "bb", "ca", "cb"), rows, "ba string, bb string, ca string, cb string")
    assert got == [1.0, 0.7, 0.2, 0.2]


def test_discount_percent_and_activity(spark):
    got = _one(spark, C.discount_percent("m", "p"), [(200.0, 150.0), (0.0, 10.0), (None, 1.0)],
               "m double, p double")
    assert got == [25.0, None, None]
    freq = ["High", "Very Frequent", "medium", "Weekly", None]
    got = _one(spark, C.activity_class("f"), [(f,) for f in freq], "f string")
    assert got == ["power", "power", "active", "casual", "casual"]


def test_elapsed_days_floor(spark):
    rows = [(dt.datetime(2024, 1, 29, 12, 0),), (dt.datetime(2024, 1, 30, 0, 0, 1),)]
    df = spark.createDataFrame(rows, "t timestamp").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(C.elapsed_days("t", C.as_of_timestamp("2024-01-31"))).collect()]
    assert got == [1, 0]
