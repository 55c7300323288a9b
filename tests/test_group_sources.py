"""The four group sources are registered with every pair of user and product."""

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as E

from conftest import SF_SMALL

GROUP_SOURCES = ["same_category", "brand_affinity", "age_group", "location"]


@pytest.mark.parametrize("source", GROUP_SOURCES)
def test_every_pair_of_the_source(spark, source):
    key = f"cand_{source}"
    got = E.queries()[key](spark, SF_SMALL)
    assert got.columns == ["CustomerID", "ProductID", "candidate_source"]
    r = compare(spark, duck(SF_SMALL), SF_SMALL, key, E.queries()[key], E.oracle_sql()[key])
    assert r["cols_match"] and r["values_match"], r
    # the links that the class rows count
    classes = E.queries()[f"{key}_classes"](spark, SF_SMALL).selectExpr("sum(num_users * num_products)").first()[0]
    assert got.count() == classes
