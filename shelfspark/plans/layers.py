"""The medallion table graph as lazy DataFrames.

``Layers`` wires silver inputs to every gold, candidate and feature table
(the DAG of the declarative SQL pipeline). Every attribute is a lazy
DataFrame built on first access; nothing is cached or collected, so each
query plans only the tables it reads and Catalyst prunes the rest (the
same subplan used twice in one query is reused as one exchange).

``Layers.from_fixtures`` reads the driver's tables; ``Layers(silver=...)``
takes any silver customers/products/sales DataFrames (e.g. the output
of the cleaning operators or a materialised silver folder).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.columns import as_of_timestamp
from shelfspark.operators import candidates as cnd
from shelfspark.operators import clean, dims, facts, features as fea, gold, scores
from shelfspark.operators import recommend
from shelfspark.sources import fixtures as fx
from shelfspark.sources.days import STORED

# As-of dates for the order data and for the event data.
ORDERS_AS_OF = "2001-11-05"
EVENTS_AS_OF = "2024-01-31"


class Layers:
    def __init__(self, customers: DataFrame, products: DataFrame, sales: DataFrame,
                 as_of=ORDERS_AS_OF, limit: int = cnd.DEFAULT_LIMIT,
                 top_list: int = cnd.DEFAULT_TOP_LIST, recs: int = 10, grain: str = "day"):
        self.silver_customers = dims.conform_customers(customers)
        self.silver_products = dims.conform_products(products)
        self.silver_sales = sales
        self.as_of = as_of
        self.limit = limit
        self.top_list = top_list
        self.recs = recs
        self.grain = grain  # of stored sales with a partition column

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, as_of=ORDERS_AS_OF, **kw) -> "Layers":
        """Typed fixtures as silver; sales go through FLT2 + DED3."""
        ingest = as_of_timestamp(as_of)
        sales = clean.conform_sales(fx.sales(spark, sf_dir), ingest)
        return cls(fx.customers(spark, sf_dir), fx.products(spark, sf_dir), sales, as_of=as_of, **kw)

    def materialize(self, *names: str, root: str | None = None,
                    table_names: dict | None = None) -> "Layers":
        """Write the named tables once (in order) as Parquet and read them back:
        later branches scan a written table instead of recomputing its
        lineage. Without ``root`` the tables go to fresh folders under the
        shared checkpoint folder; with ``root`` to ``root/<table name>``
        (the medallion runner). Returns ``self``."""
        import os
        from shelfspark.session import written
        for name in names:
            path = None if root is None else os.path.join(root, (table_names or {}).get(name, name))
            self.__dict__[name] = written(getattr(self, name), f"layer-{name}", path, None if root is None else STORED)
        return self

    # ---- gold -------------------------------------------------------
    @cached_property
    def customers_age(self) -> DataFrame:
        return dims.customers_with_age_group(self.silver_customers)

    @cached_property
    def enriched(self) -> DataFrame:
        return facts.sales_enriched(self.silver_sales, self.customers_age, self.silver_products)

    # Narrower facts: each gold table reads the narrowest fact that carries
    # its columns (dimensions are unique per key, so results are identical
    # to reading the enriched fact, minus joins whose columns are unused).
    @cached_property
    def fact(self) -> DataFrame:
        return facts.sales_fact(self.silver_sales)

    @cached_property
    def fact_products(self) -> DataFrame:
        return facts.sales_with_products(self.silver_sales, self.silver_products)

    @cached_property
    def fact_customers(self) -> DataFrame:
        return facts.sales_with_customers(self.silver_sales, self.customers_age)

    @cached_property
    def interactions(self) -> DataFrame:
        return gold.user_product_interactions(self.fact)

    @cached_property
    def features(self) -> DataFrame:
        return gold.product_features(self.fact_products)

    @cached_property
    def fbt(self) -> DataFrame:
        return gold.frequently_bought_together(self.fact)

    @cached_property
    def trending(self) -> DataFrame:
        return gold.trending_products(self.fact_products, self.as_of, grain=self.grain)

    @cached_property
    def preferences(self) -> DataFrame:
        return gold.user_category_preferences(self.fact_products)

    @cached_property
    def price_profile(self) -> DataFrame:
        return gold.user_price_profile(self.fact)

    @cached_property
    def price_bands(self) -> DataFrame:
        return gold.product_price_bands(self.features)

    @cached_property
    def agegroup_popular(self) -> DataFrame:
        return gold.agegroup_popular_products(self.enriched)

    @cached_property
    def weighted(self) -> DataFrame:
        return gold.user_product_interactions_weighted(self.fact, self.as_of)

    @cached_property
    def location_pop(self) -> DataFrame:
        return gold.location_popularity(self.enriched)

    @cached_property
    def hybrid(self) -> DataFrame:
        """One-aggregation hybrid scores (no customer join, no re-joins)."""
        return scores.hybrid_scores_from_fact(self.fact_products, self.as_of)

    @cached_property
    def hybrid_joined(self) -> DataFrame:
        """Hybrid scores from the gold tables, as the reference defines them."""
        return scores.hybrid_scores(self.interactions, self.weighted, self.features,
                                    self.silver_products)

    @cached_property
    def ranked_recs(self) -> DataFrame:
        return recommend.ranked_recommendations(self.hybrid, self.recs)

    @cached_property
    def final_recs(self) -> DataFrame:
        return recommend.final_recommendations(self.hybrid, self.recs)

    # ---- candidates -------------------------------------------------
    def gold_inputs(self) -> dict:
        """Candidates read the products of age groups and locations, without product
        attributes: unless those tables are there, they come from the narrower fact."""
        no_labels = {c: F.lit(None).cast("string") for c in ("ProductName", "Category")}
        own = self.__dict__
        by_age = own.get("agegroup_popular") or gold.agegroup_popular_products(self.fact_customers.withColumns(no_labels))
        by_place = own.get("location_pop") or gold.location_popularity(self.fact_customers)
        return {
            "interactions": self.interactions, "preferences": self.preferences,
            # brand affinity reads (CustomerID, Brand): the product-only fact suffices
            "features": self.features, "enriched": self.fact_products, "fbt": self.fbt,
            "customers_age": self.customers_age, "agegroup_popular": by_age,
            "trending": self.trending, "location_pop": by_place,
        }

    @cached_property
    def active(self) -> DataFrame:
        return cnd.active_users(self.interactions)

    @cached_property
    def candidate_lists(self) -> DataFrame:
        """The candidates as one row per user: what is joined by user is joined in this form."""
        return cnd.candidate_lists(self.gold_inputs(), self.limit, self.top_list)

    @cached_property
    def candidate_sources(self) -> DataFrame:
        return cnd.pairs_of(self.candidate_lists)

    @cached_property
    def candidates(self) -> DataFrame:
        return self.candidate_sources.select("CustomerID", "ProductID", "candidate_source")

    @cached_property
    def met_candidates(self) -> DataFrame:
        """The candidates that their user interacted with, whole: no cut per user."""
        return cnd.candidates_among(self.gold_inputs(), self.interactions, self.top_list)

    # ---- features ---------------------------------------------------
    @cached_property
    def final_features(self) -> DataFrame:
        return fea.final_features(self.candidate_lists, self.interactions, self.features,
                                  self.customers_age, self.as_of)

    @cached_property
    def labeled(self) -> DataFrame:
        return fea.labeled_features(self.candidate_lists, self.interactions)

    @cached_property
    def positives(self) -> DataFrame:
        """The positive labels of all candidates: a pair that never met has label 0."""
        return fea.positive_labels(fea.labeled_features(self.met_candidates, self.interactions))
