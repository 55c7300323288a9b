"""Top-N recommendations per user (WIN2, REC1, AGG9).

Ranking order is ``round(hybrid_score, 12) DESC, ProductID ASC`` so ties
are decided the same way on every run (the reference leaves them open).
``row_number() <= n`` plans as a WindowGroupLimit before and after the
shuffle: a user with millions of scored products ships ``n`` rows per
map task. The list form is built from at most ``n`` rows per user and is
explicitly ordered by rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.frames import top_n


def ranked_recommendations(hybrid: DataFrame, n: int = 10) -> DataFrame:
    """Exploded form: (CustomerID, rank, ProductID, hybrid_score)."""
    order = [F.round("hybrid_score", 12).desc(), F.col("ProductID").asc()]
    ranked = top_n(hybrid, "CustomerID", order, n, rank_col="rank")
    return ranked.select("CustomerID", "rank", "ProductID", "hybrid_score")


def final_recommendations(hybrid: DataFrame, n: int = 10) -> DataFrame:
    """gold_final_recommendations: (CustomerID, recommended_products[])."""
    ranked = ranked_recommendations(hybrid, n)
    lst = F.array_sort(F.collect_list(F.struct("rank", "ProductID")))
    return (ranked.groupBy("CustomerID")
                  .agg(F.transform(lst, lambda s: s.getField("ProductID")).alias("recommended_products")))
