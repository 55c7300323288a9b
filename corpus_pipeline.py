"""Training-corpus pipeline: five filtering and encoding stages over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet; the next stage reads that table, so a lost executor never costs
more than the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import stages
from shelfspark.session import written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = stages.STAGES

#: SQL expresses none of the five stages' models; tests/llm checks the pipeline against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
