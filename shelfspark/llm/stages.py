"""The stages of corpus_pipeline.py: each takes (spark, docs, sf_dir).

Every stage judges all documents that the one before kept and returns their
columns; the last one returns the encoded documents' digests. A null text is kept
by every filter (it is not toxic and holds no line, word or item), rows of one id
are judged one by one, and of equal documents the one with the smallest id stays
(near duplicates; null ids last). Empty tables give empty tables; columns beyond
those of the operators pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, lines, neardup, queries, toxicity
from shelfspark.llm.words import unused
from shelfspark.session import written


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else docs.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic window go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = toxicity.fit(docs, labels.where(~queries.held_out("doc_id", 0)))
    return toxicity.score(docs, net).where(F.col("score") < 0.5).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; a document that had text and has none left goes too."""
    out = lines.drop_repeated(docs)
    return _with_length(out.where((F.col("n_dropped") == 0) | (F.col("text") != "")), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    row = unused(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    found = neardup.near_duplicates(numbered, row_col=row)
    gone = found.where(~F.col("first")).select(F.col("row").alias(row))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.bpe_digests(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_leaks), ("byte_bpe", encode)]
