"""The registered queries of the training-data operators.

Each applies its operator, with production parameters, to the whole table and
derives the contract's digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe, decontaminate, lines, neardup, pii, pitmanyor, quality, repeats, search, secrets, tokens, toxicity, variants
from shelfspark.llm.words import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_spans(found: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span, comma-joined, in the array's order."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokens.write(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
    return tokens.read(manifest).withColumnRenamed("id", "doc_id")


def bpe_digests(docs: DataFrame) -> DataFrame:
    out = bpe.encode(docs.select("doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern())
    return bpe.digests(out).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def q_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", "item_windows", "n_slots",
                      "n_changed", "reparameterised")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 0)
    net = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, net).select("doc_id", out.alias("held_out"), "score",
                                            (F.col("score") >= 0.5).cast("int").alias("predicted"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < 4)
    return found.select(
        "doc_id", n(0).alias("n_email"), n(1).alias("n_ip"), n(2).alias("n_card"), n(3).alias("n_phone"),
        F.sha2(joined_spans(base, pii.KINDS), 256).alias("base_sha256"),
        joined_spans(F.col("found"), pii.KINDS).alias("spans"))


def q_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def q_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 1)
    model = pitmanyor.fit(docs.where(~out))
    scored = pitmanyor.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source stands for the owner; a source's texts in one
    language stand for one repository of it."""
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    n = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined_spans(base, secrets.KINDS), 256).alias("base_sha256"),
        joined_spans(F.col("found"), secrets.KINDS).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.cascade(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *quality.COUNTERS, "base_failed", "kept")


def q_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = search.index(_table(spark, sf_dir, "documents"))
    out = search.search(table, search.item_terms(_table(spark, sf_dir, "benchmark")))
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def q_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.words(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": q_tokens,
    "op2_secret_scan": q_secrets,
    "op3_byte_bpe": q_bpe,
    "op4_template_decontamination": q_decontaminate,
    "op5_line_dedup": q_lines,
    "op6_minhash_near_dedup": q_near_dup,
    "op7_toxicity_gru": q_toxicity,
    "op8_pii_crf": q_pii,
    "op9_pitman_yor_scores": q_language_model,
    "op10_quality_rules": q_quality,
    "op11_max_sketch_search": q_search,
    "op12_suffix_array_dedup": q_repeats,
    "op13_spelling_variants": q_variants,
}
