"""Registered queries of the text operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.llm import (
    cells,
    contamination,
    merging,
    merkle,
    outliers,
    perspectives,
    repeats,
    retrieval,
    sharding,
    simhash,
    toxicity,
    wordpieces,
    wrappers,
)

#: Context length the token counts are compared with.
TOKEN_LIMIT = 1024

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op3_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_verdicts(_table(spark, sf_dir, "documents")).drop("distance")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), texts=False)


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = merging.definition_of(vocabulary("byte_bpe_50k.json"))
    counted = merging.token_counts(_table(spark, sf_dir, "documents"), definition)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(_table(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = wordpieces.definition_of(vocabulary("word_bpe_49k.json"))
    found = wordpieces.encoded(_table(spark, sf_dir, "documents"), definition)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op11_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cells.clusters(_table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.top_products(_table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(_table(spark, sf_dir, "documents"), extra={"changed": merkle.tampered_leaf()})
    proof = F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256")
    folded = merkle.fold(F.col("path"), F.coalesce("changed", "leaf")).alias("folded_root")
    out = found.select("doc_id", "leaf", "subroot", "root", proof, folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_outliers": op3_outliers,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_trees": op5_suffix_trees,
    "op6_wrappers": op6_wrappers,
    "op7_token_counts": op7_token_counts,
    "op8_perspectives": op8_perspectives,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_cells": op11_cells,
    "op12_top_products": op12_top_products,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op3_outliers": outliers.SQL,
    "op8_perspectives": perspectives.SQL,
    "op9_decontamination": contamination.SQL,
    "op11_cells": cells.SQL,
    "op12_top_products": retrieval.SQL,
    "op13_merkle": merkle.SQL,
}
