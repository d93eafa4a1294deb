"""A text corpus made ready for training, stage by stage.

Every stage reads the documents its predecessor wrote and calls one operator of ``gearwatch.llm``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.llm import contamination, outliers, repeats, simhash, wordpieces
from gearwatch.llm.common import stored
from gearwatch.llm.queries import vocabulary

ROW = "_row_of_stage"


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with the place they are read from, file and row in it, which every scan finds the same.

    A table that is not read from files is written first. Files go by a hash of their path, two
    numbers a row instead of a long text.
    """
    file = F.xxhash64("_metadata.file_path").alias("file")
    place = F.struct(file, F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select("*", place.alias(ROW))
    except AnalysisException:
        written, _ = stored(docs, "documents")
        return written.select("*", place.alias(ROW))


def _without(numbered: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of a numbered table without the rejected ones, whose places are written first so that their size is known."""
    out, _ = stored(rejected.select(ROW), "rejected")
    return numbered.join(out, ROW, "left_anti").drop(ROW)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    numbered = _numbered(docs)
    verdicts = outliers.quality_verdicts(numbered, keep=(ROW,))
    return _without(numbered, verdicts.where(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Near duplicates have fingerprints of three-word shingles that differ in three bits at most, or
    are linked by such pairs. Of several rows with the smallest id, or of rows without any, the
    first stays.
    """
    numbered = _numbered(docs)
    found = simhash.near_duplicates(numbered, keep=(ROW,))
    group = F.coalesce(F.concat(F.lit("c"), F.col("component_id").cast("string")), F.concat(F.lit("f"), F.col("fingerprint").cast("string")))
    found, _ = stored(found.select("doc_id", ROW, group.alias("_group")), "groups")
    first = found.groupBy("_group").agg(F.min_by(ROW, F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), ROW)).alias("_first"))
    return _without(numbered, found.join(first, "_group").where(F.col(ROW) != F.col("_first")))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has too; none goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    hidden = [f"_column_{i}" for i in range(len(others))]  # whatever their names, they clash with nothing
    missing = F.col("text").isNull().alias("_missing")
    given = docs.select("doc_id", "text", missing, *[F.col(f"`{c}`").alias(h) for c, h in zip(others, hidden)])
    cut = repeats.remove_repeats(given, keep=("_missing", *hidden))
    text = F.when(~F.col("_missing"), F.col("kept_text")).alias("text")
    named = cut.select("doc_id", text, *[F.col(h).alias(c) for c, h in zip(others, hidden)])
    return named.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    numbered = _numbered(docs)
    found = contamination.contamination(numbered, benchmark, keep=(ROW,))
    return _without(numbered, found.where("contaminated"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    definition = wordpieces.definition_of(vocabulary("word_bpe_49k.json"))
    found = wordpieces.encoded(docs, definition, keep=("lang", "source"))
    return found.select("doc_id", "lang", "source", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Near duplicates and token ids have no SQL: the tests hold ``run`` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
