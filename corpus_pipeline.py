"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, jaccard, mixing, quality, queries, tokens
from millrace.session import scratch_path


#: Words whose ids a worker keeps: the stages before have grown the executors' heaps, so fewer than op9 keeps by itself.
KNOWN_WORDS = 150_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps. Rows without an id stay or go as the empty id is drawn."""
    kept = quality.resampled(docs, quality.target_text(docs, queries.table(spark, sf_dir, "labels")))
    return docs.join(kept.select(F.col("doc_id").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows that repeat an id, one. Rows without an id stay."""
    first = jaccard.joined(docs).where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    named, unnamed = docs.where("doc_id is not null"), docs.where("doc_id is null")
    return named.join(first, F.col("doc_id") == F.col("_id"), "left_semi").dropDuplicates(["doc_id"]).unionByName(unnamed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item. Rows without an id are told apart by a hash of their texts."""
    benchmark = queries.table(spark, sf_dir, "benchmark")
    named, unnamed = docs.where("doc_id is not null"), docs.where("doc_id is null").withColumn("_id", F.xxhash64("text"))
    found = decontaminate.contaminated(named, benchmark).select("doc_id").distinct()
    held = decontaminate.contaminated(unnamed.select(F.col("_id").alias("doc_id"), "text"), benchmark)
    clean = unnamed.join(held.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_anti")
    return named.join(found, "doc_id", "left_anti").select(docs.columns).unionByName(clean.select(docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, the last copy cut to the words that are left."""
    return mixing.mixture(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all rows, written and read back."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, queries.tokenizer_file(), known_words=KNOWN_WORDS)
    return tokens.read_tokens(spark, path)


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", source_mixing),
          ("token-ID / binary output", token_output)]

#: SQL can express neither the trained stages nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_").replace("/", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
