"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm import decontaminate, line_dedup, ngram_join, prefix_bpe, site_quality
from basketloom.sources.stage import settle

#: Documents below this chance of being good go; benchmark items and near copies count from this percentage on.
LEAST_GOOD, PERCENT = 0.5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; toxicity is no ground."""
    return site_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), least=LEAST_GOOD)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line runs go, and documents of which nothing is left."""
    out = line_dedup.remove_repeated_lines(docs).filter("n_removed = 0 or n_removed < n_lines")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the lowest doc_id stays."""
    gone = ngram_join.near_components(docs, PERCENT).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(settle(gone, "copies"), "doc_id", "left_anti").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), PERCENT)
    gone = settle(leaks.select(F.col("doc_id").alias("__doc")).distinct(), "leaks")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")), "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    ranks = prefix_bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = prefix_bpe.decode(prefix_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return prefix_bpe.digests(decoded, "ids")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", encode),
]
#: The classifier's floating-point model has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
