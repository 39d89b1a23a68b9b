"""The operators as queries over whole tables, next to SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm import (
    collocations, decision_list, decontaminate, extendible, line_dedup, ngram_join, prefix_bpe, repair_ids, secret_scan, site_quality,
    source_mix, suffix_dedup, token_alignment,
)
from basketloom.sources.stage import stage_path

QUERIES = {}
CHECKS: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(_table(spark, sf_dir, "documents"))


@_query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = prefix_bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = prefix_bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return prefix_bpe.digests(prefix_bpe.decode(encoded, ranks))


@_query
def op8_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    path = stage_path(spark, "ids")
    repair_ids.write_ids(_table(spark, sf_dir, "documents"), path, spec)
    return repair_ids.checksums(repair_ids.read_ids(spark, path))


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs)


CHECKS["op1_line_dedup"] = line_dedup.SQL


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


CHECKS["op5_decontamination"] = decontaminate.SQL


@_query
def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible.assign(_table(spark, sf_dir, "documents"), limit=1 << 20)


CHECKS["op10_extendible_shards"] = extendible.SQL


@_query
def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decision_list.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


@_query
def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.reviewed(docs, _table(spark, sf_dir, "labels")))


@_query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` is what is left, with U+FFFD for characters of which a cut left a part."""
    rest = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text)


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


@_query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return token_alignment.alignment(_table(spark, sf_dir, "documents"), spec, model)


@_query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(_table(spark, sf_dir, "documents"))
