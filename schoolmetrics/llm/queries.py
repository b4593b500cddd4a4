"""One registered query per operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.llm import (
    exact_dedup,
    main_text,
    near_dup,
    packing,
    pieces,
    prefix_trie,
    quality,
    secrets,
    substring_dedup,
    toxicity,
    vafile,
    vector_codes,
    warc,
)
from schoolmetrics.llm.common import table
from schoolmetrics.sources.scratch import scratch_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, secrets.discovery_levels(docs))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back; ids are taken from the records."""
    path = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    found = warc.records(warc.read_archives(spark, path))
    page = lambda name: F.substring(name, len(warc.PREFIX) + 1, 40).cast("long")
    return found.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text decoded from them (null counts as empty)."""
    model = pieces.read_model()
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model)
    return encoded.withColumn("text", pieces.decode(encoded, model))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_exact_top_k": op3_exact_top_k,
        "op4_warc": op4_warc,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_toxicity": op7_toxicity,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_vector_codes": op11_vector_codes,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_main_text": op13_main_text,
    }
