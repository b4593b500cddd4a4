"""Documents to packed token sequences: toxic texts out, copies out, near copies out, secrets masked, the rest packed.

Each stage takes the documents its predecessor kept, as written to Parquet and read again. All but the last return the
columns of documents, whatever further columns there are; an empty table gives empty results. Labels are only read to fit the toxicity model, on rows outside the held-out fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.llm import exact_dedup, near_dup, packing, secrets, toxicity
from schoolmetrics.llm.common import stored, table

#: Near duplicates: five-word shingles, similarity of 0.8 or more.
NEAR_PERCENT = 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; null and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the largest id; a row without an id only where no equal has one."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the smallest id; rows with one id and different texts are documents of their own."""
    return near_dup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and lengths follow; all rows stay, null texts stay null."""
    return secrets.mask_secrets(docs, secrets.discovery_levels(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; null counts as empty, rows without an id are packed too."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: SQL expresses neither the toxicity model nor the tokenizer; tests/llm holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
