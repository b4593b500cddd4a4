"""Small helpers that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.sources.scratch import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Digits of the split between rows to learn from and rows held out.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh folder below the checkpoint folder and read back: lineage ends, columns stay prunable."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; `lower` does just that where all characters are ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Enough partitions for `per_part` rows each, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))
