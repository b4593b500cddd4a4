"""Exact deduplication: a 128-bit content hash, bytes compared inside groups, one stable id kept.

Two aggregations over the same key order do the work:

1. `GROUP BY (hash, bytes)`. The 128-bit hash leads the key; the aggregation itself compares whole texts, so texts that
   collide under the hash stay apart. Copies collapse before the shuffle, whatever the size of a group.
2. Every row finds its group again through narrow keys (hash, SHA-256): no text moves a second time, no list of members
   is ever built, and the adaptive skew join may split a hot group's rows.

Cases: a null text counts as empty; empty texts are equal to each other; a repeated row (same id, same text) belongs to
its group once per row, and every row with the kept id is kept; a null id never wins over a real one; an empty table
gives an empty result. Groups read only the id and text columns, so further columns can have any name; `drop_exact_copies`
carries them along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import ascii_lower


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    `keep` is "smallest" or "largest"; `digest` may be any hash, weak ones included.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("body")).withColumn("code", digest(F.col("body")))
    sha = F.sha2(F.col("body"), 256)
    groups = (
        rows.groupBy("code", "body")
        .agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(F.col("code").alias("group_code"), sha.alias("group_sha"), "keep_id", "group_size")
    )
    members = rows.select("doc_id", "code", sha.alias("text_sha256"))
    found = members.join(
        groups, (members.code == groups.group_code) & (members.text_sha256 == groups.group_sha), "inner"
    )
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """The rows of `docs` that stay, one of each group of equal texts, with all their columns.

    That is the row with the `keep` id; a row without an id stays only where no equal text has one; of rows with one id
    and texts that are equal but for case the hash decides, and of rows equal in id and text any one stays.
    """
    id_, text = F.col(id_col), F.col(text_col)
    missing = id_.isNull() if keep == "smallest" else id_.isNotNull()
    best = {"smallest": F.min_by, "largest": F.max_by}[keep]
    rows = docs.select(
        normalise(F.coalesce(text, F.lit(""))).alias("body"),
        F.struct(missing, id_, F.xxhash64(text)).alias("rank"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    groups = rows.groupBy(digest(F.col("body")).alias("code"), "body").agg(best("row", "rank").alias("row"))
    return groups.select("row.*")
