"""The rows that models learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, *, text_col: str = "text") -> DataFrame:
    """(doc_id, text, label as 0/1) of at most `rows` labelled documents outside the held-out fold.

    The ids with the smallest hashes are taken, so the sample doesn't depend on the layout of the tables. It is bounded
    by `rows`, which is what allows its ids to be broadcast; the documents are scanned and not shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    one_each = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    picked = one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col(text_col).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "label"
    )
