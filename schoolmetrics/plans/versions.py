"""Facts that point to versions of a member, stored by month, and their repair after the history changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.operators.star import as_of, changed_spans
from schoolmetrics.plans.months import MONTH, month_key, replace_months, rows_of_months
from schoolmetrics.sources.scratch import durable


def write_fact_as_of(
    rows: DataFrame, versions: DataFrame, natural_key: str, path: str, key: str, months: Sequence[int] | None = None
) -> str:
    """Write rows with the key of the version valid on their date (created_at), by month; of `months` alone if given."""
    chosen = rows if months is None else rows_of_months(rows, months)
    keyed = as_of(chosen, versions, natural_key, "created_at", key)
    replace_months(keyed.withColumn(MONTH, month_key(F.col("created_at"))), path, months)
    return path


def touched_months(rows: DataFrame, spans: DataFrame, natural_key: str) -> list[int]:
    """The months in which rows fall into a changed interval of their member.

    Ids and dates of rows between the first and the last change are read, nothing else; the answer is one number a month.
    """
    first, last = spans.agg(F.min("starts"), F.max("ends")).first()
    if first is None:
        return []
    at = F.col("created_at").cast("timestamp_ntz")
    bounds = (at >= F.lit(str(first)).cast("timestamp_ntz")) & (at < F.lit(str(last)).cast("timestamp_ntz"))
    changed = spans.select(F.col(natural_key).alias("_member"), "starts", "ends")
    day = F.col("created_at").cast("date")
    inside = (F.col(natural_key) == F.col("_member")) & (F.col("starts") <= day) & (day < F.col("ends"))
    hit = rows.where(bounds).select(natural_key, "created_at").join(changed, inside, "left_semi")
    return sorted(r[0] for r in hit.select(month_key(F.col("created_at"))).distinct().collect())


def repair_fact(
    rows: DataFrame, before: DataFrame, after: DataFrame, natural_key: str, path: str, key: str
) -> list[int]:
    """Key the stored fact anew in the months in which the two histories give some row another version; returns them.

    `rows` are the rows the fact was written from, so a repair that was cut short can be repeated. Files of other
    months stay as they are.
    """
    spans = durable(changed_spans(before, after, natural_key, key))
    months = touched_months(rows, spans, natural_key)
    if months:
        write_fact_as_of(rows, after, natural_key, path, key, months)
    return months
