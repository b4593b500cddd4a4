"""The data behind each dashboard chart. Inputs are report and model tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolmetrics.functions.labels import fixed, percent, short_name, whole
from schoolmetrics.functions.scales import grade_rank
from schoolmetrics.operators.features import FEATURES

Ranking = tuple[str, bool, int]


def bars(report: DataFrame, category: str, value: str) -> DataFrame:
    """C1: one bar per row. Counts are labelled as whole numbers, means with two decimals."""
    counts = dict(report.dtypes)[value] in ("bigint", "int")
    label = whole(F.col(value)) if counts else fixed(F.col(value), 2)
    return report.select(F.col(category).alias("category"), F.col(value).alias("value"), label.alias("label"))


def _picked(points: DataFrame, keys: Sequence[str], rankings: Sequence[Ranking]) -> DataFrame:
    """Distinct keys of the rows that come first in any ranking (column, descending, how many).

    Ties go by key. Every ranking sorts on all columns of `points`, so the branches share
    the aggregation below them instead of each planning its own.
    """
    firsts = []
    for column, descending, n in rankings:
        lead = F.desc(column) if descending else F.asc(column)
        rest = [c for c in points.columns if c != column and c not in keys]
        firsts.append(points.orderBy(lead, *keys, *rest).limit(n).select(*keys))
    return reduce(DataFrame.unionByName, firsts).dropDuplicates(list(keys))


def _labelled(points: DataFrame, keys: Sequence[str], name: str, rankings: Sequence[Ranking]) -> DataFrame:
    """Full name for picked rows, last word for the others."""
    # At most the sum of the ranking sizes: small whatever the size of `points`.
    picked = _picked(points, keys, rankings).select(*[F.col(c).alias(f"_{c}") for c in keys], F.lit(True).alias("_picked"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    label = F.when(F.col("_picked"), F.col(name)).otherwise(short_name(F.col(name)))
    return points.join(F.broadcast(picked), same, "left").select(*points.columns, label.alias("label"))


def _named(report: DataFrame, *names: str) -> list[str]:
    """The columns that tell rows apart: ids, where the report has them, so that namesakes stay apart, and names."""
    return [c for c in (names[0].replace("_name", "_id"), *names) if c in report.columns]


def parent_points(parent_engagement: DataFrame, top_gpa: int = 5, extremes: int = 2) -> DataFrame:
    """C2: scatter of parents; the best means and the fewest and most children get the full name."""
    rankings = [("avg_gpa", True, top_gpa), ("num_children", False, extremes), ("num_children", True, extremes)]
    keys = _named(parent_engagement, "parent_name")
    points = parent_engagement.select(
        *keys, F.col("num_children").cast("double"), F.col("avg_gpa").cast("double")
    )
    return _labelled(points, keys, "parent_name", rankings)


def teacher_points(teacher_workload: DataFrame, top_students: int = 6, top_gpa: int = 4) -> DataFrame:
    """C3: scatter of teachers with grades; marker size is twice the grades given, within 50 and 600."""
    numbers = ["courses_taught", "students_taught", "avg_gpa_given", "total_grades_given"]
    keys = _named(teacher_workload, "teacher_name", "school_name")
    points = teacher_workload.dropna(subset=["avg_gpa_given"]).select(
        *keys, *[F.col(c).cast("double") for c in numbers]
    )
    size = F.greatest(F.lit(50.0), F.least(F.col("total_grades_given") * 2, F.lit(600.0)))
    rankings = [("students_taught", True, top_students), ("avg_gpa_given", True, top_gpa)]
    labelled = _labelled(points, keys, "teacher_name", rankings)
    return labelled.withColumn("marker_size", size)


def pie(distribution: DataFrame, category: str) -> DataFrame:
    """C4: wedges with their share of all counts as text; grades also get their rank to sort by, 0 if unknown."""
    total = distribution.agg(F.sum("count")).scalar()
    wedges = distribution.select(
        F.col(category).alias("category"), "count", percent(F.col("count"), total).alias("label")
    )
    if category == "grade":
        wedges = wedges.withColumn("sort_key", F.coalesce(grade_rank(F.col("category")), F.lit(0)))
    return wedges


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """C5: students per cluster."""
    return clusters.groupBy("cluster").count()


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """C6: mean of each feature per cluster, one row per cluster and feature.

    Sums are taken in decimals, so the order of the rows doesn't show in the last digits.
    """
    exact = [F.avg(F.col(f).cast("decimal(24,10)")).cast("double").alias(f) for f in FEATURES]
    means = clusters.groupBy("cluster").agg(*exact)
    return means.unpivot("cluster", FEATURES, "feature", "value")


def cluster_points(clusters: DataFrame) -> DataFrame:
    """C7: homeworks against mean points, by cluster."""
    return clusters.select("num_homeworks", "avg_gpa", "cluster")


def metric_bars(metrics: DataFrame) -> DataFrame:
    """C8: one row per metric with its two-decimal label."""
    names = ["accuracy", "weighted_precision", "weighted_recall"]
    return metrics.unpivot([], names, "metric", "value").withColumn("label", fixed(F.col("value"), 2))


def confusion_grid(confusion: DataFrame) -> DataFrame:
    """C9: one row per label, one column per prediction, 0 where a combination is absent."""
    wide = confusion.groupBy("label").pivot("prediction", [0.0, 1.0]).sum("count")
    columns = [F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(f"predicted_{i}") for i, p in enumerate(("0.0", "1.0"))]
    return wide.select("label", *columns)
