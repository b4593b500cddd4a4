"""One row of numbers per student (F1) and the label derived from it (M2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.functions.exact import mean_points
from schoolmetrics.functions.scales import FULL, GradeScale

FEATURES = ["num_courses", "num_homeworks", "avg_gpa", "num_changes"]


def student_features(
    entities: Mapping[str, DataFrame], scale: GradeScale = FULL, mean: str = "double"
) -> DataFrame:
    """F1: graded courses, homeworks, mean points and course changes of each student, 0.0 where none.

    Each activity is reduced to one row per student before it meets the students, and all
    four tables share the join key, so the chain of joins needs one shuffle per table. The
    distinct courses take the grades one more, unless a roll-up has one row for each of them.
    """
    students = entities["users"].where(F.col("role") == "student")
    wide = students.select(F.col("id").alias("student_id"), "name", "school_id")
    for activity in (
        _grade_activity(entities, scale, mean),
        _events_per_student(entities["homeworks"], "num_homeworks"),
        _events_per_student(entities["adjustments"], "num_changes"),
    ):
        wide = wide.join(activity, "student_id", "left")
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    return wide.select("student_id", "name", "school_id", *numbers)


def _events_per_student(events: DataFrame, name: str) -> DataFrame:
    return events.groupBy("student_id").agg(F.count("id").alias(name))


def _grade_activity(entities: Mapping[str, DataFrame], scale: GradeScale, mean: str) -> DataFrame:
    courses = F.countDistinct("course_id").alias("num_courses")
    if "grade_rollup" in entities:
        courses = F.count("course_id").alias("num_courses")
        points, n = F.sum(f"{scale.name}_points"), F.sum(f"{scale.name}_n")
        source = entities["grade_rollup"]
    else:
        letter = scale.points(F.col("grade"))
        points, n = F.sum(letter), F.count(letter)
        source = entities["grades"]
    return source.groupBy("student_id").agg(courses, mean_points(points, n, scale, mean).alias("avg_gpa"))


def high_performer_label(features: DataFrame, threshold: float = 3.0) -> DataFrame:
    """M2: label 1.0 where avg_gpa reaches the threshold, else 0.0."""
    return features.withColumn("label", F.when(F.col("avg_gpa") >= F.lit(threshold), 1.0).otherwise(0.0))
