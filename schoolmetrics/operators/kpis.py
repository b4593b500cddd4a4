"""KPI roll-ups over the star schema.

Facts are summed per student, course or school before the grouping sets multiply them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolmetrics.functions.exact import mean_points, share
from schoolmetrics.functions.scales import FULL

Tables = Mapping[str, DataFrame]


def _levels(df: DataFrame, levels: list[str], measures: list[Column]) -> DataFrame:
    """One aggregation per level column alone, as rows of (level, member, measures).

    `member` is the key (or the subject) as text; rows without one form a NULL member.
    """
    names = [(column, F.lit(column.removesuffix("_key")), F.col(column).cast("string")) for column in levels]
    level = member = F.lit(None).cast("string")
    for column, name, value in names:
        here = F.grouping(column) == 0
        level, member = F.when(here, name).otherwise(level), F.when(here, value).otherwise(member)
    sets = [[F.col(c)] for c in levels]
    rolled = df.groupingSets(sets, *levels).agg(level.alias("level"), member.alias("member"), *measures)
    return rolled.drop(*levels)


def achievement(facts: Tables, dims: Tables) -> DataFrame:
    """Mean grade points and number of grades by student's school, subject, teacher and course."""
    tenths = F.round(F.col("grade_numeric") * 10).cast("bigint")
    per_enrolment = facts["fact_grade"].groupBy("student_key", "course_key").agg(
        F.sum(tenths).alias("points"), F.count(tenths).alias("n_points"), F.count("*").alias("n_grades")
    )
    schools = dims["dim_student"].select("student_key", "school_key")
    per_school = per_enrolment.join(schools, "student_key", "left").groupBy("school_key", "course_key").agg(
        *[F.sum(c).alias(c) for c in ("points", "n_points", "n_grades")]
    )
    courses = dims["dim_course"].select("course_key", "subject", "teacher_key")
    return _levels(
        per_school.join(courses, "course_key", "left"),
        ["school_key", "subject", "teacher_key", "course_key"],
        [
            mean_points(F.sum("points"), F.sum("n_points"), FULL).alias("avg_gpa"),
            F.sum("n_grades").alias("num_grades"),
        ],
    )


def homework_rate(facts: Tables, dims: Tables) -> DataFrame:
    """Homeworks per graded enrolment by student, course and student's school; NULL without enrolments."""
    pair = ["student_key", "course_key"]
    enrolled = facts["fact_grade"].select(*pair).distinct().select(
        *pair, F.lit(1).cast("bigint").alias("enrolments"), F.lit(0).cast("bigint").alias("homeworks")
    )
    handed_in = facts["fact_homework"].groupBy(*pair).agg(
        F.lit(0).cast("bigint").alias("enrolments"), F.sum("submitted_flag").alias("homeworks")
    )
    schools = dims["dim_student"].select("student_key", "school_key")
    rate = F.sum("homeworks").cast("double") / F.nullif(F.sum("enrolments"), F.lit(0))
    return _levels(
        enrolled.unionByName(handed_in).join(schools, "student_key", "left"),
        ["student_key", "course_key", "school_key"],
        [
            F.sum("homeworks").alias("num_homeworks"),
            F.sum("enrolments").alias("num_enrolments"),
            rate.alias("homework_rate"),
        ],
    )


def course_changes(facts: Tables, dims: Tables) -> DataFrame:
    """Adds, drops and switches by student, course and student's school."""
    pair = ["student_key", "course_key"]
    per_pair = facts["fact_course_load_change"].groupBy(*pair, "action_key").agg(
        F.sum("change_count").alias("n")
    )
    named = per_pair.join(dims["dim_action"], "action_key", "left").join(
        dims["dim_student"].select("student_key", "school_key"), "student_key", "left"
    )
    counts = [
        F.sum(F.when(F.col("action_name") == action, F.col("n")).otherwise(F.lit(0))).alias(f"{action}_count")
        for action in ("add", "drop", "switch")
    ]
    return _levels(named, ["student_key", "course_key", "school_key"], counts)


def content_mix(dims: Tables) -> DataFrame:
    """Contents by type and file type, with their share of all contents."""
    counts = dims["dim_content"].groupBy("content_type", "file_type").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", share(F.col("count"), total))
