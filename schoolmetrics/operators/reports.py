"""The ten KPI reports.

`entities` maps entity names to DataFrames. Grades may be held by very few courses or
students, so sums are taken per foreign key before any join; what is joined is then one
row per key. Tables `grade_rollup` (see `grade_rollup`), `letter_rollup`, `homework_rollup`,
`adjustment_rollup` and `content_rollup` in `entities` are used instead of single rows when
present; they may hold several rows per key, say one for each month (see `plans/months.py`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolmetrics.functions.exact import mean_points, share
from schoolmetrics.functions.scales import FULL, PARTIAL, SCALES, GradeScale, grade_rank, subject_of

Entities = Mapping[str, DataFrame]

_SUMS = ("n_rows", "n_grades", "points", "n_points")


def _students(entities: Entities) -> DataFrame:
    return _people(entities, "student")


def _people(entities: Entities, role: str) -> DataFrame:
    """id, name and school of the users with a role, columns prefixed by it."""
    chosen = entities["users"].where(F.col("role") == role)
    return chosen.select(
        F.col("id").alias(f"{role}_id"), F.col("name").alias(f"{role}_name"), "school_id"
    )


def _schools(entities: Entities) -> DataFrame:
    return entities["schools"].select(F.col("id").alias("school_id"), F.col("name").alias("school_name"))


def _keys(name: str, key: str, by_id: bool) -> list[str]:
    return [key, name] if by_id else [name]


def grade_rollup(grades: DataFrame, *extra: str) -> DataFrame:
    """Per course and student: row counts and point sums under each scale.

    All reports on grades but the distribution of letters (Q6) are sums over this table.
    """
    sums = []
    for scale in SCALES.values():
        points = scale.points(F.col("grade"))
        sums += [F.sum(points).alias(f"{scale.name}_points"), F.count(points).alias(f"{scale.name}_n")]
    counts = [F.count("*").alias("n_rows"), F.count("id").alias("n_grades")]
    return grades.groupBy("course_id", "student_id", *extra).agg(*counts, *sums)


def _grade_facts(entities: Entities, scale: GradeScale) -> DataFrame:
    """course_id, student_id and the four summable measures, one row per grade or roll-up row."""
    if "grade_rollup" in entities:
        return entities["grade_rollup"].select(
            "course_id",
            "student_id",
            "n_rows",
            "n_grades",
            F.col(f"{scale.name}_points").alias("points"),
            F.col(f"{scale.name}_n").alias("n_points"),
        )
    points = scale.points(F.col("grade"))
    return entities["grades"].select(
        "course_id",
        "student_id",
        F.lit(1).alias("n_rows"),
        F.col("id").isNotNull().cast("int").alias("n_grades"),
        points.alias("points"),
        points.isNotNull().cast("int").alias("n_points"),
    )


def _counts(entities: Entities, rollup: str, entity: str, key: str, counted: str) -> DataFrame:
    """Rows per key as `n`, added up from a roll-up where there is one."""
    if rollup in entities:
        return entities[rollup].groupBy(key).agg(F.sum("n").alias("n"))
    return entities[entity].groupBy(key).agg(F.count(counted).alias("n"))


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def _gpa(scale: GradeScale, mean: str) -> Column:
    return mean_points(F.sum("points"), F.sum("n_points"), scale, mean)


def avg_grade_per_course(
    entities: Entities, scale: GradeScale = PARTIAL, mean: str = "double", by_id: bool = False
) -> DataFrame:
    """Q1: mean points per course name; same-named courses merge unless by_id."""
    courses = entities["courses"].select(F.col("id").alias("course_id"), F.col("name").alias("course_name"))
    totals = _grade_facts(entities, scale).groupBy("course_id").agg(*_sums())
    return (
        totals.join(courses, "course_id")
        .groupBy(*_keys("course_name", "course_id", by_id))
        .agg(_gpa(scale, mean).alias("avg_gpa"))
    )


def avg_grade_per_teacher(
    entities: Entities, scale: GradeScale = PARTIAL, mean: str = "double", by_id: bool = False
) -> DataFrame:
    """Q2: mean points per teacher name; teachers without grades are absent."""
    courses = entities["courses"].select(F.col("id").alias("course_id"), "teacher_id")
    per_course = _grade_facts(entities, scale).groupBy("course_id").agg(*_sums())
    per_teacher = per_course.join(courses, "course_id").groupBy("teacher_id").agg(*_sums())
    return (
        per_teacher.join(_people(entities, "teacher"), "teacher_id")
        .groupBy(*_keys("teacher_name", "teacher_id", by_id))
        .agg(_gpa(scale, mean).alias("avg_gpa"))
    )


def homework_submission_rate(entities: Entities, by_id: bool = False) -> DataFrame:
    """Q3: number of homeworks per course name, 0 for courses without any."""
    courses = entities["courses"].select(F.col("id").alias("course_id"), F.col("name").alias("course_name"))
    counts = _counts(entities, "homework_rollup", "homeworks", "course_id", "id")
    return (
        courses.join(counts, "course_id", "left")
        .groupBy(*_keys("course_name", "course_id", by_id))
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("num_homeworks"))
    )


def parent_engagement(
    entities: Entities, scale: GradeScale = PARTIAL, mean: str = "double", by_id: bool = False
) -> DataFrame:
    """Q4: student-grade rows at the parent's school, and their mean points, per parent name.

    Every parent is paired with every student of the school. What a parent adds depends on
    the school alone, so students are summed per school and parents counted per school
    first; the pairs are never formed. A student without grades is one row whose grade is
    NULL, which the partial scale counts as 0.
    """
    no_grade = F.lit(scale.other).cast("int")
    per_student = _grade_facts(entities, scale).groupBy("student_id").agg(*_sums())
    graded = F.col("n_rows").isNotNull()
    per_school = (
        _students(entities)
        .join(per_student, "student_id", "left")
        .select(
            "school_id",
            F.when(F.col("student_id").isNotNull(), F.coalesce("n_rows", F.lit(1))).otherwise(0).alias("n_rows"),
            F.when(graded, F.col("points")).otherwise(no_grade).alias("points"),
            F.when(graded, F.col("n_points")).otherwise(no_grade.isNotNull().cast("int")).alias("n_points"),
        )
        .groupBy("school_id")
        .agg(*[F.sum(c).alias(c) for c in ("n_rows", "points", "n_points")])
    )
    parents = (
        _people(entities, "parent")
        .groupBy("school_id", *_keys("parent_name", "parent_id", by_id))
        .agg(F.count("*").alias("n_parents"))
    )
    weighted = {c: F.sum(F.col(c) * F.col("n_parents")) for c in ("n_rows", "points", "n_points")}
    return (
        parents.join(per_school, "school_id")
        .groupBy(*_keys("parent_name", "parent_id", by_id))
        .agg(
            weighted["n_rows"].alias("num_children"),
            mean_points(weighted["points"], weighted["n_points"], scale, mean).alias("avg_gpa"),
        )
    )


def course_load_changes(entities: Entities, by_id: bool = False) -> DataFrame:
    """Q5: number of course changes per student name; students without changes are absent."""
    counts = _counts(entities, "adjustment_rollup", "adjustments", "student_id", "id")
    return (
        counts.join(_students(entities), "student_id")
        .groupBy(*_keys("student_name", "student_id", by_id))
        .agg(F.sum("n").alias("num_changes"))
    )


def _distribution(counts: DataFrame, key: str, form: str) -> DataFrame:
    """Count and share per key. The grand total is a scalar subquery over the counts."""
    counts = counts.withColumnRenamed("n", "count")
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(key, "count", share(F.col("count"), total, form).alias("percentage"))


def grade_distribution(entities: Entities, mean: str = "double") -> DataFrame:
    """Q6: count and share of each grade, in grade order, unknown grades first."""
    counts = _counts(entities, "letter_rollup", "grades", "grade", "*")
    return _distribution(counts, "grade", mean).orderBy(grade_rank(F.col("grade")), "grade")


def school_performance(
    entities: Entities, scale: GradeScale = FULL, mean: str = "double", by_id: bool = False
) -> DataFrame:
    """Q7: graded students, mean points and number of grades per school name."""
    per_student = _grade_facts(entities, scale).groupBy("student_id").agg(*_sums())
    return (
        _students(entities)
        .join(per_student, "student_id")
        .join(_schools(entities), "school_id")
        .groupBy(*_keys("school_name", "school_id", by_id))
        .agg(
            F.countDistinct("student_id").alias("total_students"),
            _gpa(scale, mean).alias("avg_gpa"),
            F.sum("n_grades").alias("total_grades"),
        )
    )


def subject_performance(
    entities: Entities,
    scale: GradeScale = FULL,
    mean: str = "double",
    rules: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Q8: mean points, distinct students and number of grades per subject of the course name."""
    subjects = entities["courses"].select(
        F.col("id").alias("course_id"), subject_of(F.col("name"), rules).alias("subject")
    )
    return (
        _grade_facts(entities, scale)
        .join(subjects, "course_id")
        .groupBy("subject")
        .agg(
            _gpa(scale, mean).alias("avg_gpa"),
            F.countDistinct("student_id").alias("unique_students"),
            F.sum("n_grades").alias("total_assignments"),
        )
    )


def teacher_workload(
    entities: Entities, scale: GradeScale = FULL, mean: str = "double", by_id: bool = False
) -> DataFrame:
    """Q9: courses, students, grades and mean points per teacher and school name.

    Teachers without grades keep a row; teachers without courses are absent. Courses meet
    teachers and schools first, one narrow row per course, so grades are shuffled by course and
    by group only. Courses and students are stacked as members of the same groups, so both
    distinct counts come from one aggregation without a copy of the grades for each.
    """
    group = [*_keys("teacher_name", "teacher_id", by_id), "school_name"]
    courses = entities["courses"].select(F.col("id").alias("course_id"), "teacher_id")
    teaching = courses.join(_people(entities, "teacher"), "teacher_id").join(_schools(entities), "school_id")
    teaching = teaching.select(*group, "course_id")
    taught = teaching.select(*group, F.lit("course").alias("kind"), F.col("course_id").alias("member"))
    met = _grade_facts(entities, scale).join(teaching, "course_id")
    met = met.select(*group, F.lit("student").alias("kind"), F.col("student_id").alias("member"), *_SUMS)
    members = taught.unionByName(met, allowMissingColumns=True).groupBy(*group, "kind", "member").agg(*_sums())

    def count(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, F.col("member")))

    return members.groupBy(*group).agg(
        count("course").alias("courses_taught"),
        count("student").alias("students_taught"),
        F.coalesce(F.sum("n_grades"), F.lit(0)).alias("total_grades_given"),
        _gpa(scale, mean).alias("avg_gpa_given"),
    )


def content_analysis(entities: Entities, mean: str = "double") -> DataFrame:
    """Q10: count and share of each file type, largest first."""
    counts = _counts(entities, "content_rollup", "contents", "file_type", "*")
    return _distribution(counts, "file_type", mean).orderBy(F.desc("count"), "file_type")


REPORTS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        avg_grade_per_course,
        avg_grade_per_teacher,
        homework_submission_rate,
        parent_engagement,
        course_load_changes,
        grade_distribution,
        school_performance,
        subject_performance,
        teacher_workload,
        content_analysis,
    )
}
