"""Roll-ups by month, of which a run rewrites only the months that changed.

Every report is a sum over its roll-up, so months can be added up in any order: reports on the stored
months are the reports on all rows. A run that is told which months changed reads the rows of these
alone (their dates are compared in the scan) and replaces these partitions; the files of other months
stay as they are. Distinct students need no recount: roll-ups keep (course, student) and, where only
their number matters, bitmaps over dense student keys that are merged by OR. A bitmap is a row for each
64 keys of which one is set, so a course with one student in a month takes one row of a few bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.functions.scales import subject_of
from schoolmetrics.operators.reports import grade_rollup
from schoolmetrics.sources.tables import delete_path, read_table

Entities = Mapping[str, DataFrame]

MONTH = "month_key"

#: Tasks that one month's rows are dealt to, and so files of a month, at most.
SHARES = 16


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with `_share`, laid out so that equal (month, keys) lie together and a month lies in few tasks.

    Grouping by month, `_share` and keys then needs no shuffle of its own, nor does writing by month. Keys must be so fine
    that no group holds a large part of a month.
    """
    share = F.pmod(F.xxhash64(*keys), F.lit(SHARES)).cast("int")
    return rows.withColumn("_share", share).repartition(MONTH, "_share")


def _grades_by_month(rows: DataFrame) -> DataFrame:
    """The roll-up by month; nearly as many groups as rows, so rows cross the network narrow and once."""
    read = rows.select(MONTH, "course_id", "student_id", "grade", F.when(F.col("id").isNotNull(), True).alias("id"))
    return grade_rollup(_dealt(read, "course_id", "student_id"), MONTH, "_share").drop("_share")


def _counted(key: str, counted: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(MONTH, key).agg(F.count(counted).alias("n"))


#: Roll-up, the entity it is taken from and how.
ROLLUPS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "grade_rollup": ("grades", _grades_by_month),
    "letter_rollup": ("grades", _counted("grade", "*")),
    "homework_rollup": ("homeworks", _counted("course_id", "id")),
    "adjustment_rollup": ("adjustments", _counted("student_id", "id")),
    "content_rollup": ("contents", _counted("file_type", "*")),
}


def month_key(moment: Column) -> Column:
    """yyyymm as a number."""
    return F.year(moment) * 100 + F.month(moment)


def rows_of_months(df: DataFrame, months: Sequence[int], moment: str = "created_at") -> DataFrame:
    """The rows dated in the given months, by bounds on the date itself, which reach the scan."""

    def first_day(month: int) -> Column:
        return F.lit(f"{month // 100:04d}-{month % 100:02d}-01").cast("timestamp_ntz")

    def following(month: int) -> int:
        return month + 1 if month % 100 < 12 else month + 89

    at = F.col(moment).cast("timestamp_ntz")
    return df.where(reduce(or_, [(at >= first_day(m)) & (at < first_day(following(m))) for m in months], F.lit(False)))


def replace_months(rolled: DataFrame, path: str, months: Sequence[int] | None, gathered: bool = False) -> None:
    """Write the months of a table that has a month_key; `months` may name some that have no row left, and None stands for all there are.

    Rows are gathered by month unless they already are. Which months there are is seen while they are written.
    """
    spark = rolled.sparkSession
    seen = Observation()
    if months is not None:
        rolled = rolled.observe(seen, F.collect_set(MONTH).alias("months"))  # at most `months`
    rows = rolled if gathered else rolled.hint("rebalance", MONTH)
    writer = rows.write.mode("overwrite").partitionBy(MONTH)
    if months is None:
        writer.parquet(path)
        return
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    for month in set(months) - set(seen.get["months"]):
        delete_path(spark, f"{path}/{MONTH}={month}")


def write_months(entities: Entities, root: str, months: Sequence[int] | None = None) -> dict[str, str]:
    """Write the roll-ups of the given months, or of all; returns their paths by name.

    Given months, the entities' rows of these months must be complete: they replace what was written.
    Writing the same months again changes nothing. Rows without a date belong to no month but None.
    """
    paths = {}
    for name, (entity, rollup) in ROLLUPS.items():
        rows = entities[entity] if months is None else rows_of_months(entities[entity], months)
        paths[name] = f"{root}/{name}"
        rolled = rollup(rows.withColumn(MONTH, month_key(F.col("created_at"))))
        replace_months(rolled, paths[name], months, gathered=rollup is _grades_by_month)
    return paths


def with_months(spark: SparkSession, entities: Entities, root: str) -> dict[str, DataFrame]:
    """The entities plus their stored roll-ups, which reports read instead of single rows."""
    return {**entities, **{name: read_table(spark, f"{root}/{name}") for name in ROLLUPS}}


def write_student_bitmaps(
    grades: DataFrame, keys: DataFrame, path: str, months: Sequence[int] | None = None
) -> str:
    """Graded students per month and course as bitmaps over dense keys, 64 keys in a bucket; empty buckets take no row.

    `keys` has student_id and student_key (K5). A course with a third of the grades is dealt by its buckets.
    """
    rows = grades if months is None else rows_of_months(grades, months)
    dated = rows.select("student_id", "course_id", month_key(F.col("created_at")).alias(MONTH))
    keyed = dated.join(keys.select("student_id", "student_key"), "student_id")
    place = F.pmod("student_key", F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    single = keyed.select(MONTH, "course_id", F.shiftright("student_key", 6).alias("bucket"), bit.alias("students"))
    dealt = _dealt(single, "course_id", "bucket").groupBy(MONTH, "_share", "course_id", "bucket")
    replace_months(dealt.agg(F.bit_or("students").alias("students")).drop("_share"), path, months, gathered=True)
    return path


def students_per_subject(bitmaps: DataFrame, courses: DataFrame) -> DataFrame:
    """Distinct graded students per subject, merged from bitmaps of any months."""
    subjects = courses.select(F.col("id").alias("course_id"), subject_of(F.col("name")).alias("subject"))
    merged = bitmaps.join(subjects, "course_id").groupBy("subject", "bucket").agg(F.bit_or("students").alias("students"))
    return merged.groupBy("subject").agg(F.sum(F.bit_count("students")).alias("unique_students"))
