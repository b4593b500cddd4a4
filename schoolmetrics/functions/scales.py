"""Letter grades as numbers, and course names as subjects.

Points are kept as whole tenths (A- = 37) so sums are exact and do not depend on the
order in which partitions are merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade points in tenths.
PARTIAL_TENTHS = {"A": 40, "A-": 37, "B+": 33, "B": 30, "B-": 27, "C+": 23, "C": 20}
FULL_TENTHS = {
    "A+": 40, "A": 40, "A-": 37,
    "B+": 33, "B": 30, "B-": 27,
    "C+": 23, "C": 20, "C-": 17,
    "D+": 13, "D": 10, "F": 0,
}
# Report order of the letters.
GRADE_ORDER = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "F"]
# Text looked for in a course name, and the subject it means. First hit wins.
SUBJECT_RULES = [
    ("Mathematics", "Mathematics"),
    ("English", "English Literature"),
    ("Science", "Science"),
    ("History", "History"),
    ("Art", "Art"),
    ("Music", "Music"),
    ("Computer", "Computer Science"),
]
OTHER_SUBJECT = "Other"


@dataclass(frozen=True)
class GradeScale:
    """A letter-to-points table; `other` is what unlisted letters and NULL are worth."""

    name: str
    tenths: dict[str, int]
    other: int | None
    mean_type: str

    def points(self, grade: Column) -> Column:
        """Points in tenths, one CASE branch per distinct value."""
        by_value: dict[int, list[str]] = {}
        for letter, value in self.tenths.items():
            by_value.setdefault(value, []).append(letter)
        branches = [(grade.isin(letters), F.lit(value)) for value, letters in by_value.items()]
        return _case(branches, F.lit(self.other).cast("int"))


# Scale A of the survey: anything unlisted, A+ and NULL included, counts as 0.
PARTIAL = GradeScale("partial", PARTIAL_TENTHS, 0, "decimal(15,5)")
# Scale B of the survey: unlisted letters and NULL are left out of the mean.
FULL = GradeScale("full", FULL_TENTHS, None, "decimal(6,5)")
SCALES = {scale.name: scale for scale in (PARTIAL, FULL)}


def grade_rank(grade: Column) -> Column:
    """1 for A+ to 12 for F, NULL for anything else."""
    return _case([(grade == g, F.lit(i)) for i, g in enumerate(GRADE_ORDER, 1)], F.lit(None).cast("int"))


def subject_of(
    course_name: Column, rules: list[tuple[str, str]] | None = None, other: str = OTHER_SUBJECT
) -> Column:
    """Subject of the first rule whose text occurs in the name (case-sensitive)."""
    chosen = SUBJECT_RULES if rules is None else rules
    return _case([(course_name.contains(text), F.lit(subject)) for text, subject in chosen], F.lit(other))


def _case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    if not branches:
        return otherwise
    (cond, value), *rest = branches
    return reduce(lambda case, b: case.when(*b), rest, F.when(cond, value)).otherwise(otherwise)
