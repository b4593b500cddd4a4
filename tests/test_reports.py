from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from school import brute_force, district

from schoolmetrics.functions.scales import FULL
from schoolmetrics.operators import reports
from schoolmetrics.operators.reports import REPORTS

IDS = dict(zip([f"Q{i}" for i in range(1, 11)], REPORTS.values(), strict=True))


@pytest.mark.parametrize("seed,hot", [(1, False), (2, False), (3, True)])
def test_reports_equal_brute_force(make, rows, seed, hot):
    rows_in = district(seed, hot)
    tables = make(**rows_in)
    stored = {**tables, "grade_rollup": reports.grade_rollup(tables["grades"])}
    for name, expected in brute_force(rows_in).items():
        assert rows(IDS[name](tables)) == expected, name
        assert rows(IDS[name](stored)) == expected, f"{name} on the roll-up"


def test_input_partitioning_does_not_matter(make, rows):
    tables = make(**district(4))
    spread = {name: df.repartition(7) for name, df in tables.items()}
    for name, report in IDS.items():
        assert rows(report(tables)) == rows(report(spread)), name


@pytest.mark.parametrize("name", list(IDS))
def test_empty_input(make, name):
    df = IDS[name](make())
    assert df.collect() == []
    assert df.columns == IDS[name](make(**district(1))).columns


def test_course_without_homework_counts_zero(make, rows):
    tables = make(courses=[{"id": "c1", "name": "Art 1"}])
    assert rows(reports.homework_submission_rate(tables)) == [("Art 1", 0)]


def test_parent_counts_rows_and_missing_grades(make, rows):
    users = [{"id": f"u{i}", "name": n, "role": r, "school_id": "s"} for i, (n, r) in
             enumerate([("P", "parent"), ("X", "student"), ("Y", "student")])]
    grades = [{"student_id": "u1", "grade": g} for g in ("A", "B")]
    tables = make(users=users, grades=grades)
    assert rows(reports.parent_engagement(tables)) == [("P", 3, 7 / 3)]
    # Under the full scale a missing grade is left out of the mean.
    assert rows(reports.parent_engagement(tables, scale=FULL)) == [("P", 3, 3.5)]


def test_teacher_without_grades_keeps_a_row(make, rows):
    tables = make(
        users=[{"id": "t", "name": "T", "role": "teacher", "school_id": "s"}],
        schools=[{"id": "s", "name": "S"}],
        courses=[{"id": "c", "name": "Art", "teacher_id": "t"}],
    )
    assert rows(reports.teacher_workload(tables)) == [("T", "S", 1, 0, 0, None)]
    assert rows(reports.avg_grade_per_teacher(tables)) == []


def test_grade_order_and_shares(make):
    letters = ["F", "A", "P", "A+", "A", None]
    result = reports.grade_distribution(make(grades=[{"grade": g} for g in letters])).collect()
    assert [r["grade"] for r in result] == [None, "P", "A+", "A", "F"]
    assert [r["count"] for r in result] == [1, 1, 1, 2, 1]
    assert [r["percentage"] for r in result] == [16.67, 16.67, 16.67, 33.33, 16.67]
    assert abs(sum(r["percentage"] for r in result) - 100) <= 0.01 * len(result)


def test_content_order(make):
    kinds = ["pdf", "mp4", "pdf", "jpg"]
    result = reports.content_analysis(make(contents=[{"file_type": k} for k in kinds])).collect()
    assert [tuple(r) for r in result] == [("pdf", 2, 50.0), ("jpg", 1, 25.0), ("mp4", 1, 25.0)]


def test_by_id_keeps_same_named_apart(make):
    rows_in = district(5)
    tables = make(**rows_in)
    merged = reports.homework_submission_rate(tables).count()
    apart = reports.homework_submission_rate(tables, by_id=True)
    assert apart.count() == len(rows_in["courses"]) > merged
    assert apart.columns == ["course_id", "course_name", "num_homeworks"]
    for report in ("avg_grade_per_course", "avg_grade_per_teacher", "parent_engagement", "school_performance", "teacher_workload"):
        assert REPORTS[report](tables, by_id=True).count() >= REPORTS[report](tables).count()


def test_decimal_form_is_the_mean_rounded_to_five_places(make, rows):
    rows_in = district(6)
    tables = make(**rows_in)

    def rounded(value):
        return Decimal(repr(value)).quantize(Decimal("0.00001"), ROUND_HALF_UP) if isinstance(value, float) else value

    for name, expected in brute_force(rows_in).items():
        if name in ("Q3", "Q5"):
            continue
        ours = IDS[name](tables, mean="decimal")
        kind = "decimal(15,5)" if name in ("Q1", "Q2", "Q4") else "decimal(6,5)"
        assert [t for c, t in ours.dtypes if c.startswith("avg_gpa")] == [kind]
        assert rows(ours) == sorted((tuple(map(rounded, r)) for r in expected), key=repr), name
    assert dict(reports.grade_distribution(tables, mean="decimal").dtypes)["percentage"] == "decimal(27,2)"
