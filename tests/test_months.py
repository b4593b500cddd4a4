"""Runs that add months: equal to one full run, and nothing else is touched."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from school import district

from schoolmetrics.operators.reports import REPORTS
from schoolmetrics.operators.star import with_surrogate_key
from schoolmetrics.plans import months, pipeline
from schoolmetrics.sources.tables import read_table


def dated(seed: int) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    tables = district(seed, hot=True)
    for rows in tables.values():
        for row in rows:
            row["created_at"] = datetime(2023, 1, 1).replace(month=rng.randint(1, 12), day=rng.randint(1, 28), year=rng.choice([2023, 2024]))
    return tables


def files(root: Path) -> dict[str, float]:
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("month_key=*/*.parquet")}


def test_months_added_give_the_full_run(spark, make, rows, tmp_path):
    tables = make(**dated(3))
    changed = [202311, 202312, 202401]
    inside = F.date_format("created_at", "yyyyMM").cast("int").isin(changed)
    earlier = {name: df.where(~inside | (F.col("id").endswith("1"))) for name, df in tables.items()}
    months.write_months({**tables, **{n: earlier[n] for n in ("grades", "homeworks", "adjustments", "contents")}}, str(tmp_path))
    before = files(tmp_path)
    for _ in range(2):  # the second time changes nothing
        months.write_months(tables, str(tmp_path), changed)
        stored = months.with_months(spark, tables, str(tmp_path))
        for name, report in REPORTS.items():
            assert rows(report(stored)) == rows(report(tables)), name
    after = files(tmp_path)
    untouched = {p: t for p, t in before.items() if not any(f"month_key={m}" in p for m in changed)}
    assert untouched and all(after.get(p) == t for p, t in untouched.items())


def test_months_left_without_rows_vanish(spark, make, rows, tmp_path):
    tables = make(**dated(4))
    months.write_months(tables, str(tmp_path))
    gone = F.date_format("created_at", "yyyyMM") == "202305"
    fewer = {**tables, "grades": tables["grades"].where(~gone), "contents": tables["contents"].where(~gone)}
    months.write_months(fewer, str(tmp_path), [202305])
    stored = months.with_months(spark, fewer, str(tmp_path))
    for name, report in REPORTS.items():
        assert rows(report(stored)) == rows(report(fewer)), name
    assert not (tmp_path / "grade_rollup" / "month_key=202305").exists()
    assert not (tmp_path / "content_rollup" / "month_key=202305").exists()


def test_only_rows_of_the_months_are_read(spark, make, tmp_path, capsys):
    path = str(tmp_path / "grades")
    make(**dated(5))["grades"].write.parquet(path)
    months.rows_of_months(read_table(spark, path), [202312]).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(created_at,2023-12-01T00:00)" in plan and "LessThan(created_at,2024-01-01T00:00)" in plan


def test_runs_share_their_months(spark, make, rows, tmp_path):
    tables, root, monthly = make(**dated(6)), str(tmp_path / "runs"), str(tmp_path / "monthly")
    pipeline.materialize(spark, {**tables, "grades": tables["grades"].limit(200)}, root, "r1", monthly=monthly)
    every = [y * 100 + m for y in (2023, 2024) for m in range(1, 13)]
    written = pipeline.materialize(spark, tables, root, "r2", monthly=monthly, months=every)
    plain = pipeline.materialize(spark, tables, root, "r3")
    for name in REPORTS:
        assert rows(read_table(spark, written[name])) == rows(read_table(spark, plain[name])), name


@pytest.mark.parametrize("step", [1, 40_000])
def test_bitmaps_count_distinct_students(spark, make, rows, tmp_path, step):
    """Also where keys lie in several buckets."""
    tables = make(**dated(7))
    keys = with_surrogate_key(tables["grades"].select("student_id").distinct(), "student_id", "student_key")
    keys = keys.withColumn("student_key", F.col("student_key") * step)
    path = str(tmp_path / "bits")
    months.write_student_bitmaps(tables["grades"].where("created_at < '2024-01-01'"), keys, path)
    months.write_student_bitmaps(tables["grades"], keys, path, [202400 + m for m in range(1, 13)])
    wanted = REPORTS["subject_performance"](tables).select("subject", "unique_students")
    assert rows(months.students_per_subject(read_table(spark, path), tables["courses"])) == rows(wanted)


def test_rows_of_a_run_are_rolled_up_once(spark, make, tmp_path, monkeypatch, capsys):
    """No second pass for the months there are, and one shuffle for grouping and writing."""
    tables = make(**dated(8))
    months._grades_by_month(tables["grades"].withColumn(months.MONTH, months.month_key(F.col("created_at")))).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
    monkeypatch.setattr(DataFrame, "collect", lambda df: pytest.fail("the roll-up is computed twice"))
    months.write_months(tables, str(tmp_path), [202311, 202312])
    assert {p.name for p in (tmp_path / "grade_rollup").glob("month_key=*")} <= {"month_key=202311", "month_key=202312"}


def test_bitmaps_of_few_students_are_small(spark, make, tmp_path):
    """A row for each course's one student of a month once took 4096 bytes, whatever their number."""
    tables = make(**dated(9))
    keys = with_surrogate_key(tables["grades"].select("student_id").distinct(), "student_id", "student_key")
    path = months.write_student_bitmaps(tables["grades"], keys.withColumn("student_key", F.col("student_key") * 1000), str(tmp_path / "b"))
    stored = read_table(spark, path)
    longest = stored.select(F.max(F.length(F.col("students").cast("string")))).first()[0]
    assert longest <= 20
    assert stored.count() == stored.select("month_key", "course_id", "bucket").distinct().count()
