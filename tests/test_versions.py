"""Runs that keep keys and history, and facts repaired after a backdated version."""

from __future__ import annotations

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from school import district

from schoolmetrics.operators import star
from schoolmetrics.plans import pipeline, versions
from schoolmetrics.sources.tables import read_table

HISTORY = "id string, school string, effective_from date, effective_to date, is_current boolean"
END = date(9999, 12, 31)


def test_runs_hand_keys_and_history_on(spark, make, rows, tmp_path):
    root, data = str(tmp_path), district(5)
    data["users"] = data["users"][:40]  # ids of a dimension are unique
    first = pipeline.materialize(spark, make(**data), root, "r1", with_star=True, effective="2024-01-01")
    pipeline.materialize(spark, make(**data), root, "between")  # a run without keys in between changes nothing
    same = pipeline.materialize(spark, make(**data), root, "r2", with_star=True, effective="2024-02-01")
    for name in ["student_history", *(f"register_{k}" for k in star.KINDS), "dim_student", "dim_course", "fact_grade"]:
        assert rows(read_table(spark, same[name])) == rows(read_table(spark, first[name])), name

    students = [u for u in data["users"] if u["role"] == "student"]
    gone, moved = students[-1], students[0]
    changed = {**data, "users": [
        *({**u, "school_id": "elsewhere"} if u is moved else u for u in data["users"] if u is not gone),
        {**gone, "id": "0-before-all"},
    ]}
    third = pipeline.materialize(spark, make(**changed), root, "r3", with_star=True, effective="2024-03-01")
    old = {r.student_id: r.student_key for r in read_table(spark, first["dim_student"]).collect()}
    new = {r.student_id: r.student_key for r in read_table(spark, third["dim_student"]).collect()}
    assert new.pop("0-before-all") == max(old.values()) + 1
    assert new == {k: v for k, v in old.items() if k in new}
    ends = {(r.student_id, r.school_id): (str(r.effective_from), r.is_current) for r in read_table(spark, third["student_history"]).collect()}
    assert ends["0-before-all", gone["school_id"]] == ("2024-03-01", True)
    assert ends[moved["id"], "elsewhere"] == ("2024-03-01", True)
    assert ends[moved["id"], moved["school_id"]] == ends[gone["id"], gone["school_id"]] == ("2024-01-01", False)
    keys = [r.version_key for r in read_table(spark, third["student_history"]).collect()]
    assert len(keys) == len(set(keys))
    kept = {r.version_key: r.student_id for r in read_table(spark, first["student_history"]).collect()}
    now = {r.version_key: r.student_id for r in read_table(spark, third["student_history"]).collect()}
    assert all(now[k] == v for k, v in kept.items())


def test_repeated_ids_are_refused_with_registers_too(spark, make, tmp_path):
    source = make(schools=[{"id": "s1", "name": "a"}, {"id": "s1", "name": "b"}])
    registers = {"school": star.extended_register(source, "school", None)}
    with pytest.raises(Exception, match="repeated school_id: s1"):
        star.dimensions(source, (), registers)["dim_school"].collect()


def test_second_snapshot_of_a_day_replaces_the_first(spark, rows):
    frame = lambda data: spark.createDataFrame(data, "id string, school string")
    history = star.start_history(frame([("a", "s1"), ("b", "s1")]), "2024-01-01")
    history = star.scd2_merge(history, frame([("a", "s2"), ("b", "s1")]), "id", "2024-05-01")
    history = star.scd2_merge(history, frame([("a", "s3"), ("b", "s1")]), "id", "2024-05-01")
    assert rows(history.select("id", "school", F.col("effective_from").cast("string"), "is_current")) == [
        ("a", "s1", "2024-01-01", False), ("a", "s3", "2024-05-01", True), ("b", "s1", "2024-01-01", True),
    ]


def test_backdated_versions(spark):
    history = spark.createDataFrame(
        [
            ("a", "s1", date(2020, 1, 1), date(2022, 1, 1), False), ("a", "s2", date(2022, 1, 1), END, True),
            ("b", "s1", date(2020, 1, 1), date(2021, 1, 1), False),
        ],
        HISTORY,
    )
    told = spark.createDataFrame(
        [("a", "x", date(2021, 1, 1)), ("a", "y", date(2022, 1, 1)), ("b", "z", date(2023, 1, 1)), ("c", "q", date(2020, 5, 5)), ("a", "w", date(2019, 1, 1))],
        "id string, school string, effective_from date",
    )
    got = sorted((r.id, str(r.effective_from), r.school, str(r.effective_to), r.is_current) for r in star.scd2_backdate(history, told, "id").collect())
    assert got == [
        ("a", "2019-01-01", "w", "2020-01-01", False),
        ("a", "2020-01-01", "s1", "2021-01-01", False),
        ("a", "2021-01-01", "x", "2022-01-01", False),
        ("a", "2022-01-01", "y", "9999-12-31", True),
        ("b", "2020-01-01", "s1", "2021-01-01", False),
        ("b", "2023-01-01", "z", "9999-12-31", True),
        ("c", "2020-05-05", "q", "9999-12-31", True),
    ]
    for bad, match in (([("a", "x", None)], "NULL in effective_from"), ([("a", "x", date(2021, 1, 1)), ("a", "y", date(2021, 1, 1))], "repeated id")):
        with pytest.raises(Exception, match=match):
            star.scd2_backdate(history, spark.createDataFrame(bad, told.schema), "id").collect()


def test_spans_that_changed(spark):
    schema = "id string, effective_from date, effective_to date, k int"
    before = spark.createDataFrame([("a", date(2020, 1, 1), END, 1), ("b", date(2020, 1, 1), END, 2)], schema)
    after = spark.createDataFrame(
        [("a", date(2020, 1, 1), date(2021, 1, 1), 1), ("a", date(2021, 1, 1), date(2022, 1, 1), 3), ("a", date(2022, 1, 1), END, 1), ("b", date(2020, 1, 1), END, 2)],
        schema,
    )
    spans = star.changed_spans(before, after, "id", "k").collect()
    assert [(r.id, str(r.starts), str(r.ends)) for r in spans] == [("a", "2021-01-01", "2022-01-01")]
    assert star.changed_spans(before, before, "id", "k").collect() == []


def test_repair_equals_a_rebuild_and_leaves_other_months(spark, rows, tmp_path):
    rng = random.Random(8)
    grades = spark.createDataFrame(
        [(f"g{i}", rng.choice("abcdx"), datetime(2024, rng.randint(1, 12), rng.randint(1, 28))) for i in range(400)]
        + [("none", "a", None), ("nobody", None, datetime(2024, 5, 5))],
        "grade_id string, id string, created_at timestamp_ntz",
    )
    start = star.start_history(spark.createDataFrame([(c, "s1") for c in "abcd"], "id string, school string"), "2024-01-01")
    keyed = star.with_version_key(start, "id", "version_key")
    path = str(tmp_path / "fact")
    versions.write_fact_as_of(grades, keyed, "id", path, "version_key")

    def files() -> dict[str, int]:
        return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}

    before = files()
    assert versions.repair_fact(grades, keyed, keyed, "id", path, "version_key") == [] and files() == before
    told = spark.createDataFrame([("a", "s2", date(2024, 3, 10)), ("a", "s1", date(2024, 5, 1))], "id string, school string, effective_from date")
    later = star.extend_version_keys(keyed, star.scd2_backdate(start, told, "id"), "id", "version_key")
    months = versions.repair_fact(grades, keyed, later, "id", path, "version_key")
    assert months and min(months) >= 202403 and max(months) <= 202412
    stored = read_table(spark, path).select("grade_id", "version_key")
    wanted = star.as_of(grades, later, "id", "created_at", "version_key").select("grade_id", "version_key")
    assert rows(stored) == rows(wanted) and stored.count() == 402
    after = files()
    same = {p: t for p, t in before.items() if not any(f"month_key={m}/" in p for m in months)}
    assert same and all(after.get(p) == t for p, t in same.items())
