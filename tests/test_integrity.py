"""References that point nowhere, ids that come twice, and rows put aside."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from school import district

from schoolmetrics.operators import star
from schoolmetrics.schemas import ENTITIES
from schoolmetrics.sources import integrity


def test_orphans_and_repeated_ids(make, rows):
    plain = district(11, hot=True)
    plain["grades"] += [{"id": "g1", "course_id": None, "student_id": "u2"}]
    tables = make(**plain)
    wanted = Counter()
    for (entity, column), parent in integrity.RELATIONS.items():
        known = {r["id"] for r in plain[parent]}
        wanted.update((entity, column, r.get(column)) for r in plain[entity] if r.get(column) not in known)
    assert {tuple(r)[:3]: r.n_rows for r in integrity.orphans(tables).collect()} == wanted and wanted
    assert rows(integrity.repeated_ids(tables)) == [("grades", "g1", 2), ("users", "u1", 2)]


def test_every_row_is_kept_or_put_aside(make, rows):
    plain = district(12)
    plain["grades"] += [{"id": "gx", "course_id": None, "student_id": "nobody"}] * 2
    tables = make(**plain)
    good, bad = integrity.quarantined(tables)
    aside = bad.collect()
    for entity in ENTITIES:
        kept = rows(good[entity])
        mine = [r.id for r in aside if r.entity == entity]
        assert Counter(r[0] for r in kept) + Counter(mine) == Counter(r["id"] for r in tables[entity].collect())
        assert good[entity].columns == tables[entity].columns
    assert [r["columns"] for r in aside if r.id == "gx"] == [["course_id", "student_id"]] * 2
    for (entity, column), parent in integrity.RELATIONS.items():
        ids = {r["id"] for r in plain[parent]}
        assert {r[column] for r in good[entity].collect()} <= ids


def test_nothing_to_put_aside(make):
    good, bad = integrity.quarantined(make())
    assert bad.count() == 0 and all(df.count() == 0 for df in good.values())


def test_unknown_members_keep_facts(make, rows):
    tables = make(**{**district(13), "users": district(13)["users"][:40]})
    dims = star.dimensions(tables)
    fact = integrity.pointed_to_unknown(star.fact_grade(tables, dims), "student_key", "course_key")
    students = integrity.with_unknown_member(dims["dim_student"], "student_key")
    assert students.columns == dims["dim_student"].columns and students.where("student_key = -1").count() == 1
    courses = integrity.with_unknown_member(dims["dim_course"], "course_key")
    joined = fact.join(students.select("student_key"), "student_key").join(courses.select("course_key"), "course_key")
    assert joined.count() == tables["grades"].count()


def test_files_that_differ_from_the_schema(spark, make, tmp_path):
    root = str(tmp_path)
    tables = {name: df.na.fill("x") for name, df in make(**district(2)).items()}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
        assert integrity.schema_differences(spark, f"{root}/{name}", ENTITIES[name]).collect() == []
    integrity.refuse_schema_differences(spark, root)
    assert integrity.schema_differences(spark, f"{root}/users", StructType(ENTITIES["users"].fields[:2])).count() == 7
    tables["grades"].limit(7).drop("grade").withColumn("n", F.lit(1)).coalesce(1).write.mode("append").parquet(f"{root}/grades")
    found = integrity.schema_differences(spark, f"{root}/grades", ENTITIES["grades"]).collect()
    assert sorted(tuple(r) for r in found) == [("grade", "missing", "string", "string", 7), ("n", "extra", None, "int", 7)]
    with pytest.raises(integrity.SchemaMismatch, match="grades.grade missing in 7 rows"):
        integrity.refuse_schema_differences(spark, root)
    # An empty table lacks what no file has.
    tables["homeworks"].limit(0).drop("course_id").write.mode("overwrite").parquet(f"{root}/homeworks")
    assert [r.column_name for r in integrity.schema_differences(spark, f"{root}/homeworks", ENTITIES["homeworks"]).collect()] == ["course_id"]
