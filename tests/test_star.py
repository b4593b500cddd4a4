from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from school import district

from schoolmetrics.operators import star

FOREVER = date(9999, 12, 31)


def test_surrogate_keys_are_dense_and_ordered(spark):
    ids = [f"k{i}" for i in range(997)]
    df = spark.createDataFrame([(i, 1) for i in ids], "id string, x int").repartition(13)
    keyed = star.with_surrogate_key(df, "id", "key")
    assert keyed.columns == ["key", "id", "x"]
    assert sorted(map(tuple, keyed.select("id", "key").collect())) == list(zip(sorted(ids), range(1, 998), strict=True))
    assert star.with_surrogate_key(df.limit(0), "id", "key").collect() == []


def test_calendar(spark, rows):
    df = spark.createDataFrame([(datetime(2023, 12, 31, 23),), (datetime(2024, 1, 2),)], "created_at timestamp_ntz")
    assert rows(star.dim_date(df, ["2024-01-01"])) == [
        (20231231, date(2023, 12, 31), 52, 12, 4, 2023, False),
        (20240101, date(2024, 1, 1), 1, 1, 1, 2024, True),
        (20240102, date(2024, 1, 2), 1, 1, 1, 2024, False),
    ]
    assert star.dim_date(df.limit(0)).collect() == []


def _history(spark, rows_in):
    return star.start_history(spark.createDataFrame(rows_in, "id string, name string"), "2020-01-01")


def test_scd2_closes_and_opens(spark, rows):
    history = _history(spark, [("a", "Ann"), ("b", "Bo"), ("c", None), ("d", "Di")])
    snapshot = spark.createDataFrame([("a", "Ann"), ("b", "Bob"), ("c", "Cy"), ("e", "Eve")], "id string, name string")
    merged = star.scd2_merge(history, snapshot, "id", "2021-01-01")
    old, new = date(2020, 1, 1), date(2021, 1, 1)
    assert rows(merged) == sorted(
        [
            ("a", "Ann", old, FOREVER, True),
            ("b", "Bo", old, new, False),
            ("b", "Bob", new, FOREVER, True),
            ("c", None, old, new, False),
            ("c", "Cy", new, FOREVER, True),
            ("d", "Di", old, FOREVER, True),
            ("e", "Eve", new, FOREVER, True),
        ],
        key=repr,
    )
    # One current row per key, and the same snapshot again changes nothing.
    assert merged.where("is_current").groupBy("id").count().where("count > 1").count() == 0
    assert rows(star.scd2_merge(merged, snapshot, "id", "2022-01-01")) == rows(merged)


def test_scd2_can_close_missing(spark, rows):
    snapshot = spark.createDataFrame([("a", "Ann")], "id string, name string")
    merged = star.scd2_merge(_history(spark, [("a", "Ann"), ("z", "Zed")]), snapshot, "id", "2021-01-01", close_missing=True)
    assert [(r[0], r[4]) for r in rows(merged)] == [("a", True), ("z", False)]
    back = spark.createDataFrame([("a", "Ann"), ("z", "Zed")], "id string, name string")
    assert star.scd2_merge(merged, back, "id", "2022-01-01").where("id = 'z'").count() == 2


def test_scd1_overwrites(spark, rows):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    new = spark.createDataFrame([(2, "Y"), (3, "z")], "k int, v string")
    assert rows(star.scd1_merge(old, new, "k")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_facts_keep_rows_without_a_dimension(make):
    source = make(
        grades=[{"course_id": "nope", "student_id": "u", "grade": "A-"}],
        users=[{"id": "u", "name": "U", "role": "student", "school_id": "s"}],
    )
    fact = star.fact_grade(source, star.dimensions(source)).first()
    assert fact["course_key"] is None and fact["student_key"] == 1
    assert fact["grade_numeric"] == 3.7 and fact["date_key"] == 20240901


def test_content_type_from_path(make):
    paths = ["/files/c/quiz_3.pdf", "/files/a_b/video_1_x.mp4", "plain.pdf"]
    source = make(contents=[{"file_path": p, "file_type": "pdf"} for p in paths])
    dim = star.dimensions(source)["dim_content"].orderBy("content_id")
    assert [r["content_type"] for r in dim.select(F.col("content_type")).collect()] == ["quiz", "video", ""]


def test_keys_last_and_versions_are_found(spark):
    old = star.with_surrogate_key(spark.createDataFrame([("b",), ("d",)], "id string"), "id", "k")
    new = star.extend_keys(old, spark.createDataFrame([("a",), ("d",), ("c",)], "id string"), "id", "k")
    assert {r.id: r.k for r in new.collect()} == {"a": 3, "c": 4, "d": 2}
    again = star.extend_keys(new, spark.createDataFrame([("a",), ("d",), ("c",)], "id string"), "id", "k")
    assert {r.id: r.k for r in again.collect()} == {"a": 3, "c": 4, "d": 2}


@pytest.mark.parametrize("rows", [[("a", "x"), ("a", "x")], [(None, "x")]])
def test_history_refuses_bad_snapshots(spark, rows):
    history = star.start_history(spark.createDataFrame([("a", "y")], "id string, name string"), "2020-01-01")
    with pytest.raises(Exception, match="snapshot"):
        star.scd2_merge(history, spark.createDataFrame(rows, "id string, name string"), "id", "2021-01-01").collect()


def test_history_refuses_an_earlier_date(spark):
    history = star.start_history(spark.createDataFrame([("a", "y")], "id string, name string"), "2020-01-01")
    with pytest.raises(Exception, match="effective date"):
        star.scd2_merge(history, spark.createDataFrame([("a", "z")], "id string, name string"), "id", "2019-01-01").collect()


def test_facts_join_keys_only(spark, make):
    """With broadcasts off a fact takes one join for each key, and no dimension attribute."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_in = district(3)
        rows_in["users"] = rows_in["users"][:40]
        source = make(**rows_in)
        plan = star.fact_grade(source, star.dimensions(source))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftOuter") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_ids_are_refused(make):
    """A repeated id would multiply the facts that point to it."""
    for entity, row in (("users", {"id": "u1", "role": "student"}), ("courses", {"id": "c1"}), ("contents", {"id": "d1"}), ("schools", {"id": "s1"})):
        dims = star.dimensions(make(**{entity: [row, {**row, "name": "other"}]}))
        name = {"users": "dim_student", "courses": "dim_course", "contents": "dim_content", "schools": "dim_school"}[entity]
        with pytest.raises(Exception, match="repeated"):
            dims[name].collect()


def test_keys_last_and_null_keys_are_refused(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, id string")
    second = spark.createDataFrame([("b", 1), ("d", 2), ("aa", 3)], "id string, x int")
    keyed = star.extend_keys(first, second, "id", "k")
    assert rows(keyed) == [(2, "b", 1), (4, "aa", 3), (5, "d", 2)]
    # The register keeps the numbers of members that left.
    register = star.key_register(first, second, "id", "k")
    assert rows(star.key_register(register, spark.createDataFrame([("e",)], "id string"), "id", "k"))[-1] == (6, "e")
    with pytest.raises(Exception, match="NULL in id"):
        star.extend_keys(first, spark.createDataFrame([(None, 1)], "id string, x int"), "id", "k").collect()


def test_version_keys_survive_a_merge(spark, rows):
    old = spark.createDataFrame([("a", "s1"), ("b", "s1"), ("c", "s2")], "id string, school string")
    new = spark.createDataFrame([("a", "s9"), ("b", "s1"), ("c", "s2")], "id string, school string")
    keyed = star.with_version_key(star.start_history(old, "2024-01-01"), "id", "version_key")
    for _ in range(2):
        merged = star.scd2_merge(keyed.drop("version_key"), new, "id", "2025-01-01")
        keyed = star.extend_version_keys(keyed, merged, "id", "version_key")
        got = {(r.version_key, r.id, r.school, str(r.effective_from)) for r in keyed.collect()}
        assert got == {(1, "a", "s1", "2024-01-01"), (2, "b", "s1", "2024-01-01"), (3, "c", "s2", "2024-01-01"), (4, "a", "s9", "2025-01-01")}
