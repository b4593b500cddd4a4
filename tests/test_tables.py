from __future__ import annotations

import pytest
from conftest import SF_DIR
from school import district

from schoolmetrics.__main__ import main
from schoolmetrics.operators import kpis, star
from schoolmetrics.plans import pipeline
from schoolmetrics.schemas import ENTITIES
from schoolmetrics.sources import scratch, tables
from schoolmetrics.sources.driver_tables import entities


def test_ingest_keeps_schema_and_rows(spark, make, tmp_path, rows):
    users = make(users=[{"name": "A", "email": "e", "role": "student", "school_id": "s"}])["users"]
    wide = users.selectExpr("*", "1 AS extra")
    path = tables.ingest(wide, "users", str(tmp_path / "users"))
    back = tables.read_table(spark, path, ENTITIES["users"])
    assert back.columns == ENTITIES["users"].names
    assert rows(back) == rows(users)
    # Writing again replaces the rows.
    tables.ingest(users.limit(0), "users", path)
    assert tables.read_table(spark, path, ENTITIES["users"]).count() == 0


def test_ingest_rejects_null_in_required_column(make, tmp_path, rows):
    users = make(users=[{"id": "ok", "name": "A", "email": "e", "role": "student", "school_id": "s"}, {"id": "bad", "name": None}])["users"]
    assert [r[0] for r in rows(tables.violations(users, ENTITIES["users"]))] == ["bad"]
    with pytest.raises(Exception, match="NULL in required column"):
        tables.ingest(users, "users", str(tmp_path / "users"))


def test_violations_find_values_that_do_not_cast(spark, make, rows):
    users = make(users=[{"id": "x", "name": "A", "email": "e", "role": "r", "school_id": "s"}])["users"]
    broken = users.withColumn("is_active", users.name)
    broken = broken.replace("A", "not a boolean", subset=["is_active"])
    assert len(rows(tables.violations(broken, ENTITIES["users"]))) == 1


def test_views_and_entities_by_path(spark, make, tmp_path, rows):
    written = make(**district(1))
    for name, df in written.items():
        tables.write_table(df, f"{tmp_path}/{name}")
    read = tables.read_entities(spark, str(tmp_path))
    tables.register_views(read)
    assert spark.sql("SELECT COUNT(*) FROM grades").first()[0] == 300
    assert rows(read["grades"]) == rows(written["grades"])


def test_durable_keeps_partitions(spark):
    df = spark.range(100).repartition(5, "id")
    kept = scratch.durable(df)
    assert kept.rdd.getNumPartitions() == 5
    assert kept.count() == 100
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_full_run(spark, make, tmp_path, rows):
    source, root = make(**district(2)), str(tmp_path / "out")
    with pytest.raises(LookupError):
        pipeline.latest_run(spark, root)
    first = pipeline.materialize(spark, source, root, "run-1", ml=True, partitions=2)
    assert len(first) == 10 + 6 + 11 + 6
    for name, report in pipeline.REPORTS.items():
        assert rows(tables.read_table(spark, first[name])) == rows(report(source)), name
    pipeline.materialize(spark, source, root, "run-2")
    assert pipeline.latest_run(spark, root).startswith(f"{root}/run-2/")
    # A repeat has a folder of its own, without the models it wasn't asked for; who reads the first attempt can go on.
    held = tables.read_table(spark, first["grade_distribution"])
    again = pipeline.materialize(spark, source, root, "run-1")
    assert pipeline.run_tables(spark, root) == again
    assert "student_clusters" not in again
    assert rows(held) == rows(tables.read_table(spark, again["grade_distribution"]))
    assert pipeline.run_tables(spark, root, "run-2")["grade_distribution"].startswith(f"{root}/run-2/")


def test_failed_star_is_not_published(spark, make, tmp_path, monkeypatch):
    rows_in, root = district(4), str(tmp_path / "out")

    def fail(*args):
        raise RuntimeError("no space left")

    monkeypatch.setattr(pipeline, "write_star", fail)
    with pytest.raises(RuntimeError):
        pipeline.materialize(spark, make(**rows_in), root, "run-1", with_star=True)
    with pytest.raises(LookupError):
        pipeline.latest_run(spark, root)


def test_command_line(spark, make, tmp_path, rows):
    rows_in = district(4)
    rows_in["users"] = rows_in["users"][:40]
    for name, df in make(**rows_in).items():
        tables.write_table(df, f"{tmp_path}/in/{name}")
    options = ["--star", "--mean", "decimal", "--fact-partition", "month_key", "--holidays", "2024-09-01"]
    written = main([f"{tmp_path}/in", f"{tmp_path}/out", "first", *options])
    assert len(written) == 10 + 11 + 8 + 3 + 4
    assert "month_key" in spark.read.parquet(written["fact_grade"]).columns
    assert spark.read.parquet(written["dim_date"]).where("is_holiday").count() == 1
    source = {name: spark.read.parquet(f"{tmp_path}/in/{name}") for name in rows_in}
    dims = star.dimensions(source)
    expected = kpis.achievement(star.facts(source, dims), dims)
    assert rows(spark.read.parquet(written["kpi_achievement"])) == rows(expected)
    assert dict(spark.read.parquet(written["school_performance"]).dtypes)["avg_gpa"] == "decimal(6,5)"
    assert spark.read.parquet(written["fact_homework"]).count() == 200


@pytest.mark.parametrize("column", ["date_key", "month_key", "school_key"])
def test_star_tables_partitioned(spark, make, tmp_path, rows, column):
    rows_in = district(3)
    # Natural keys of a dimension are unique.
    rows_in["users"] = rows_in["users"][:40]
    source = make(**rows_in)
    written = pipeline.write_star(source, str(tmp_path), column)
    fact = tables.read_table(spark, written["fact_grade"])
    assert fact.count() == 300 and column in fact.columns
    dims = star.dimensions(source)
    assert rows(fact.select("student_key", "course_key", "grade_letter")) == rows(
        star.fact_grade(source, dims).select("student_key", "course_key", "grade_letter")
    )


def test_stored_line_items_give_the_same_entities(spark, rows, capsys):
    """Line items meet their orders once, however often grades and homeworks are read."""
    plain, kept = entities(spark, SF_DIR), entities(spark, SF_DIR, stored=True)
    for name in ("grades", "homeworks"):
        assert kept[name].schema == plain[name].schema
        assert rows(kept[name]) == rows(plain[name]), name
        kept[name].explain()
        assert "Join" not in capsys.readouterr().out, name
