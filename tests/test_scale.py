"""Plans must not depend on small tables or even keys."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR
from school import district

import __spark_entry__ as driver
from schoolmetrics.operators import reports, star

REPORTS = [*driver.REPORT_IDS, "F1", "K8_fact_grade", "K11_achievement", "K11_homework_rate"]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8000",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", REPORTS)
def test_no_cartesian_product_and_pruned_scans(spark, name):
    plan = driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan):
        columns = {c.split("#")[0] for c in scan.split(",")}
        assert columns <= {"l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus"}, name


def test_results_without_any_broadcast(spark, make, rows, no_broadcast):
    tables = make(**district(7, hot=True))
    from school import brute_force

    for name, expected in brute_force(district(7, hot=True)).items():
        assert rows(driver.REPORT_IDS[name](tables)) == expected, name


def hot_grades(spark, tables):
    """Half of all grades on one course."""
    return spark.range(0, 60000, 1, 16).selectExpr(
        "concat('g', id) AS id",
        "IF(id % 2 = 0, 'c0', concat('c', id % 12)) AS course_id",
        "concat('u', id % 4001) AS student_id",
        "TIMESTAMP_NTZ '2024-09-01 00:00:00' AS created_at",
        "'A' AS grade",
    )


def test_hot_course_is_split_where_rows_are_joined(spark, make, no_broadcast):
    tables = make(**district(8))
    tables["grades"] = hot_grades(spark, tables)
    dims = star.dimensions(make(**{**district(8), "users": district(8)["users"][:40]}))
    assert "skew=true" in final_plan(star.fact_grade(tables, dims))
    assert "skew=true" in final_plan(reports.subject_performance(tables))


def test_hot_course_is_summed_before_the_join(spark, make, no_broadcast):
    tables = make(**district(9))
    tables["grades"] = hot_grades(spark, tables)
    plan = reports.avg_grade_per_course(tables)
    metrics = final_plan(plan)
    # Grades are reduced to one row per course before their shuffle, so no skew is left to split.
    assert "partial_sum" in metrics and "skew=true" not in metrics
