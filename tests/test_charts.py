from __future__ import annotations

from schoolmetrics.operators import charts

PARENTS = "parent_name string, num_children bigint, avg_gpa double"
TEACHERS = "teacher_name string, school_name string, courses_taught bigint, students_taught bigint, total_grades_given bigint, avg_gpa_given double"


def test_bar_labels(spark, rows):
    means = spark.createDataFrame([("Art", 2.125), ("Gym", None)], "c string, v double")
    assert rows(charts.bars(means, "c", "v")) == [("Art", 2.125, "2.12"), ("Gym", None, None)]
    counts = spark.createDataFrame([("Art", 7)], "c string, v bigint")
    assert rows(charts.bars(counts, "c", "v")) == [("Art", 7, "7")]


def test_few_parents_all_get_the_full_name(spark, rows):
    df = spark.createDataFrame([("Ann Lee", 1, 2.0), ("Bo Ray", 2, 3.0), ("Cy Fox", 3, 1.0)], PARENTS)
    assert [(r[0], r[3]) for r in rows(charts.parent_points(df))] == [(n, n) for n in ("Ann Lee", "Bo Ray", "Cy Fox")]


def test_parent_labels_with_ties(spark, rows):
    df = spark.createDataFrame([(f"Mr P{i:02d}", i, 2.0) for i in range(20)], PARENTS)
    labels = {r[0]: r[3] for r in rows(charts.parent_points(df.repartition(5)))}
    full = {n for n, label in labels.items() if n == label}
    # Equal means fall back to the name; then the two fewest and two most children.
    assert full == {f"Mr P{i:02d}" for i in (0, 1, 2, 3, 4, 18, 19)}
    assert labels["Mr P10"] == "P10" and len(labels) == 20


def test_teacher_points(spark, rows):
    people = [(f"T {i}", "S", 1, i, 10 * i, 4.0 - i / 100) for i in range(20)] + [("T x", "S", 1, 0, 0, None)]
    result = {r["teacher_name"]: r for r in charts.teacher_points(spark.createDataFrame(people, TEACHERS)).collect()}
    assert len(result) == 20 and "T x" not in result
    assert {n for n, r in result.items() if r["label"] == n} == {f"T {i}" for i in (0, 1, 2, 3, 14, 15, 16, 17, 18, 19)}
    assert [result[f"T {i}"]["marker_size"] for i in (0, 2, 3, 10)] == [50.0, 50.0, 60.0, 200.0]


def test_same_named_teachers_at_two_schools(spark, rows):
    people = [("T", f"S{i}", 1, i, 1, 1.0) for i in range(12)]
    result = charts.teacher_points(spark.createDataFrame(people, TEACHERS), top_students=1, top_gpa=0)
    assert len(rows(result)) == 12


def test_pie(spark, rows):
    df = spark.createDataFrame([("A", 1), ("B+", 2), ("P", 5)], "grade string, count bigint")
    assert rows(charts.pie(df, "grade")) == [("A", 1, "12.5%", 2), ("B+", 2, "25.0%", 4), ("P", 5, "62.5%", 0)]


def test_metric_bars(spark, rows):
    df = spark.createDataFrame([(0.5, 0.25, 1.0)], "accuracy double, weighted_precision double, weighted_recall double")
    assert rows(charts.metric_bars(df)) == [("accuracy", 0.5, "0.50"), ("weighted_precision", 0.25, "0.25"), ("weighted_recall", 1.0, "1.00")]


def test_confusion_grid_fills_gaps(spark, rows):
    df = spark.createDataFrame([(0.0, 1.0, 2), (1.0, 1.0, 3)], "label double, prediction double, count bigint")
    assert rows(charts.confusion_grid(df)) == [(0.0, 0, 2), (1.0, 0, 3)]


def test_branches_share_one_aggregation(spark):
    """The report below the rankings is computed once; the other branches reuse its shuffle."""
    base = spark.range(1000).selectExpr("concat('p ', id % 50) AS parent_name", "id")
    report = base.groupBy("parent_name").agg({"id": "sum", "*": "count"})
    report = report.selectExpr("parent_name", "`count(1)` AS num_children", "CAST(`sum(id)` AS DOUBLE) AS avg_gpa")
    points = charts.parent_points(report)
    points.collect()
    plan = points._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 3


def test_namesakes_of_picked_rows_keep_short_labels(spark):
    rows = [(f"p{i}", "Ann Lee" if i < 2 else f"Parent {i}", i, float(i == 0)) for i in range(12)]
    report = spark.createDataFrame(rows, "parent_id string, parent_name string, num_children long, avg_gpa double")
    got = {r.parent_id: r.label for r in charts.parent_points(report, top_gpa=1, extremes=0).collect()}
    assert got["p0"] == "Ann Lee" and got["p1"] == "Lee" and len(got) == 12
