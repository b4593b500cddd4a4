from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from schoolmetrics.operators import charts, features, models

SCHEMA = "student_id string, name string, school_id string, num_courses double, num_homeworks double, avg_gpa double, num_changes double"


def students(spark, n=200, seed=1, gpa=None):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        strong = i % 3 == 1
        mean = gpa if gpa is not None else rng.uniform(2.9 if strong else 1.5, 3.9 if strong else 3.1)
        out.append((f"u{i}", f"n{i}", "s", float(rng.randint(3, 9)), float(rng.randint(10, 20) + 9 * strong), mean, float(i % 4)))
    return spark.createDataFrame(out, SCHEMA)


def test_features_fill_and_count(make, rows):
    tables = make(
        users=[{"id": "a", "name": "A", "role": "student", "school_id": "s"}, {"id": "b", "name": "B", "role": "student", "school_id": "s"}, {"id": "t", "name": "T", "role": "teacher", "school_id": "s"}],
        grades=[{"student_id": "a", "course_id": c, "grade": g} for c, g in (("x", "A"), ("x", "P"), ("y", "B"))],
        homeworks=[{"student_id": "a", "course_id": "x"}] * 2,
        adjustments=[{"student_id": "a", "course_id": "x", "action": "add"}],
    )
    expected = [("a", "A", "s", 2.0, 2.0, 3.5, 1.0), ("b", "B", "s", 0.0, 0.0, 0.0, 0.0)]
    assert rows(features.student_features(tables)) == expected


def test_label_threshold(spark):
    df = features.high_performer_label(students(spark, 3, gpa=3.0))
    assert [r["label"] for r in df.collect()] == [1.0] * 3
    assert features.high_performer_label(df.drop("label"), 3.1).agg(F.max("label")).first()[0] == 0.0


def test_segments_do_not_depend_on_input_partitions(spark, rows):
    df = students(spark)
    first = models.segment_students(df, partitions=4)
    assert first.columns == [*df.columns, "cluster"]
    assert {r["cluster"] for r in first.collect()} == {0, 1, 2, 3}
    for n in (1, 3, 9):
        assert rows(models.segment_students(df.repartition(n), partitions=4)) == rows(first)


def test_clusters_are_numbered_by_centre(spark):
    centres = charts.cluster_profile(models.segment_students(students(spark), partitions=4))
    first_feature = centres.where("feature = 'num_courses'").orderBy("cluster").collect()
    assert [r["value"] for r in first_feature] == sorted(r["value"] for r in first_feature)


def test_segments_are_a_fixed_point_of_k_means(spark):
    """Brute force: every student is nearest to the mean of its own cluster, in standard units."""
    pdf = models.segment_students(students(spark, 300), partitions=4).toPandas()
    x = pdf[features.FEATURES].to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    centres = np.array([z[pdf["cluster"] == c].mean(axis=0) for c in range(4)])
    nearest = ((z[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == pdf["cluster"]).mean() > 0.98
    assert [tuple(c) for c in centres] == sorted(map(tuple, centres))


def test_first_split_is_the_best_one(spark):
    """Brute force: no single threshold on one feature leaves purer halves than the tree's root."""
    labeled = models.tree_input(students(spark, 150, seed=3), partitions=4)
    pdf = models.predict(labeled, models.fit_tree(labeled, max_depth=1)).toPandas()

    def impurity(left):
        sides = [pdf["label"][left], pdf["label"][~left]]
        return sum(len(s) * 2 * s.mean() * (1 - s.mean()) for s in sides if len(s))

    best = min(impurity(pdf[f] <= v) for f in models.TREE_FEATURES for v in pdf[f].unique())
    assert impurity(pdf["prediction"] == 1.0) == pytest.approx(best)


def test_tree_and_metrics_agree_with_evaluators(spark):
    predictions = models.classify_students(students(spark), partitions=4).cache()
    assert predictions.columns == ["student_id", "name", "avg_gpa", "num_courses", "num_homeworks", "num_changes", "label", "prediction"]
    metrics = models.classification_metrics(predictions).first()
    for column, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")):
        expected = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(predictions)
        assert metrics[column] == pytest.approx(expected, abs=1e-12)
    assert metrics["accuracy"] > 0.7
    assert models.confusion_matrix(predictions).agg(F.sum("count")).first()[0] == 200


def test_one_class_only(spark, rows):
    predictions = models.classify_students(students(spark, 20, gpa=1.0), partitions=2)
    assert rows(models.confusion_matrix(predictions)) == [(0.0, 0.0, 20)]
    assert rows(charts.confusion_grid(models.confusion_matrix(predictions))) == [(0.0, 20, 0)]
    assert rows(models.classification_metrics(predictions)) == [(1.0, 1.0, 1.0)]


def test_metrics_of_known_confusion(spark, rows):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3
    df = spark.createDataFrame(pairs, "label double, prediction double")
    accuracy, precision, recall = rows(models.classification_metrics(df))[0]
    assert (accuracy, recall) == (0.8, 0.8)
    assert precision == pytest.approx(0.7 * 1.0 + 0.3 * 0.6)


def test_tree_text_names_features(spark):
    labeled = models.tree_input(students(spark), partitions=2)
    raw = models.tree_text(spark, models.fit_tree(labeled))
    text = models.named_tree_text(raw).first()[0]
    assert "feature num_homeworks" in text and "feature 1" not in text and "depth=3" in text
    numbered = spark.createDataFrame([("feature 1 feature 10 feature  2",)], "debug_string string")
    assert models.named_tree_text(numbered).first()[0] == "feature num_homeworks feature 10 feature num_changes"


def test_no_students(spark):
    none = students(spark, 0)
    assert models.segment_students(none).collect() == []
    predictions = models.classify_students(none)
    assert predictions.collect() == []
    assert models.classification_metrics(predictions).first().asDict() == dict.fromkeys(["accuracy", "weighted_precision", "weighted_recall"])
    assert models.tree_text(spark, None).first()[0] == models.NO_TREE
