"""Student segments (M1) and the high-performer classifier with its evaluation (M3-M6).

Fitting is distributed (spark.ml); only cluster centres and the tree come back to the
driver. Both fits read a checkpoint of the features hash-partitioned and sorted by student, in
a number of parts that follows from the number of students: a result depends on the data, not
on a setting of the session or on how the input arrived.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.operators.features import FEATURES, high_performer_label
from schoolmetrics.sources.scratch import durable
from schoolmetrics.sources.tables import literal_table

# GPA is left out: it defines the label.
TREE_FEATURES = ["num_courses", "num_homeworks", "num_changes"]
NO_TREE = "No decision tree was fitted."
LEAST_PARTS, ROWS_PER_PART = 8, 500_000
#: Starts of k-means; the one with the least cost is taken.
SEEDS = (42, 43)


def fit_input(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """Checkpoint the features in a reproducible layout: `partitions` parts, or one per ROWS_PER_PART students."""
    n = partitions or max(LEAST_PARTS, -(-features.count() // ROWS_PER_PART))
    return durable(features.repartition(n, "student_id").sortWithinPartitions("student_id", "name"))


def _scaled(columns: list[str]) -> list:
    return [
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
    ]


def segment_students(
    features: DataFrame,
    k: int = 4,
    seeds: Sequence[int] = SEEDS,
    partitions: int | None = None,
    prepared: bool = False,
) -> DataFrame:
    """M1: k-means over the four standardised features; adds `cluster`.

    Of several starts the one with the least training cost is taken, the first of equals. Clusters are numbered by their
    sorted centres, since the numbers k-means hands out are arbitrary. `prepared` features come from `fit_input`.
    """
    rows = features if prepared else fit_input(features, partitions)
    if rows.isEmpty():
        return rows.withColumn("cluster", F.lit(None).cast("int"))
    scaling = Pipeline(stages=_scaled(FEATURES)).fit(rows)
    scaled = durable(scaling.transform(rows).select(*features.columns, "_scaled"))
    fits = [KMeans(k=k, seed=s, featuresCol="_scaled", predictionCol="_cluster").fit(scaled) for s in seeds]
    model = min(fits, key=lambda fit: fit.summary.trainingCost)
    centres = [tuple(c) for c in model.clusterCenters()]
    by_centre = sorted(range(len(centres)), key=centres.__getitem__)
    number = F.array(*[F.lit(by_centre.index(old)) for old in range(len(centres))])
    return model.transform(scaled).select(
        *features.columns, F.element_at(number, F.col("_cluster") + 1).alias("cluster")
    )


def fit_tree(labeled: DataFrame, max_depth: int = 3, seed: int = 42) -> PipelineModel | None:
    """Decision tree over the standardised TREE_FEATURES; None when there are no rows."""
    if labeled.isEmpty():
        return None
    # Both classes are declared, so the fit also works when the data holds only one.
    classes = {"ml_attr": {"type": "nominal", "name": "label", "vals": ["0.0", "1.0"]}}
    declared = labeled.withColumn("label", F.col("label").alias("label", metadata=classes))
    tree = DecisionTreeClassifier(
        labelCol="label", featuresCol="_scaled", predictionCol="prediction", maxDepth=max_depth, seed=seed
    )
    return Pipeline(stages=[*_scaled(TREE_FEATURES), tree]).fit(declared)


def tree_input(
    features: DataFrame, threshold: float = 3.0, partitions: int | None = None, prepared: bool = False
) -> DataFrame:
    """Labelled features, laid out for fitting; `prepared` features come from `fit_input`."""
    return high_performer_label(features if prepared else fit_input(features, partitions), threshold)


def predict(labeled: DataFrame, model: PipelineModel | None) -> DataFrame:
    """M3: label and prediction of every student; the tree scores the rows it was fitted on."""
    columns = ["student_id", "name", "avg_gpa", *TREE_FEATURES, "label"]
    if model is None:
        return labeled.select(*columns, F.lit(None).cast("double").alias("prediction"))
    return model.transform(labeled).select(*columns, "prediction")


def classify_students(
    features: DataFrame,
    threshold: float = 3.0,
    max_depth: int = 3,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """M2 and M3 in one call: label, fit and score."""
    labeled = tree_input(features, threshold, partitions)
    return predict(labeled, fit_tree(labeled, max_depth, seed))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """M5: rows per (label, prediction); combinations that do not occur are absent."""
    return predictions.groupBy("label", "prediction").count()


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """M4: accuracy, weighted precision and weighted recall from one pass over the predictions."""
    cells = confusion_matrix(predictions)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("actual"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("actual"), F.col("count").alias("predicted"), zero.alias("hits")),
    )
    per_class = cells.select(F.inline(sides)).groupBy("cls").agg(
        *[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")]
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))

    def weighted(score: Column) -> Column:
        return F.try_divide(F.sum(score * F.col("actual")), F.sum("actual"))

    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def tree_text(spark: SparkSession, model: PipelineModel | None) -> DataFrame:
    """M6: the fitted tree's rules as a one-row table."""
    stages = model.stages if model is not None else []
    trees = [s for s in stages if isinstance(s, DecisionTreeClassificationModel)]
    return literal_table(spark, [(trees[0].toDebugString if trees else NO_TREE,)], "debug_string string")


def name_features(text: Column, names: list[str]) -> Column:
    """Put feature names in the place of `feature <index>` numbers; unknown indexes stay."""
    numbered = list(enumerate(names))
    return reduce(lambda t, nf: F.regexp_replace(t, rf"feature\s+{nf[0]}\b", f"feature {nf[1]}"), numbered, text)


def named_tree_text(debug: DataFrame, names: list[str] | None = None) -> DataFrame:
    """M6 for readers: the tree text with feature names."""
    named = name_features(F.col("debug_string"), TREE_FEATURES if names is None else names)
    return debug.select(named.alias("debug_string"))
