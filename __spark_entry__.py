
from __future__ import annotations

import sys
from collections.abc import Callable
from importlib import import_module
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import duckdb_oracle  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from schoolmetrics.operators import charts, features, kpis, models, reports, star  # noqa: E402
from schoolmetrics.plans import attempts, months, pipeline, versions  # noqa: E402
from schoolmetrics.schemas import ENTITIES  # noqa: E402
from schoolmetrics.sources import integrity, tables  # noqa: E402
from schoolmetrics.sources.driver_tables import TABLES, entities  # noqa: E402
from schoolmetrics.sources.scratch import scratch_path  # noqa: E402
from schoolmetrics.streaming import content_access  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

REPORT_IDS = dict(zip([f"Q{i}" for i in range(1, 11)], reports.REPORTS.values(), strict=True))


def entry(spark: SparkSession) -> DataFrame:
    """Q7, school performance, on the smallest data set."""
    return reports.school_performance(entities(spark, "/root/testdata/sf0.001"))


def _on_entities(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(entities(spark, sf_dir))


def _in_decimals(report: Callable[..., DataFrame]) -> Query:
    """A report with decimal means and shares, given as text so both engines print the digits alike."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = report(entities(spark, sf_dir), mean="decimal")
        decimals = [name for name, kind in df.dtypes if kind.startswith("decimal")]
        return df.withColumns({name: F.col(name).cast("string") for name in decimals})

    return run


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.student_features(entities(spark, sf_dir))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.segment_students(_features(spark, sf_dir))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.classify_students(_features(spark, sf_dir))


def _tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = models.fit_tree(models.tree_input(_features(spark, sf_dir)))
    return models.named_tree_text(models.tree_text(spark, fitted))


def _model_queries() -> dict[str, Query]:
    def on(source: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = source(spark, sf_dir)
            for step in steps:
                df = step(df)
            return df

        return run

    return {
        "F1": _features,
        "M1": _clusters,
        "M2": on(_features, features.high_performer_label),
        "M3": _predictions,
        "M4": on(_predictions, models.classification_metrics),
        "M5": on(_predictions, models.confusion_matrix),
        "M6": _tree_text,
        "C5": on(_clusters, charts.cluster_sizes),
        "C6": on(_clusters, charts.cluster_profile),
        "C7": on(_clusters, charts.cluster_points),
        "C8": on(_predictions, models.classification_metrics, charts.metric_bars),
        "C9": on(_predictions, models.confusion_matrix, charts.confusion_grid),
    }


def _companion_queries() -> dict[str, Query]:
    """The steps after a fit, on predictions and clusters that follow from a column, and what a fit must not change."""

    def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
        labeled = features.high_performer_label(_features(spark, sf_dir))
        return labeled.withColumn("prediction", F.when(F.col("num_homeworks") >= 2, 1.0).otherwise(0.0))

    def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _features(spark, sf_dir).withColumn("cluster", F.least("num_changes", F.lit(3.0)).cast("int"))

    def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
        return charts.cluster_profile(clustered(spark, sf_dir)).withColumn("value", F.round("value", 6))

    def cluster_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
        """What holds of a right segmentation: four clusters of all students, closer together than everyone is."""
        names = features.FEATURES
        moments = [m for c in names for m in (F.avg(c).alias(f"{c}_mean"), F.var_pop(c).alias(f"{c}_var"))]
        each = _clusters(spark, sf_dir).groupBy("cluster").agg(F.count("*").alias("n"), *moments)

        def share_inside(c: str) -> Column:
            inside = F.sum(F.col("n") * F.coalesce(F.col(f"{c}_var"), F.lit(0.0)))
            between = F.sum(F.col("n") * F.col(f"{c}_mean") ** 2) - F.sum(F.col("n") * F.col(f"{c}_mean")) ** 2 / F.sum("n")
            return F.coalesce(inside / F.nullif(inside + between, F.lit(0.0)), F.lit(0.0))

        ratio = sum((share_inside(c) for c in names), F.lit(0.0)) / len(names)
        return each.agg(
            F.sum("n").alias("n_students"), F.count("*").alias("n_clusters"), F.min("cluster").cast("long").alias("lowest"),
            F.max("cluster").cast("long").alias("highest"), (ratio < 0.7).alias("closer"),
        )

    def tree_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Every student is predicted, and the tree is right at least as often as its best leaf alone would be."""
        cells = models.confusion_matrix(_predictions(spark, sf_dir))
        hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
        either = F.greatest(*[F.sum(F.when(F.col("label") == x, F.col("count")).otherwise(0)) for x in (0.0, 1.0)])
        kinds = F.max((~F.col("prediction").isin(0.0, 1.0)).cast("int")) == 0
        return cells.agg(
            F.sum("count").alias("n_students"), kinds.alias("two_classes"), (F.sum(hit) >= either).alias("beats_one_leaf")
        )

    def text_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = F.col("debug_string")
        depth = F.regexp_extract(text, r"depth=(\d+)", 1).cast("int")
        return _tree_text(spark, sf_dir).select(
            (depth <= 3).alias("shallow"), text.rlike(r"feature\s+\d").alias("unnamed"), text.contains("Predict").alias("decides")
        )

    return {
        "M1_facts": cluster_facts,
        "M3_facts": tree_facts,
        "M6_facts": text_facts,
        "M1_students": lambda spark, sf_dir: _clusters(spark, sf_dir).drop("cluster"),
        "M3_students": lambda spark, sf_dir: _predictions(spark, sf_dir).drop("prediction"),
        "M4_rule": lambda spark, sf_dir: models.classification_metrics(predicted(spark, sf_dir)),
        "M5_rule": lambda spark, sf_dir: models.confusion_matrix(predicted(spark, sf_dir)),
        "C5_rule": lambda spark, sf_dir: charts.cluster_sizes(clustered(spark, sf_dir)),
        "C6_rule": profile,
        "C7_rule": lambda spark, sf_dir: charts.cluster_points(clustered(spark, sf_dir)),
        "C8_rule": lambda spark, sf_dir: charts.metric_bars(models.classification_metrics(predicted(spark, sf_dir))),
        "C9_rule": lambda spark, sf_dir: charts.confusion_grid(models.confusion_matrix(predicted(spark, sf_dir))),
    }


def _chart_queries() -> dict[str, Query]:
    def on(report: str, chart: Callable[..., DataFrame], *args: str) -> Query:
        return lambda spark, sf_dir: chart(REPORT_IDS[report](entities(spark, sf_dir)), *args)

    return {
        "C1_course": on("Q1", charts.bars, "course_name", "avg_gpa"),
        "C1_teacher": on("Q2", charts.bars, "teacher_name", "avg_gpa"),
        "C1_homework": on("Q3", charts.bars, "course_name", "num_homeworks"),
        "C1_changes": on("Q5", charts.bars, "student_name", "num_changes"),
        "C1_school_gpa": on("Q7", charts.bars, "school_name", "avg_gpa"),
        "C1_school_students": on("Q7", charts.bars, "school_name", "total_students"),
        "C1_subject": on("Q8", charts.bars, "subject", "avg_gpa"),
        "C2": on("Q4", charts.parent_points),
        "C3": on("Q9", charts.teacher_points),
        "C4_grades": on("Q6", charts.pie, "grade"),
        "C4_contents": on("Q10", charts.pie, "file_type"),
    }


def _ingested(entity: str) -> Query:
    """Check an entity against its schema, write it, read it back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = tables.ingest(entities(spark, sf_dir)[entity], entity, scratch_path(spark, entity))
        return tables.read_table(spark, path, ENTITIES[entity])

    return run


def _scan_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    grades = _ingested("grades")(spark, sf_dir)
    return grades.groupBy("course_id").agg(
        F.count("*").alias("n"), F.countDistinct("student_id").alias("students")
    )


def _differing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is reported of grades that came without comments, with dates as text, and in part with points for letters."""
    grades, path = entities(spark, sf_dir)["grades"], scratch_path(spark, "deliveries")
    came = grades.withColumn("updated_at", F.col("updated_at").cast("string")).drop("comments")
    odd = F.col("id").endswith("7")
    came.where(~odd).write.parquet(path)
    came.where(odd).withColumn("points", F.length("grade")).drop("grade").write.mode("append").parquet(path)
    return integrity.schema_differences(spark, path, ENTITIES["grades"])


def _sql_on_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_views(entities(spark, sf_dir))
    return spark.sql(
        "SELECT s.name AS school_name, u.role, COUNT(*) AS n "
        "FROM users u JOIN schools s ON s.id = u.school_id GROUP BY s.name, u.role"
    )


def _written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.content_analysis(entities(spark, sf_dir))
    return tables.read_table(spark, tables.write_table(report, scratch_path(spark, "content_analysis")))


def _resumed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean grades by school from a run that was broken off after its roll-up and taken up again."""
    root, source = scratch_path(spark, "runs"), entities(spark, sf_dir, stored=True)
    options = {"mean": "double", "partitions": None, "fact_partition": "date_key", "holidays": [], "effective": None, "history": ""}
    first = attempts.start_attempt(spark, root, "run-1", attempts.inputs_digest(source, options))
    first.step("rollup", lambda: pipeline.write_rollup(source, first.folder))
    pipeline.materialize(spark, source, root, "run-1", resume=True)
    if pipeline.latest_run(spark, root) != first.folder:
        raise RuntimeError("the run began anew")
    return tables.read_table(spark, pipeline.run_tables(spark, root)["school_performance"])


def _fingerprint_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each entity, whether its fingerprint is that of its rows in another order, and whether of rows with one column changed."""
    source = entities(spark, sf_dir, stored=True)
    moved = {name: df.repartition("id").sortWithinPartitions(F.desc("id")) for name, df in source.items()}
    changed = {name: df.withColumn("id", F.concat("id", F.lit("x"))) for name, df in source.items()}
    found = attempts.fingerprints(source)
    for name, other in (("moved", moved), ("changed", changed)):
        sums = attempts.fingerprints(other).select("table_name", F.struct("sum_a", "sum_b").alias(name))
        found = found.join(sums, "table_name")
    own = F.struct("sum_a", "sum_b")
    return found.select("table_name", "n_rows", (own == F.col("moved")).alias("same_moved"), (own == F.col("changed")).alias("same_changed"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the reports, student tables, dimensions and facts of a full run with models and star schema."""
    root = scratch_path(spark, "runs")
    pipeline.materialize(spark, entities(spark, sf_dir, stored=True), root, "run-1", ml=True, with_star=True)
    written = pipeline.run_tables(spark, root)
    students = ["student_features", "student_clusters", "dt_predictions"]
    names = [*reports.REPORTS, *students, *sorted(n for n in written if n.startswith(("dim_", "fact_", "kpi_")))]
    counts = [
        tables.read_table(spark, written[name]).agg(F.lit(name).alias("table_name"), F.count("*").alias("num_rows"))
        for name in names
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total


def _faulty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The entities after a delivery that left out users and courses, and brought some grades twice."""
    source = dict(entities(spark, sf_dir, stored=True).items())
    for name, digit in (("users", "7"), ("courses", "3")):
        source[name] = source[name].where(~F.col("id").endswith(digit))
    source["grades"] = source["grades"].unionByName(source["grades"].where(F.col("id").endswith("99")))
    return source


def _on_faulty(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_faulty(spark, sf_dir))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each entity stay, and how many are put aside by the columns that point nowhere."""
    good, bad = integrity.quarantined(_faulty(spark, sf_dir))
    kept = [good[n].agg(F.lit(n).alias("entity"), F.lit("").alias("columns"), F.count("*").alias("n_rows")) for n in ENTITIES]
    aside = bad.groupBy("entity", F.array_join("columns", ",").alias("columns")).agg(F.count("*").alias("n_rows"))
    for part in kept:
        aside = aside.unionByName(part)
    return aside


def _unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course changes by course name, those of unknown courses under NULL; an inner join loses none."""
    source = _faulty(spark, sf_dir)
    dims = star.dimensions(source)
    fact = integrity.pointed_to_unknown(star.fact_course_load_change(source, dims), "course_key", "student_key")
    courses = integrity.with_unknown_member(dims["dim_course"], "course_key").select("course_key", "name")
    return fact.join(courses, "course_key").groupBy("name").agg(F.sum("change_count").alias("n_changes"))


def _by_months(report: Callable[..., DataFrame]) -> Query:
    """A report on months of which the later ones were added, and one half-written one replaced, by a second run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, root = entities(spark, sf_dir, stored=True), scratch_path(spark, "months")
        early = F.col("created_at") < F.lit("1996-12-15").cast("timestamp_ntz")
        late = F.col("created_at") >= F.lit("1999-01-01").cast("timestamp_ntz")
        months.write_months({name: df.where(early | late) if "created_at" in df.columns else df for name, df in source.items()}, root)
        added = [199612, *(year * 100 + month for year in (1997, 1998) for month in range(1, 13))]
        months.write_months(source, root, added)
        return report(months.with_months(spark, source, root))

    return run


def _students_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct graded students per subject from bitmaps of two runs."""
    source, path = entities(spark, sf_dir, stored=True), scratch_path(spark, "bitmaps")
    students = source["grades"].select("student_id").distinct()
    keys = star.with_surrogate_key(students, "student_id", "student_key")
    others = source["grades"].where(F.year("created_at") != 1998)
    months.write_student_bitmaps(others, keys, path)
    months.write_student_bitmaps(source["grades"], keys, path, [199800 + month for month in range(1, 13)])
    return months.students_per_subject(tables.read_table(spark, path), source["courses"])


def _table_queries() -> dict[str, Query]:
    return {
        **{f"S2_{entity}": _ingested(entity) for entity in ENTITIES},
        "S2_orphans": _on_faulty(integrity.orphans),
        "S2_repeated_ids": _on_faulty(integrity.repeated_ids),
        "S2_quarantine": _quarantine,
        "S2_unknown_member": _unknown_members,
        "S3": _scan_by_path,
        "S3_differences": _differing_files,
        "S4": _sql_on_views,
        "S5": _written_report,
        "S7": _pipeline,
        "S7_fingerprints": _fingerprint_facts,
        "S7_resume": _resumed_report,
        "S7_incremental": _by_months(reports.school_performance),
        "S7_incremental_homework": _by_months(reports.homework_submission_rate),
        "S7_incremental_letters": _by_months(reports.grade_distribution),
        "S7_incremental_contents": _by_months(reports.content_analysis),
        "S7_incremental_changes": _by_months(reports.course_load_changes),
        "S7_student_bitmaps": _students_by_bitmap,
    }


def _star_queries() -> dict[str, Query]:
    holidays = ["1996-01-01", "1996-12-25"]

    def dimension(name: str) -> Query:
        return lambda spark, sf_dir: star.dimensions(entities(spark, sf_dir), holidays)[name]

    def fact(name: str) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            source = entities(spark, sf_dir)
            return star.facts(source, star.dimensions(source))[name]

        return run

    def kpi(rollup: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            source = entities(spark, sf_dir)
            dims = star.dimensions(source)
            return rollup(star.facts(source, dims), dims)

        return run

    def keyed_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
        grades = entities(spark, sf_dir)["grades"].select("id", "grade").distinct()
        return star.with_surrogate_key(grades, "id", "grade_key")

    def partitioned_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = entities(spark, sf_dir, stored=True)
        written = pipeline.write_star(source, scratch_path(spark, "star"), "month_key")
        return tables.read_table(spark, written["fact_grade"])

    return {
        "K1_dim_date": lambda spark, sf_dir: _dates_as_text(dimension("dim_date")(spark, sf_dir)),
        "K2_dim_student": dimension("dim_student"),
        "K2_dim_teacher": dimension("dim_teacher"),
        "K2_dim_parent": dimension("dim_parent"),
        "K3_dim_course": dimension("dim_course"),
        "K4_dim_school": dimension("dim_school"),
        "K4_dim_action": dimension("dim_action"),
        "K4_dim_content": dimension("dim_content"),
        "K5": keyed_grades,
        "K6": _student_history,
        "K6_close_missing": lambda spark, sf_dir: _student_history(spark, sf_dir, close_missing=True),
        "K6_versions_last": _lasting_versions,
        "K7": _student_overwrite,
        "K5_extend": _extended_keys,
        "K8_fact_grade_asof": _grades_as_of,
        "K8_repaired": _repaired_grades,
        "K8_fact_grade": fact("fact_grade"),
        "K9_fact_homework": fact("fact_homework"),
        "K9_fact_course_load_change": fact("fact_course_load_change"),
        "K10": partitioned_fact,
        "K11_achievement": kpi(kpis.achievement),
        "K11_homework_rate": kpi(kpis.homework_rate),
        "K11_course_changes": kpi(kpis.course_changes),
        "K11_content_mix": kpi(lambda facts, dims: kpis.content_mix(dims)),
    }


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which both engines hand over alike."""
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({name: F.col(name).cast("string") for name in dates})


def _student_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as students; a year later those in debt have moved to S0, every seventh has left, suppliers have joined."""

    def table(name: str) -> DataFrame:
        return tables.read_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])

    def keyed(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    home, moved = keyed("S", "c_nationkey"), F.when(F.col("c_acctbal") < 0, "S0")
    who = [keyed("U", "c_custkey").alias("student_id"), F.col("c_name").alias("name")]
    before = table("customer").select(*who, home.alias("school_id"))
    stayed = table("customer").where(F.col("c_custkey") % 7 != 0)
    after = stayed.select(*who, F.coalesce(moved, home).alias("school_id"))
    joined = table("supplier").select(
        keyed("X", "s_suppkey").alias("student_id"),
        F.col("s_name").alias("name"),
        keyed("S", "s_nationkey").alias("school_id"),
    )
    return before, after.unionByName(joined)


def _student_history(spark: SparkSession, sf_dir: str, close_missing: bool = False) -> DataFrame:
    before, after = _student_snapshots(spark, sf_dir)
    first = star.start_history(before, "2020-09-01")
    return _dates_as_text(star.scd2_merge(first, after, "student_id", "2021-09-01", close_missing))


def _extended_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _student_snapshots(spark, sf_dir)
    earlier = star.with_surrogate_key(before, "student_id", "student_key")
    return star.extend_keys(earlier, after, "student_id", "student_key")


def _lasting_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version keys after a second snapshot, and after the same snapshot once more."""
    before, after = _student_snapshots(spark, sf_dir)
    keyed = star.with_version_key(star.start_history(before, "2020-09-01"), "student_id", "version_key")
    for day in ("2021-09-01", "2022-09-01"):
        history = star.scd2_merge(keyed.drop("version_key"), after, "student_id", day, close_missing=True)
        keyed = star.extend_version_keys(keyed, history, "student_id", "version_key")
    return _dates_as_text(keyed)


def _dated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _student_snapshots(spark, sf_dir)
    history = star.scd2_merge(star.start_history(before, "1993-01-01"), after, "student_id", "1996-01-01", close_missing=True)
    return star.with_version_key(history, "student_id", "version_key")


def _dated_grades(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    return entities(spark, sf_dir, stored)["grades"].select("id", "student_id", "created_at")


def _grades_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    grades, keyed = _dated_grades(spark, sf_dir), _dated_versions(spark, sf_dir)
    return star.as_of(grades, keyed, "student_id", "created_at", "version_key").drop("created_at")


def _repaired_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades by version, stored by month and keyed anew where every fifth student turns out to have moved earlier."""
    grades, keyed, path = _dated_grades(spark, sf_dir, stored=True), _dated_versions(spark, sf_dir), scratch_path(spark, "versions")
    versions.write_fact_as_of(grades, keyed, "student_id", path, "version_key")
    moved = _student_snapshots(spark, sf_dir)[0].where(F.substring("student_id", 2, 20).cast("long") % 5 == 0)
    told = moved.withColumns({"school_id": F.lit("S0"), "effective_from": F.lit("1995-03-01").cast("date")})
    history = star.scd2_backdate(keyed.drop("version_key"), told, "student_id")
    later = star.extend_version_keys(keyed, history, "student_id", "version_key")
    versions.repair_fact(grades, keyed, later, "student_id", path, "version_key")
    return tables.read_table(spark, path).select("id", "student_id", "version_key")


def _student_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _student_snapshots(spark, sf_dir)
    return star.scd1_merge(before, after, "student_id")


def _accesses(events: DataFrame) -> DataFrame:
    """Events as content accesses: ten consecutive events fall on one content."""
    content = F.concat(F.lit("D"), F.call_function("div", F.col("event_id"), F.lit(10)).cast("string"))
    student = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    return events.select(
        "ts", student.alias("student_id"), content.alias("content_id"), F.col("event_type").alias("access_type")
    )


def _access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = content_access.event_stream(spark, sf_dir, TABLES["events"], "events.parquet")
    target, checkpoint = scratch_path(spark, "access"), scratch_path(spark, "access-state")
    content_access.run_access_log(_accesses(events), target, checkpoint).awaitTermination()
    return tables.read_table(spark, target)


def _streamed_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_access.access_counts(_access_log(spark, sf_dir))


def _batch_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.read_table(spark, f"{sf_dir}/events.parquet", TABLES["events"])
    return content_access.access_counts(_accesses(events))


def _recounted_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept by a stream of eight batches, with the log merged in the middle."""
    folder, log, counts, state = (scratch_path(spark, name) for name in ("deliveries", "log", "counts", "log-state"))
    events = tables.read_table(spark, f"{sf_dir}/events.parquet", TABLES["events"])
    accesses = _accesses(events)
    for half in range(2):
        part = accesses.where(F.coalesce(F.dayofmonth("ts") % 2, F.lit(0)) == half)
        part.repartition(4).write.mode("append").parquet(folder)
        stream = content_access.event_stream(spark, folder, accesses.schema, per_batch=1)
        content_access.run_access_counts(stream, log, counts, state).awaitTermination()
        content_access.compact(spark, log, accesses.schema, least=3)
    return tables.read_table(spark, counts).drop("access_date")


def _access_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = star.dimensions(entities(spark, sf_dir))
    return content_access.fact_content_access(_access_log(spark, sf_dir), dims)


def queries() -> dict[str, Query]:
    return {
        **{name: _on_entities(report) for name, report in REPORT_IDS.items()},
        **{f"{name}_decimal": _in_decimals(r) for name, r in REPORT_IDS.items() if name not in ("Q3", "Q5")},
        **_model_queries(),
        **_companion_queries(),
        **_chart_queries(),
        **_table_queries(),
        **_star_queries(),
        "K12": _streamed_access,
        "K12_batch": _batch_access,
        "K12_recount": _recounted_access,
        "K12_fact_content_access": _access_fact,
        **_training_data_queries(),
    }


def _has_training_data() -> bool:
    """Whether the subpackage of training-data operators is here; the rest of the library does without it."""
    return bool(find_spec("schoolmetrics.llm") and find_spec("schoolmetrics.llm.queries"))


def _training_data_queries() -> dict[str, Query]:
    if not _has_training_data():
        return {}
    found = import_module("schoolmetrics.llm.queries").queries()
    if find_spec("corpus_pipeline"):
        found["pipeline"] = import_module("corpus_pipeline").run
    return found


def oracle_sql() -> dict[str, str]:
    more = import_module("schoolmetrics.llm.sql").oracle_sql() if _has_training_data() else {}
    return duckdb_oracle.oracle_sql() | more
