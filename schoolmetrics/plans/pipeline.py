"""Writing all result tables in one session.

Each attempt of a run writes to a folder of its own, `<root>/<run_id>/<attempt>`. Only when every
table is complete, star schema and KPIs included, does a row in `<root>/runs` name that folder and
its tables. Readers that go through `latest_run` or `run_tables` never see half a run; repeating a
run leaves the tables of the earlier attempt as they are, for those who read them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.operators import charts, features, kpis, models, star
from schoolmetrics.operators.reports import REPORTS, grade_rollup
from schoolmetrics.plans.attempts import RUN_SCHEMA, inputs_digest, start_attempt
from schoolmetrics.plans.months import with_months, write_months
from schoolmetrics.sources.tables import LazyTables, literal_table, read_table, write_table

Entities = Mapping[str, DataFrame]
Table = Callable[[str], DataFrame]

# Chart name, the report it shows and how.
_REPORT_CHARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "avg_grade_per_course_bars": ("avg_grade_per_course", partial(charts.bars, category="course_name", value="avg_gpa")),
    "avg_grade_per_teacher_bars": ("avg_grade_per_teacher", partial(charts.bars, category="teacher_name", value="avg_gpa")),
    "homework_submission_rate_bars": ("homework_submission_rate", partial(charts.bars, category="course_name", value="num_homeworks")),
    "course_load_changes_bars": ("course_load_changes", partial(charts.bars, category="student_name", value="num_changes")),
    "school_gpa_bars": ("school_performance", partial(charts.bars, category="school_name", value="avg_gpa")),
    "school_students_bars": ("school_performance", partial(charts.bars, category="school_name", value="total_students")),
    "subject_performance_bars": ("subject_performance", partial(charts.bars, category="subject", value="avg_gpa")),
    "parent_engagement_points": ("parent_engagement", charts.parent_points),
    "teacher_workload_points": ("teacher_workload", charts.teacher_points),
    "grade_distribution_pie": ("grade_distribution", partial(charts.pie, category="grade")),
    "content_analysis_pie": ("content_analysis", partial(charts.pie, category="file_type")),
}

_MODEL_CHARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "cluster_sizes": ("student_clusters", charts.cluster_sizes),
    "cluster_profile": ("student_clusters", charts.cluster_profile),
    "cluster_points": ("student_clusters", charts.cluster_points),
    "dt_metrics_bars": ("dt_metrics", charts.metric_bars),
    "dt_confusion_grid": ("dt_confusion_matrix", charts.confusion_grid),
    "dt_tree_text": ("dt_tree_debug", models.named_tree_text),
}


def _write_all(jobs: Mapping[str, Callable[[], DataFrame]], folder: str) -> dict[str, str]:
    """Write independent tables, a few at a time so small ones fill the gaps large ones leave."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        writes = {name: pool.submit(lambda n=name, j=job: write_table(j(), f"{folder}/{n}")) for name, job in jobs.items()}
        return {name: write.result() for name, write in writes.items()}


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and go on from its files."""
    return read_table(df.sparkSession, write_table(df, path), df.schema)


def write_rollup(entities: Entities, base: str) -> dict[str, str]:
    """The grades rolled up once, into a table all reports on them read."""
    return _write_all({"grade_rollup": lambda: grade_rollup(entities["grades"])}, f"{base}/work")


def write_analytics(entities: Entities, base: str, mean: str = "double") -> dict[str, str]:
    """The ten reports."""
    untyped = ("homework_submission_rate", "course_load_changes")
    jobs = {
        name: partial(report, entities) if name in untyped else partial(report, entities, mean=mean)
        for name, report in REPORTS.items()
    }
    return _write_all(jobs, f"{base}/analytics")


def write_models(entities: Entities, base: str, partitions: int | None = None) -> dict[str, str]:
    """Student features and the six model tables; each step reads what the one before wrote."""
    spark = entities["grades"].sparkSession
    written: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        written[name] = f"{base}/ml/{name}"
        return _stored(df, written[name])

    numbers = put("student_features", features.student_features(entities))
    prepared = models.fit_input(numbers, partitions)
    put("student_clusters", models.segment_students(prepared, prepared=True))
    labeled = models.tree_input(prepared, prepared=True)
    tree = models.fit_tree(labeled)
    predictions = put("dt_predictions", models.predict(labeled, tree))
    put("dt_confusion_matrix", models.confusion_matrix(predictions))
    put("dt_metrics", models.classification_metrics(predictions))
    put("dt_tree_debug", models.tree_text(spark, tree))
    return written


def write_charts(spark: SparkSession, tables: Mapping[str, str], base: str) -> dict[str, str]:
    """The data of every chart whose source table was written."""
    jobs = {
        name: lambda source=source, chart=chart: chart(read_table(spark, tables[source]))
        for name, (source, chart) in (_REPORT_CHARTS | _MODEL_CHARTS).items()
        if source in tables
    }
    return _write_all(jobs, f"{base}/charts")


def materialize(
    spark: SparkSession,
    entities: Entities,
    root: str,
    run_id: str,
    ml: bool = False,
    mean: str = "double",
    partitions: int | None = None,
    with_star: bool = False,
    fact_partition: str = "date_key",
    holidays: Sequence[str] = (),
    monthly: str | None = None,
    months: Sequence[int] | None = None,
    effective: str | None = None,
    resume: bool = False,
) -> dict[str, str]:
    """S7: reports, charts and, if asked for, models, star schema and KPIs; returns table paths by name.

    The run is named in `<root>/runs` as the last step. With `monthly`, a folder that runs share, reports add up
    the roll-ups of all months stored there, and only those of `months` (all, if None) are made anew.
    With `effective`, the day this delivery takes effect, keys and the students' history go on from the last run
    that was given one: members keep their keys, versions theirs, and the same delivery again changes none.
    With `resume`, given in the first try as well, a run goes on after the last step that an unpublished attempt finished
    from equal inputs; that reads each entity once more, for its fingerprint.
    """
    inputs = None
    if resume:
        if monthly is not None:
            raise ValueError("runs share the monthly roll-ups, so steps made from them can't be taken up later")
        last = "" if effective is None else _last_lasting(spark, root).get("student_history", "")
        options = {"mean": mean, "partitions": partitions, "fact_partition": fact_partition, "holidays": list(holidays)}
        inputs = inputs_digest(entities, options | {"effective": effective, "history": last})
    attempt = start_attempt(spark, root, run_id, inputs)
    base = attempt.folder
    if monthly is not None:
        write_months(entities, monthly, months)
        shared = with_months(spark, entities, monthly)
    else:
        rollup = attempt.step("rollup", partial(write_rollup, entities, base))
        shared = {**entities, "grade_rollup": read_table(spark, rollup["grade_rollup"])}
    tables = dict(attempt.step("analytics", partial(write_analytics, shared, base, mean)))
    if ml:
        tables |= attempt.step("models", partial(write_models, shared, base, partitions))
    tables |= attempt.step("charts with models" if ml else "charts", partial(write_charts, spark, dict(tables), base))
    if with_star:
        kept = {} if effective is None else attempt.step("lasting", partial(write_lasting, spark, entities, base, root, effective))
        registers = {k: read_table(spark, kept[f"register_{k}"]) for k in star.KINDS} if kept else None
        written = attempt.step("star", partial(write_star, entities, base, fact_partition, holidays, registers))
        tables |= kept | written | attempt.step("kpis", partial(write_kpis, spark, written, base))
    done = literal_table(spark, [(run_id, base, tables)], "run_id string, folder string, tables map<string, string>")
    done.withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return tables


def _latest(spark: SparkSession, root: str, run_id: str | None = None, holding: str | None = None) -> Row:
    try:
        runs = read_table(spark, f"{root}/runs", RUN_SCHEMA)
        runs = runs if run_id is None else runs.where(F.col("run_id") == run_id)
        runs = runs if holding is None else runs.where(F.map_contains_key("tables", holding))
        found = runs.orderBy(F.desc("finished_at")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        raise LookupError(f"no complete run below {root}")
    return found


def latest_run(spark: SparkSession, root: str, run_id: str | None = None) -> str:
    """Folder of the last complete run, or of the last complete attempt of one run."""
    return _latest(spark, root, run_id)["folder"]


def run_tables(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, str]:
    """Paths of the tables of that run, by name."""
    return _latest(spark, root, run_id)["tables"]


def write_kpis(spark: SparkSession, written: Mapping[str, str], base: str) -> dict[str, str]:
    """K11: the KPI tables, from the stored star schema."""
    stored = LazyTables({name: partial(read_table, spark, path) for name, path in written.items()})
    jobs = {
        "kpi_achievement": partial(kpis.achievement, stored, stored),
        "kpi_homework_rate": partial(kpis.homework_rate, stored, stored),
        "kpi_course_changes": partial(kpis.course_changes, stored, stored),
        "kpi_content_mix": partial(kpis.content_mix, stored),
    }
    return _write_all(jobs, f"{base}/kpis")


def _last_lasting(spark: SparkSession, root: str) -> dict[str, str]:
    """Tables of the last complete run that has keys and history; none if there is no such run."""
    try:
        return _latest(spark, root, holding="student_history")["tables"]
    except LookupError:
        return {}


def write_lasting(spark: SparkSession, entities: Entities, base: str, root: str, effective: str) -> dict[str, str]:
    """K5, K6: key registers and the students' history, extended from the last complete run that has them."""
    earlier = _last_lasting(spark, root)
    jobs = {}
    for kind in star.KINDS:
        known = read_table(spark, earlier[f"register_{kind}"]) if earlier else None
        jobs[f"register_{kind}"] = partial(star.extended_register, entities, kind, known)
    before = read_table(spark, earlier["student_history"]) if earlier else None
    jobs["student_history"] = partial(_student_history, entities, before, effective)
    return _write_all(jobs, f"{base}/lasting")


def _student_history(entities: Entities, before: DataFrame | None, effective: str) -> DataFrame:
    students = star.students(entities)
    if before is None:
        return star.with_version_key(star.start_history(students, effective), "student_id", "version_key")
    merged = star.scd2_merge(before.drop("version_key"), students, "student_id", effective, close_missing=True)
    return star.extend_version_keys(before, merged, "student_id", "version_key")


def write_star(
    entities: Entities,
    base: str,
    fact_partition: str = "date_key",
    holidays: Sequence[str] = (),
    registers: Entities | None = None,
) -> dict[str, str]:
    """Dimensions, then facts joined to the written dimensions.

    K10: facts are partitioned by `date_key`, `month_key` or `school_key` (the student's). The
    rebalance hint gathers a partition's rows into few files and splits it when it is large.
    """
    dims = star.dimensions(entities, holidays, registers)
    # Dimensions that others take keys from come first and are read back from their tables.
    order = [
        "dim_school", "dim_teacher", "dim_student", "dim_parent",
        "dim_course", "dim_action", "dim_content", "dim_date",
    ]
    written: dict[str, str] = {}
    for name in order:
        written[name] = f"{base}/star/{name}"
        dims.replace(name, _stored(dims[name], written[name]))
    for name, fact in star.facts(entities, dims).items():
        rows = _with_partition(fact, fact_partition, dims).hint("rebalance", fact_partition)
        written[name] = write_table(rows, f"{base}/star/{name}", [fact_partition])
    return written


def _with_partition(fact: DataFrame, column: str, dims: Entities) -> DataFrame:
    if column == "month_key":
        return fact.withColumn(column, F.call_function("div", F.col("date_key"), F.lit(100)))
    if column == "school_key":
        return fact.join(dims["dim_student"].select("student_key", "school_key"), "student_key", "left")
    return fact
