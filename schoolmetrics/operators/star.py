"""Star schema over the entities: dimensions, facts and slowly changing updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schoolmetrics.functions.scales import FULL, GradeScale, subject_of
from schoolmetrics.sources.scratch import durable
from schoolmetrics.sources.tables import LazyTables

Entities = Mapping[str, DataFrame]

FOREVER = "9999-12-31"

#: Dimensions whose keys a register holds.
KINDS = ("school", "student", "teacher", "parent", "course", "action", "content")


def _names(natural_key: str | Sequence[str]) -> list[str]:
    return [natural_key] if isinstance(natural_key, str) else list(natural_key)


def _refuse_repeats(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows as they are; the job fails on a repeated key. Rows that lie together by key aren't shuffled again."""
    copies = F.count("*").over(Window.partitionBy(*order))
    shown = F.concat_ws(", ", *[F.col(c).cast("string") for c in order])
    once = F.assert_true(F.col("_copies") == 1, F.concat(F.lit(f"repeated {', '.join(order)}: "), shown))
    return df.withColumn("_copies", copies).where(once.isNull()).drop("_copies")


def with_surrogate_key(df: DataFrame, natural_key: str | Sequence[str], name: str, unique: bool = False) -> DataFrame:
    """K5: add dense integers 1..n in natural-key order as the first column.

    Rows are range-partitioned and sorted by the natural key, so a key is the number of rows
    in earlier partitions plus the position in its own; no partition sees more than its range.
    The layout is checkpointed because both counts must come from the same partitions.
    With `unique` the job fails on a repeated key; equal keys share a partition, so they are counted where they lie.
    """
    order = _names(natural_key)
    ranged = df.repartitionByRange(*order)
    if unique:
        ranged = _refuse_repeats(ranged, order)
    placed = durable(ranged.sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id()))
    # monotonically_increasing_id holds the partition above bit 33 and the row number below.
    partition, position = F.shiftright("_slot", 33), F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, however long the table is.
    offsets = sizes.select("_partition", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select((F.col("_offset") + position + 1).alias(name), *df.columns)
    )


def key_register(existing: DataFrame | None, incoming: DataFrame, natural_key: str | Sequence[str], name: str) -> DataFrame:
    """K5: every natural key ever seen with its number: those of `existing` as they are, new ones after the largest.

    New keys are dense and in natural order. A run that stores the register never gives a number twice, also when the
    member with the largest one is gone. The job fails on an incoming key that is or holds NULL.
    """
    order = _names(natural_key)
    present = [F.coalesce(c, F.raise_error(F.lit(f"NULL in {c}"))).alias(c) for c in order]
    ids = incoming.select(*present).distinct()
    if existing is None:
        return with_surrogate_key(ids, order, name)
    known = existing.select(name, *order)
    largest = existing.agg(F.max(name)).first()[0] or 0
    added = with_surrogate_key(ids.join(known, order, "left_anti"), order, name)
    return known.unionByName(added.withColumn(name, F.col(name) + largest))


def extend_keys(existing: DataFrame, incoming: DataFrame, natural_key: str | Sequence[str], name: str) -> DataFrame:
    """K5: incoming rows with their keys; ids of `existing` keep theirs, new ones follow the largest, dense and in order.

    Facts of earlier runs go on pointing to the same members. The job fails on a NULL key.
    """
    order = _names(natural_key)
    keys = durable(key_register(existing, incoming, order, name))
    return incoming.join(keys, order).select(name, *incoming.columns)


def registered_keys(register: DataFrame, rows: DataFrame, natural_key: str, name: str) -> DataFrame:
    """K5: rows with their keys from a register that knows all of them; the job fails on a repeated key."""
    known = register.select(name, natural_key)
    return _refuse_repeats(rows.join(known, natural_key).select(name, *rows.columns), [natural_key])


def with_version_key(history: DataFrame, natural_key: str, name: str) -> DataFrame:
    """K6: a surrogate key for each version of a dimension with history."""
    return with_surrogate_key(history, [natural_key, "effective_from"], name)


def extend_version_keys(earlier: DataFrame, history: DataFrame, natural_key: str, name: str) -> DataFrame:
    """K6: the history after a merge with its version keys; versions of the keyed history before keep theirs.

    A version is known by its member and first day, which a merge never changes: closing it moves only its end. Facts
    stored with a version key go on pointing to that version, and merging the same snapshot again changes no key.
    """
    return extend_keys(earlier, history, [natural_key, "effective_from"], name)


def as_of(rows: DataFrame, versions: DataFrame, natural_key: str, moment: str, key: str) -> DataFrame:
    """K8: rows with the key of the version that is valid on their date, NULL where none is.

    An equi-join on the natural key with the dates as further condition: versions of one member are few.
    """
    spans = versions.select(F.col(natural_key).alias("_member"), "effective_from", "effective_to", key)
    day = F.col(moment).cast("date")
    valid = (F.col(natural_key) == F.col("_member")) & (F.col("effective_from") <= day) & (day < F.col("effective_to"))
    return rows.join(spans, valid, "left").select(*rows.columns, key)


def date_key(moment: Column) -> Column:
    """yyyymmdd as a number."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)


def dim_date(days: DataFrame, holidays: Sequence[str] = ()) -> DataFrame:
    """K1: the calendar between the first and last timestamp of column `created_at`, both included."""
    span = days.agg(F.min("created_at").cast("date").alias("lo"), F.max("created_at").cast("date").alias("hi"))
    known = span.where(F.col("lo").isNotNull())
    day = F.col("date")
    return known.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
        date_key(day).alias("date_key"),
        day,
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        day.cast("string").isin(list(holidays)).alias("is_holiday"),
    )


def activity_days(entities: Entities) -> DataFrame:
    """`created_at` of every dated fact."""
    dated = [entities[name].select("created_at") for name in ("grades", "homeworks", "adjustments")]
    return dated[0].unionByName(dated[1]).unionByName(dated[2])


def _keyed(df: DataFrame, dimension: DataFrame, natural: str, key: str) -> DataFrame:
    """Replace a natural key by the dimension's surrogate key; NULL where the dimension lacks it."""
    return df.join(dimension.select(natural, key), natural, "left").drop(natural)


def _keys(dims: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Natural ids and keys of a dimension, without its attributes where they are known apart."""
    return dims[f"keys_{name}" if f"keys_{name}" in dims else f"dim_{name}"]


def _people(entities: Entities, role: str) -> DataFrame:
    chosen = entities["users"].where(F.col("role") == role)
    return chosen.select(F.col("id").alias(f"{role}_id"), "name", "school_id")


def students(entities: Entities) -> DataFrame:
    """The attributes of students that a history follows."""
    return _people(entities, "student")


def _members(entities: Entities, kind: str) -> DataFrame:
    """The rows of a dimension before they have a key."""
    unknown = F.lit(None).cast("string")
    if kind == "school":
        return entities["schools"].select(
            F.col("id").alias("school_id"), "name", unknown.alias("type"), unknown.alias("region")
        )
    if kind == "course":
        return entities["courses"].select(F.col("id").alias("course_id"), "name", "school_id", "teacher_id")
    if kind == "action":
        return entities["adjustments"].select(F.col("action").alias("action_name")).distinct()
    if kind == "content":
        return entities["contents"].select(
            F.col("id").alias("content_id"),
            "file_type",
            F.regexp_extract("file_path", r"([^/_]+)_[^/]*$", 1).alias("content_type"),
            "course_id",
            "teacher_id",
        )
    return _people(entities, kind)


def natural_key(kind: str) -> str:
    return "action_name" if kind == "action" else f"{kind}_id"


def _numbered(entities: Entities, kind: str, registers: Mapping[str, DataFrame] | None) -> DataFrame:
    """The members with their surrogate keys, from a register where runs keep one."""
    members = _members(entities, kind)
    if registers is None:
        return with_surrogate_key(members, natural_key(kind), f"{kind}_key", unique=True)
    return registered_keys(registers[kind], members, natural_key(kind), f"{kind}_key")


def extended_register(entities: Entities, kind: str, earlier: DataFrame | None) -> DataFrame:
    """K5: the register of a dimension's keys after a delivery; numbers of the earlier one stay."""
    return key_register(earlier, _members(entities, kind), natural_key(kind), f"{kind}_key")


def dim_school(entities: Entities, registers: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """K4: schools; type and region have no source yet."""
    return _numbered(entities, "school", registers)


def person_keys(entities: Entities, role: str, registers: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The users of one role with their surrogate keys: what facts need of the dimension."""
    return _numbered(entities, role, registers)


def dim_person(role: str, people: DataFrame, schools: DataFrame) -> DataFrame:
    """K2: the keyed users of one role with the key of their school."""
    columns = [f"{role}_key", f"{role}_id", "name", "school_key"]
    return _keyed(people, schools, "school_id", "school_key").select(*columns)


def course_keys(entities: Entities, registers: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The courses with their surrogate keys: what facts need of the dimension."""
    return _numbered(entities, "course", registers)


def dim_course(
    courses: DataFrame,
    schools: DataFrame,
    teachers: DataFrame,
    rules: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """K3: keyed courses; subject by the report rules, level the last word of the name."""
    keyed = courses.select(
        "course_key",
        "course_id",
        "name",
        subject_of(F.col("name"), rules).alias("subject"),
        F.substring_index("name", " ", -1).alias("level"),
        "school_id",
        "teacher_id",
    )
    keyed = _keyed(keyed, schools, "school_id", "school_key")
    keyed = _keyed(keyed, teachers, "teacher_id", "teacher_key")
    return keyed.select("course_key", "course_id", "name", "subject", "level", "school_key", "teacher_key")


def dim_action(entities: Entities, registers: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """K4: the kinds of course change."""
    return _numbered(entities, "action", registers)


def dim_content(
    entities: Entities, courses: DataFrame, teachers: DataFrame, registers: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """K4: contents; the type is the file name up to its number (`.../quiz_3.pdf` is a quiz)."""
    keyed = _numbered(entities, "content", registers)
    keyed = _keyed(keyed, courses, "course_id", "course_key")
    keyed = _keyed(keyed, teachers, "teacher_id", "teacher_key")
    return keyed.select("content_key", "content_id", "file_type", "content_type", "course_key", "teacher_key")


def dimensions(
    entities: Entities, holidays: Sequence[str] = (), registers: Mapping[str, DataFrame] | None = None
) -> LazyTables:
    """Every dimension by name, each keyed when first asked for.

    `keys_*` hold natural id and key before the dimension's own lookups, so that facts join nothing they don't use.
    With `registers`, by kind of member, keys come from these instead of being dealt anew.
    """
    dims = LazyTables(
        {
            "keys_student": lambda: person_keys(entities, "student", registers),
            "keys_teacher": lambda: person_keys(entities, "teacher", registers),
            "keys_parent": lambda: person_keys(entities, "parent", registers),
            "keys_course": lambda: course_keys(entities, registers),
            "dim_date": lambda: dim_date(activity_days(entities), holidays),
            "dim_school": lambda: dim_school(entities, registers),
            "dim_student": lambda: dim_person("student", dims["keys_student"], dims["dim_school"]),
            "dim_teacher": lambda: dim_person("teacher", dims["keys_teacher"], dims["dim_school"]),
            "dim_parent": lambda: dim_person("parent", dims["keys_parent"], dims["dim_school"]),
            "dim_course": lambda: dim_course(dims["keys_course"], dims["dim_school"], dims["keys_teacher"]),
            "dim_action": lambda: dim_action(entities, registers),
            "dim_content": lambda: dim_content(entities, dims["keys_course"], dims["keys_teacher"], registers),
        }
    )
    return dims


def _fact(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Student, course and date keys for rows with student_id, course_id and created_at.

    Every row is kept. A course or student with a large part of the rows is handled by the
    adaptive skew join: each join is followed by a shuffle on another key or by the output.
    """
    keyed = _keyed(df, _keys(dims, "course"), "course_id", "course_key")
    keyed = _keyed(keyed, _keys(dims, "student"), "student_id", "student_key")
    return keyed.withColumn("date_key", date_key(F.col("created_at")))


def fact_grade(entities: Entities, dims: Mapping[str, DataFrame], scale: GradeScale = FULL) -> DataFrame:
    """K8: one row per grade; points earned and possible have no source yet."""
    rows = entities["grades"].select("student_id", "course_id", "created_at", "grade")
    unknown = F.lit(None).cast("double")
    return _fact(rows, dims).select(
        "student_key",
        "course_key",
        "date_key",
        (scale.points(F.col("grade")).cast("double") / 10).alias("grade_numeric"),
        F.col("grade").alias("grade_letter"),
        unknown.alias("points_earned"),
        unknown.alias("points_possible"),
    )


def fact_homework(entities: Entities, dims: Mapping[str, DataFrame]) -> DataFrame:
    """K9: one row per homework handed in."""
    rows = entities["homeworks"].select("student_id", "course_id", "created_at", "file_type")
    keys = ["student_key", "course_key", "date_key"]
    return _fact(rows, dims).select(*keys, F.lit(1).alias("submitted_flag"), "file_type")


def fact_course_load_change(entities: Entities, dims: Mapping[str, DataFrame]) -> DataFrame:
    """K9: one row per course change."""
    rows = entities["adjustments"].select(
        "student_id", "course_id", "created_at", F.col("action").alias("action_name")
    )
    keyed = _keyed(_fact(rows, dims), dims["dim_action"], "action_name", "action_key")
    keys = ["student_key", "course_key", "date_key", "action_key"]
    return keyed.select(*keys, F.lit(1).alias("change_count"))


def facts(entities: Entities, dims: Mapping[str, DataFrame]) -> LazyTables:
    """Every fact table by name."""
    return LazyTables(
        {
            "fact_grade": lambda: fact_grade(entities, dims),
            "fact_homework": lambda: fact_homework(entities, dims),
            "fact_course_load_change": lambda: fact_course_load_change(entities, dims),
        }
    )


def start_history(snapshot: DataFrame, effective: str) -> DataFrame:
    """First SCD2 version of a dimension: every row current from the effective date."""
    return _current_from(snapshot, effective)


def _current_from(df: DataFrame, effective: str) -> DataFrame:
    return df.withColumns(
        {
            "effective_from": F.lit(effective).cast("date"),
            "effective_to": F.lit(FOREVER).cast("date"),
            "is_current": F.lit(True),
        }
    )


def _one_per_key(snapshot: DataFrame, natural_key: str) -> DataFrame:
    """The snapshot; the job fails where a key is NULL or comes twice."""
    rest = [c for c in snapshot.columns if c != natural_key]
    present = F.coalesce(F.col(natural_key), F.raise_error(F.lit(f"NULL in {natural_key} of a snapshot")))
    grouped = snapshot.groupBy(present.alias(natural_key)).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_row")
    )
    repeated = F.raise_error(F.concat(F.lit(f"repeated {natural_key} in a snapshot: "), F.col(natural_key).cast("string")))
    once = grouped.withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(repeated))
    return once.select(natural_key, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*snapshot.columns)


def _not_after(column: str, effective: str) -> Column:
    late = F.raise_error(F.lit(f"effective date {effective} is before the start of a current version"))
    return F.when(F.col(column) <= F.lit(effective).cast("date"), F.col(column)).otherwise(late)


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    natural_key: str,
    effective: str,
    close_missing: bool = False,
) -> DataFrame:
    """K6: the whole new history after a snapshot takes effect.

    A current row whose attributes differ from the snapshot is closed on the effective date and
    followed by a new current row; unknown natural keys start one. Keys missing from the
    snapshot stay current unless close_missing. Merging the same snapshot again changes nothing; another snapshot of
    the same day replaces the versions that began on it.
    The job fails on a NULL or repeated key in the snapshot and on an effective date before a current version's start.
    """
    attributes = [c for c in snapshot.columns if c != natural_key]
    current = history.where("is_current").withColumn("effective_from", _not_after("effective_from", effective)).alias("o")
    incoming = _one_per_key(snapshot, natural_key).withColumn("_seen", F.lit(True)).alias("n")
    same = F.lit(True)
    for a in attributes:
        same = same & F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}"))
    pairs = current.join(incoming, F.col(f"o.{natural_key}") == F.col(f"n.{natural_key}"), "full").select(
        F.struct("o.*").alias("o"),
        F.struct(*[F.col(f"n.{c}").alias(c) for c in snapshot.columns]).alias("n"),
        F.coalesce("o.is_current", F.lit(False)).alias("known"),
        F.coalesce("n._seen", F.lit(False)).alias("seen"),
        same.alias("same"),
    )
    changed = F.col("known") & F.col("seen") & ~F.col("same")
    # A version that would end on its first day gives way to the new one, so that (member, first day) names one version.
    replaced = changed & (F.col("o.effective_from") == F.lit(effective).cast("date"))
    closed = changed | (F.col("known") & ~F.col("seen") & F.lit(close_missing))
    new_from = F.lit(effective).cast("date")
    old_row = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in snapshot.columns],
        F.col("o.effective_from").alias("effective_from"),
        F.when(closed, new_from).otherwise(F.col("o.effective_to")).alias("effective_to"),
        (~closed).alias("is_current"),
    )
    new_row = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in snapshot.columns],
        new_from.alias("effective_from"),
        F.lit(FOREVER).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    versions = F.array_compact(
        F.array(
            F.when(F.col("known") & ~replaced, old_row),
            F.when(changed | ~F.col("known"), new_row),
        )
    )
    merged = pairs.select(F.inline(versions))
    past = history.where(~F.col("is_current")).select(*merged.columns)
    return past.unionByName(merged)


def scd2_backdate(history: DataFrame, corrections: DataFrame, natural_key: str) -> DataFrame:
    """K6: the history with attributes that are learned late; `corrections` has the key, attributes and effective_from.

    A correction begins a version on its date, which lasts as long as the one it falls into, or up to the next; a version
    that begins on the same date gets the corrected attributes. Outside all versions it lasts up to the next one. The job
    fails on NULL or repeated (key, date) in the corrections. Versions of one member are taken to be few.
    """
    place = [natural_key, "effective_from"]
    attributes = [c for c in corrections.columns if c not in place]
    present = [F.coalesce(c, F.raise_error(F.lit(f"NULL in {c} of a correction"))).alias(c) for c in place]
    told = _refuse_repeats(corrections.select(*present, F.struct(*attributes).alias("_new")), place)
    known = history.select(*place, F.struct(*attributes).alias("_old"), "effective_to")
    both = known.join(told, place, "full")
    in_order = Window.partitionBy(natural_key).orderBy("effective_from")
    before = F.last("effective_to", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    split = F.when(before > F.col("effective_from"), before)
    last_day = F.coalesce("effective_to", split, F.lit(FOREVER).cast("date"))
    dated = both.withColumn("_to", F.least(last_day, F.lead("effective_from").over(in_order)))
    chosen = F.coalesce("_new", "_old")
    rows = dated.select(
        *place,
        *[chosen.getField(c).alias(c) for c in attributes],
        F.col("_to").alias("effective_to"),
        (F.col("_to") == F.lit(FOREVER).cast("date")).alias("is_current"),
    )
    return rows.select(*history.columns)


def changed_spans(before: DataFrame, after: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Members and intervals [starts, ends) in which another version is valid after a change of the history than before.

    Versions that both have drop out in one grouping, so that only those of members that changed go on.
    """
    columns = [natural_key, "effective_from", "effective_to", key]
    sides = [side.select(*columns, F.lit(sign).alias("_sign")) for side, sign in ((before, -1), (after, 1))]
    differing = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_sign").alias("_sign")).where("_sign <> 0")
    listed = differing.groupBy(natural_key).agg(
        F.collect_list(F.struct("effective_from", "effective_to", F.col(key).alias("key"), "_sign")).alias("_versions")
    )
    edges = F.concat(F.col("_versions.effective_from"), F.col("_versions.effective_to"))
    cut = listed.withColumn("_cuts", F.array_sort(F.array_distinct(edges)))
    rest = F.size("_cuts") - 1
    pairs = F.arrays_zip(F.slice("_cuts", 1, rest).alias("starts"), F.slice("_cuts", 2, rest).alias("ends"))
    spans = cut.select(natural_key, "_versions", F.inline(pairs).alias("starts", "ends"))

    def valid(sign: int) -> Column:
        starts = F.col("starts")
        inside = F.filter(
            "_versions", lambda v: (v["_sign"] == sign) & (v["effective_from"] <= starts) & (starts < v["effective_to"])
        )
        return F.get(inside, F.lit(0)).getField("key")

    return spans.where(~valid(-1).eqNullSafe(valid(1))).select(natural_key, "starts", "ends")


def scd1_merge(dimension: DataFrame, snapshot: DataFrame, natural_key: str) -> DataFrame:
    """K7: snapshot rows replace those with the same natural key; the others stay."""
    kept = dimension.join(snapshot.select(natural_key), natural_key, "left_anti")
    return kept.unionByName(snapshot)
