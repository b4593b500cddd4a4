"""References and ids of the entity tables: what points nowhere, what comes twice, and what becomes of it.

Keys are never enforced where the rows come from. Each relation is counted by key before it meets its parent, so an id
that holds a third of the rows is one row by then, and what crosses the network are distinct ids.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from schoolmetrics.schemas import ENTITIES

Entities = Mapping[str, DataFrame]

# Column of an entity, and the entity whose id it holds.
RELATIONS: dict[tuple[str, str], str] = {
    ("users", "school_id"): "schools",
    ("courses", "teacher_id"): "users",
    ("courses", "school_id"): "schools",
    ("contents", "course_id"): "courses",
    ("contents", "teacher_id"): "users",
    ("homeworks", "course_id"): "courses",
    ("homeworks", "student_id"): "users",
    ("grades", "course_id"): "courses",
    ("grades", "student_id"): "users",
    ("adjustments", "course_id"): "courses",
    ("adjustments", "student_id"): "users",
}

#: Key of the member that stands for all that a dimension lacks.
UNKNOWN = -1


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphans(entities: Entities) -> DataFrame:
    """entity, column_name, missing_id and n_rows of every reference to an id that isn't there; NULL points nowhere."""

    def of(entity: str, column: str, parent: str) -> DataFrame:
        used = entities[entity].groupBy(F.col(column).alias("missing_id")).agg(F.count("*").alias("n_rows"))
        known = entities[parent].select(F.col("id").alias("missing_id"))
        return used.join(known, "missing_id", "left_anti").select(
            F.lit(entity).alias("entity"), F.lit(column).alias("column_name"), "missing_id", "n_rows"
        )

    return _union([of(entity, column, parent) for (entity, column), parent in RELATIONS.items()])


def repeated_ids(entities: Entities) -> DataFrame:
    """entity, id and n_rows of every id, NULL included, that an entity holds more than once."""
    counts = [
        entities[name].groupBy("id").agg(F.count("*").alias("n_rows")).where("n_rows > 1").select(F.lit(name).alias("entity"), "id", "n_rows")
        for name in ENTITIES
    ]
    return _union(counts)


def _flagged(df: DataFrame, entity: str, missing: DataFrame) -> DataFrame:
    """Rows with `_broken`, the names of their columns that point nowhere, by one join for each column with orphans."""
    broken: list[Column] = []
    for column in [c for e, c in RELATIONS if e == entity]:
        ids = missing.where((F.col("entity") == entity) & (F.col("column_name") == column))
        ids = ids.select(F.col("missing_id").alias(column), F.lit(column).alias(f"_no_{column}"))
        df = df.join(ids, column, "left")
        broken.append(F.when(F.col(column).isNull(), F.lit(column)).otherwise(F.col(f"_no_{column}")))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("_broken", names)


def quarantined(entities: Entities) -> tuple[dict[str, DataFrame], DataFrame]:
    """The entities without rows that point nowhere, and those rows: entity, id, columns and the whole row as JSON.

    One level is looked at: a row that points to a quarantined row stays, so that nothing vanishes in a chain; call it
    again on the result to go on. Every row is in exactly one of the two.
    """
    missing = orphans(entities)
    good, bad = dict(entities.items()), []
    for name in ENTITIES:
        if not any(entity == name for entity, _ in RELATIONS):
            continue
        columns = entities[name].columns
        rows = _flagged(entities[name], name, missing)
        good[name] = rows.where(F.size("_broken") == 0).select(columns)
        row = F.to_json(F.struct(*columns)).alias("row")
        bad.append(rows.where(F.size("_broken") > 0).select(F.lit(name).alias("entity"), "id", F.col("_broken").alias("columns"), row))
    return good, _union(bad)


def with_unknown_member(dimension: DataFrame, key: str) -> DataFrame:
    """A dimension with one member more, its key UNKNOWN, for facts whose own member is missing."""
    first = dimension.sparkSession.range(1)
    row = first.select(
        *[F.lit(UNKNOWN if f.name == key else None).cast(f.dataType).alias(f.name) for f in dimension.schema.fields]
    )
    return row.unionByName(dimension)


def pointed_to_unknown(fact: DataFrame, *keys: str) -> DataFrame:
    """A fact whose missing keys are UNKNOWN, so that inner joins with dimensions lose no row."""
    return fact.withColumns({key: F.coalesce(F.col(key), F.lit(UNKNOWN).cast(fact.schema[key].dataType)) for key in keys})


class SchemaMismatch(ValueError):
    """Files of a table don't hold what its schema declares."""


def schema_differences(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S3: where the files of a table differ from its declared schema, with how many rows that concerns.

    `missing`: rows of files without a single value in a required column, or all rows if no file has a declared column.
    `extra`: values of columns that aren't declared. `retyped`: all rows, if files hold another type. Footers of all files
    are read, and the required and undeclared columns once, counted by file. Files whose types contradict each other
    can't be read as one table; the error names the column.
    """
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    held = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    required = [f.name for f in schema.fields if not f.nullable and f.name in held]
    counted = required + [c for c in held if c not in declared]
    by_file = stored.groupBy(F.col("_metadata.file_path")).agg(
        F.count("*").alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(counted)]
    )

    def finding(column: str, problem: str, rows: Column) -> Column:
        kinds = [F.lit(kinds.get(column)).cast("string") for kinds in (declared, held)]
        total = F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows")
        return F.struct(F.lit(column).alias("column_name"), F.lit(problem).alias("problem"),
                        kinds[0].alias("declared"), kinds[1].alias("found"), total)

    everywhere = [finding(c, "missing", F.col("n")) for c in declared if c not in held]
    everywhere += [finding(c, "retyped", F.col("n")) for c in declared if c in held and held[c] != declared[c]]
    everywhere += [finding(c, "extra", F.col(f"v{i}")) for i, c in enumerate(counted) if c not in declared]
    somewhere = [finding(c, "missing", F.when(F.col(f"v{i}") == 0, F.col("n"))) for i, c in enumerate(required)]
    no_finding = F.array().cast("array<struct<column_name string, problem string, declared string, found string, n_rows bigint>>")
    listed = by_file.agg(
        F.concat(no_finding, F.array(*everywhere) if everywhere else no_finding,
                 F.filter(F.array(*somewhere), lambda x: x["n_rows"] > 0) if somewhere else no_finding).alias("findings")
    )
    return listed.select(F.inline("findings"))


def refuse_schema_differences(spark: SparkSession, root: str) -> None:
    """S3: raise by name for entity tables whose files lack or retype a declared column; undeclared ones are let be."""
    wrong = []
    for entity, schema in ENTITIES.items():
        found = schema_differences(spark, f"{root}/{entity}", schema).where("problem <> 'extra'").collect()  # a row a column
        optional = {f.name for f in schema.fields if f.nullable}
        wrong += [
            f"{entity}.{r.column_name} {r.problem} in {r.n_rows} rows (declared {r.declared}, found {r.found})"
            for r in found
            if r.problem == "retyped" or r.column_name not in optional
        ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
