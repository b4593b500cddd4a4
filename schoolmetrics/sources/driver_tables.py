"""The seven entities as views over the driver's star-schema tables (FIXTURES.md section 3).

Every row of every source table is kept. Gaps the reports must cope with (students and
teachers without grades, courses without homework) come from shifting keys to a neighbour
and from a few extra rows per nation and region.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from schoolmetrics.schemas import ENTITIES
from schoolmetrics.sources.scratch import scratch_path
from schoolmetrics.sources.tables import LazyTables, read_table, write_table

# The driver tables the entities come from. Declared, so that reading one starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Fixed values of the fixture mapping.
SUBJECTS = [
    "Mathematics", "English Literature", "Science", "History", "Art", "Music",
    "Physical Education", "Computer Science", "Foreign Language",
]
LEVELS = ["101", "102", "201", "202", "301", "302", "AP", "Honors", "Remedial"]
LETTERS = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "F", "P"]
FILE_TYPES = ["pdf", "docx", "pptx", "mp4", "jpg", "zip"]
CONTENT_TYPES = ["lesson", "assignment", "quiz", "video", "image", "resource"]
ACTION_OF_EVENT = {"click": "add", "purchase": "drop", "signup": "switch", "view": "audit", "error": "drop"}
FILE_OF_FLAG = {"A": "pdf", "N": "docx", "R": "txt"}
START = "TIMESTAMP_NTZ '1995-01-01 00:00:00'"

# What grades and homeworks need of line items and their orders.
ITEM_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "o_orderdate", "o_custkey",
]

Table = Callable[[str], DataFrame]


def entities(spark: SparkSession, sf_dir: str, stored: bool = False) -> LazyTables:
    """The seven entity views over the parquet files in sf_dir; each is planned when first asked for.

    With `stored`, line items meet their orders once, when first asked for, and are read from a table below the checkpoint
    folder from then on: for queries that go over grades and homeworks several times.
    """

    def line_items() -> DataFrame:
        joined = _joined_items(table)
        if not stored:
            return joined
        kept = joined.select(*ITEM_COLUMNS)
        return read_table(spark, write_table(kept, scratch_path(spark, "line-items")), kept.schema)

    joins = LazyTables({"line_items": line_items})

    def table(name: str) -> DataFrame:
        if name in joins:
            return joins[name]
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    builders = {
        "users": _users,
        "schools": _schools,
        "courses": _courses,
        "contents": _contents,
        "homeworks": _homeworks,
        "grades": _grades,
        "adjustments": _adjustments,
    }
    return LazyTables({name: lambda build=build: build(table) for name, build in builders.items()})


def _pick(values: list[str], position: str) -> str:
    """Entry at a 0-based position."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({position} AS INT) + 1)"


def _lookup(values: dict[str, str], key: str) -> str:
    branches = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {key} {branches} END"


def _shape(entity: str, df: DataFrame, **columns: str) -> DataFrame:
    """The entity's columns in schema order; those not given are filled in alike for every row."""
    created = columns.get("created_at", START)
    filled = {
        "created_at": created,
        "updated_at": created,
        "is_active": "true",
        "metadata": "'{}'",
        "comments": "CAST(NULL AS STRING)",
        "email": "concat(id, '@school.edu')",
    }
    return df.selectExpr(*[f"{columns.get(n, filled.get(n, n))} AS {n}" for n in ENTITIES[entity].names])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _schools(table: Table) -> DataFrame:
    rows = table("nation").join(table("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return _shape("schools", rows, id="concat('S', n_nationkey)", name="n_name", address="r_name")


def _users(table: Table) -> DataFrame:
    def people(source: str, role: str, uid: str, name: str, school: str) -> DataFrame:
        return table(source).selectExpr(
            f"{uid} AS id", f"{name} AS name", f"'{role}' AS role", f"concat('S', {school}) AS school_id"
        )

    family = "concat('Family ', c_mktsegment, ' ', c_custkey div 10 % 40)"
    everyone = [
        people("supplier", "teacher", "concat('T', s_suppkey)", "s_name", "s_nationkey"),
        people("nation", "teacher", "concat('V', n_nationkey)", "concat('Visiting ', n_name)", "n_nationkey"),
        people("region", "teacher", "concat('W', r_regionkey)", "concat('Substitute ', r_name)", "r_regionkey"),
        people("customer", "student", "concat('U', c_custkey)", "c_name", "c_nationkey"),
        people("nation", "student", "concat('N', n_nationkey)", "concat('Newcomer ', n_name)", "n_nationkey"),
        people("customer", "parent", "concat('P', c_custkey)", family, "c_nationkey"),
        people("nation", "clerk", "concat('K', n_nationkey)", "concat('Clerk ', n_name)", "n_nationkey"),
    ]
    return _shape("users", _union(everyone))


def _courses(table: Table) -> DataFrame:
    own = table("part").selectExpr(
        "concat('C', p_partkey) AS id",
        f"concat({_pick(SUBJECTS, 'p_partkey % 9')}, ' ', {_pick(LEVELS, 'p_partkey div 9 % 9')}) AS name",
        "concat('T', p_partkey div 20) AS teacher_id",
        "concat('S', p_partkey div 20 % 25) AS school_id",
    )
    visiting = table("nation").selectExpr(
        "concat('Y', n_nationkey) AS id",
        "concat('Orientation ', n_name) AS name",
        "concat('V', n_nationkey) AS teacher_id",
        "concat('S', n_nationkey) AS school_id",
    )
    return _shape("courses", _union([own, visiting]))


def _contents(table: Table) -> DataFrame:
    rows = table("documents").selectExpr(
        "doc_id",
        "concat('C', doc_id) AS course_id",
        "CAST(substring(source, 4) AS INT) % 6 AS kind",
    )
    typed = rows.selectExpr("*", f"{_pick(FILE_TYPES, 'kind')} AS file_type", f"{_pick(CONTENT_TYPES, 'kind')} AS stem")
    return _shape(
        "contents",
        typed,
        id="concat('D', doc_id)",
        teacher_id="concat('T', doc_id div 20)",
        file_path="concat('/files/', course_id, '/', stem, '_', doc_id, '.', file_type)",
    )


def _joined_items(table: Table) -> DataFrame:
    """Line items with their order's date and customer."""
    orders = table("orders").selectExpr("o_orderkey AS l_orderkey", "o_orderdate", "o_custkey")
    return table("lineitem").join(orders, "l_orderkey")


def _line_items(table: Table, student_step: int) -> DataFrame:
    """Line items with their order's date and student number.

    Every step-th student's items go to the next one, so that some students have none.
    """
    student = f"CASE WHEN o_custkey % {student_step} = 0 THEN o_custkey + 1 ELSE o_custkey END AS s_no"
    return table("line_items").selectExpr("*", student)


def _grades(table: Table) -> DataFrame:
    position = "(CAST(l_quantity AS INT) - 1) % CASE WHEN s_no % 3 = 1 THEN 6 ELSE 13 END"
    return _shape(
        "grades",
        _line_items(table, 20),
        id="concat('G', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))",
        created_at="o_orderdate",
        course_id="concat('C', CASE WHEN l_partkey div 20 % 10 = 0 THEN l_partkey + 20 ELSE l_partkey END)",
        student_id="concat('U', s_no)",
        grade=_pick(LETTERS, position),
    )


def _homeworks(table: Table) -> DataFrame:
    copies = "explode(sequence(1, CASE WHEN s_no % 3 = 1 THEN 2 ELSE 1 END)) AS copy"
    rows = _line_items(table, 10).selectExpr(
        "*",
        "concat('C', CASE WHEN l_partkey % 25 = 0 THEN l_partkey + 1 ELSE l_partkey END) AS course_id",
        f"{_lookup(FILE_OF_FLAG, 'l_returnflag')} AS file_type",
        copies,
    )
    named = rows.selectExpr(
        "*", "concat('H', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, copy)) AS id"
    )
    return _shape(
        "homeworks",
        named,
        created_at="o_orderdate",
        student_id="concat('U', s_no)",
        file_path="concat('/files/', course_id, '/', id, '.', file_type)",
    )


def _adjustments(table: Table) -> DataFrame:
    return _shape(
        "adjustments",
        table("events"),
        id="concat('A', event_id)",
        created_at="ts",
        student_id="concat('U', user_id)",
        course_id="concat('C', event_id div 5)",
        action=_lookup(ACTION_OF_EVENT, "event_type"),
    )
