"""Runs that go on where an earlier attempt broke off, and removal of attempts nobody needs.

Every attempt of a run has a row in `<root>/attempts` from its start on, and a row in `<folder>/steps` for each step that
finished. A run asked to resume takes up the newest unpublished attempt of its name whose inputs and options were the same.
Inputs are the same when the fingerprint of each table is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.sources.tables import delete_path, literal_table, read_table

RUN_SCHEMA = "run_id string, folder string, tables map<string, string>, finished_at timestamp"
ATTEMPT_SCHEMA = "run_id string, folder string, inputs string, started_at timestamp"
STEP_SCHEMA = "step string, tables map<string, string>"
LEASE_SCHEMA = "folder string, until timestamp"


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n_rows, sum_a, sum_b. It doesn't depend on the order or partitions of the rows, but on their number.

    Two hashes of each row, NULLs told apart from each other and from values, are added up exactly; one pass with partial sums.
    Equal rows count as often as they come. An empty table has sums of 0.
    """
    of_row = [c for name in sorted(df.columns) for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]

    def total(first: str) -> Any:
        return F.coalesce(F.sum(F.xxhash64(F.lit(first), *of_row).cast("decimal(28,0)")), F.lit(0))

    return df.agg(F.count("*").alias("n_rows"), total("a").alias("sum_a"), total("b").alias("sum_b"))


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name and fingerprint of each table."""
    each = [fingerprint(df).select(F.lit(name).alias("table_name"), "n_rows", "sum_a", "sum_b") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each)


def inputs_digest(tables: Mapping[str, DataFrame], options: Mapping[str, Any]) -> str:
    """What a run's results depend on: rows, columns and types of each table, and the options."""
    found = sorted(tuple(map(str, row)) for row in fingerprints(tables).collect())  # one row a table
    columns = sorted((name, sorted(df.dtypes)) for name, df in tables.items())
    return hashlib.sha256(json.dumps([found, columns, sorted(options.items())], default=str).encode()).hexdigest()


def rows_if_any(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the driver's own notes; empty if nothing was noted yet."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_table(spark, [], schema)


def _note(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    literal_table(spark, [row], schema).coalesce(1).write.mode("append").parquet(path)


class Attempt:
    """A folder that one attempt of a run writes to, and the steps it has finished."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self.folder = spark, folder
        self._done = {row["step"]: row["tables"] for row in rows_if_any(spark, f"{folder}/steps", STEP_SCHEMA).collect()}

    def step(self, name: str, write: Callable[[], dict[str, str]]) -> dict[str, str]:
        """The tables of a step, written only if this attempt hasn't finished it. Half-written ones are replaced."""
        if name not in self._done:
            self._done[name] = write()
            _note(self._spark, f"{self.folder}/steps", (name, self._done[name]), STEP_SCHEMA)
        return self._done[name]


def start_attempt(spark: SparkSession, root: str, run_id: str, inputs: str | None = None) -> Attempt:
    """A new attempt, or, if `inputs` are given, the newest unpublished one of this run that had the same.

    Only one run of a name may be under way when it resumes.
    """
    tried = rows_if_any(spark, f"{root}/attempts", ATTEMPT_SCHEMA)
    if inputs is not None:
        published = rows_if_any(spark, f"{root}/runs", RUN_SCHEMA).select("folder")
        open_ones = tried.where((F.col("run_id") == run_id) & (F.col("inputs") == inputs)).join(published, "folder", "left_anti")
        last = open_ones.orderBy(F.desc("started_at")).first()
        if last is not None:
            return Attempt(spark, last["folder"])
    folder = f"{root}/{run_id}/{uuid.uuid4().hex}"
    _note(spark, f"{root}/attempts", (run_id, folder, inputs, datetime.now()), ATTEMPT_SCHEMA)
    return Attempt(spark, folder)


def lease(spark: SparkSession, root: str, folder: str, until: datetime) -> None:
    """Keep an attempt's folder from being swept until that time. Taken before reading its tables."""
    _note(spark, f"{root}/leases", (folder, until), LEASE_SCHEMA)


def unneeded(spark: SparkSession, root: str, before: datetime, keep: int = 1, holding: Sequence[str] = ("student_history",)) -> list[Row]:
    """(folder, run_id) of the attempts a sweep removes: started before a time, not leased, and not needed.

    Needed are the last `keep` published attempts of each run and the last that holds one of the tables in `holding`, from
    which later runs go on. An unpublished attempt is needed until `before`, so choose that earlier than any run under way.
    """
    if keep < 1:
        raise ValueError("keep at least one attempt of each run")
    runs = rows_if_any(spark, f"{root}/runs", RUN_SCHEMA).collect()  # one row per run and attempt, no data
    leased = {r["folder"] for r in rows_if_any(spark, f"{root}/leases", LEASE_SCHEMA).where(F.col("until") > F.current_timestamp()).collect()}
    needed, seen = set(leased), dict.fromkeys((r["run_id"] for r in runs), 0)
    missing = set(holding)
    for run in sorted(runs, key=lambda r: r["finished_at"], reverse=True):
        held = missing & run["tables"].keys()
        if seen[run["run_id"]] < keep or held:
            needed.add(run["folder"])
        seen[run["run_id"]] += 1
        missing -= held
    tried = rows_if_any(spark, f"{root}/attempts", ATTEMPT_SCHEMA).where(F.col("started_at") < F.lit(before))
    return [row for row in tried.select("folder", "run_id").distinct().collect() if row["folder"] not in needed]


def sweep(spark: SparkSession, root: str, before: datetime, keep: int = 1) -> list[str]:
    """Remove the folders of `unneeded` attempts, and nothing outside `<root>/<run id>`; returns them."""
    gone = []
    for row in unneeded(spark, root, before, keep):
        if row["folder"].rpartition("/")[0] != f"{root}/{row['run_id']}":
            continue  # noted below another root, such as a copy's
        delete_path(spark, row["folder"])
        gone.append(row["folder"])
    return sorted(gone)
