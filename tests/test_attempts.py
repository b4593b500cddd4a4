"""Runs that go on after a failure, fingerprints, and what a sweep removes."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from school import district

import __spark_entry__ as driver
from schoolmetrics.plans import attempts, pipeline
from schoolmetrics.sources.tables import read_table


def unique() -> dict[str, list[dict]]:
    data = district(5)
    return {**data, "users": data["users"][:40]}  # ids of a dimension are unique


def stamps(folder: str) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet") if p.parent.name != "steps"}


def one(df) -> tuple:
    return tuple(attempts.fingerprint(df).first())


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (None, "b")], "x int, `y.z` string")
    assert one(df) == one(df.repartition(3).select("`y.z`", "x"))
    assert one(df)[1:] != one(df.distinct())[1:]
    assert one(df) != one(df.withColumn("x", F.coalesce("x", F.lit(7))))
    twisted = "a string, b string"
    assert one(spark.createDataFrame([("u", None)], twisted)) != one(spark.createDataFrame([(None, "u")], twisted))
    pairs = [spark.createDataFrame(r, twisted) for r in ([("u", "v"), ("w", "t")], [("u", "t"), ("w", "v")])]
    assert one(pairs[0]) != one(pairs[1])
    assert one(df.where("x > 9")) == (0, 0, 0)


@pytest.fixture
def fails(monkeypatch):
    """Break the star schema off after its first tables, as long as the list has entries."""
    left, write = [], pipeline._stored

    def stored(df, path):
        if left and path.endswith("dim_course"):
            left.pop()
            raise OSError("no space")
        return write(df, path)

    monkeypatch.setattr(pipeline, "_stored", stored)
    return left


def test_a_run_goes_on_after_its_last_step(spark, make, rows, tmp_path, fails):
    tables, root = make(**unique()), str(tmp_path / "res")
    fails.append(1)
    with pytest.raises(OSError, match="no space"):
        pipeline.materialize(spark, tables, root, "r1", with_star=True, resume=True)
    with pytest.raises(LookupError):
        pipeline.latest_run(spark, root)
    (folder,) = (str(p) for p in (tmp_path / "res" / "r1").iterdir())
    before = stamps(folder)
    written = pipeline.materialize(spark, tables, root, "r1", with_star=True, resume=True)
    after = stamps(folder)
    assert pipeline.latest_run(spark, root) == folder
    assert {p: t for p, t in after.items() if "/star/" not in p and p in before} == {p: t for p, t in before.items() if "/star/" not in p}
    whole = pipeline.materialize(spark, tables, root, "r1", with_star=True)
    assert written.keys() == whole.keys() and pipeline.latest_run(spark, root) != folder
    for name in whole:
        assert rows(read_table(spark, written[name])) == rows(read_table(spark, whole[name])), name


def test_changed_inputs_or_options_begin_anew(spark, make, tmp_path, fails):
    tables, root = make(**unique()), str(tmp_path)
    fails += [1, 1, 1]
    changed = {**tables, "grades": tables["grades"].withColumn("grade", F.lit("F"))}
    for source, options in ((tables, {}), (changed, {}), (tables, {"mean": "decimal"})):
        with pytest.raises(OSError, match="no space"):
            pipeline.materialize(spark, source, root, "r1", with_star=True, resume=True, **options)
    assert len([p for p in (tmp_path / "r1").iterdir()]) == 3
    with pytest.raises(ValueError, match="monthly"):
        pipeline.materialize(spark, tables, root, "r1", monthly=f"{root}/months", resume=True)


def test_sweep_keeps_what_is_read_or_needed(spark, make, tmp_path):
    root, later = str(tmp_path), datetime.now() + timedelta(days=1)
    tried = [attempts.start_attempt(spark, root, "a") for _ in range(5)]
    other = attempts.start_attempt(spark, root, "b")
    for attempt in (*tried, other):
        attempt.step("s", lambda a=attempt: {"t": spark.range(3).write.parquet(f"{a.folder}/t") or f"{a.folder}/t"})
    for i, table in ((0, "student_history"), (1, "t"), (2, "t"), (3, "t")):
        row = ("a", tried[i].folder, {table: "x"}, datetime(2024, 1, 1 + i))
        attempts._note(spark, f"{root}/runs", row, attempts.RUN_SCHEMA)
    assert attempts.sweep(spark, root, datetime(2020, 1, 1)) == []  # nothing is that old
    attempts.lease(spark, root, tried[1].folder, later)
    attempts.lease(spark, root, tried[2].folder, datetime(2024, 1, 1))
    reader = read_table(spark, f"{tried[1].folder}/t")
    # Kept: the last with history, the leased one, the last of the run. Gone: a lapsed lease, and both that broke off.
    gone = sorted(a.folder for a in (tried[2], tried[4], other))
    assert attempts.sweep(spark, root, later) == gone
    assert [Path(f).exists() for f in gone] == [False] * 3
    assert reader.count() == 3 and Path(tried[0].folder).exists() and Path(tried[3].folder).exists()
    with pytest.raises(ValueError, match="at least one"):
        attempts.sweep(spark, root, later, keep=0)


def test_moved_rows_take_as_many_tasks_as_the_session_says(spark, monkeypatch):
    """Rows in another order were once dealt over seven tasks, however many rows there are."""
    plans, found = [], attempts.fingerprints

    def seen(source):
        plans.extend(df._jdf.queryExecution().toString() for df in source.values())
        return found(source)

    monkeypatch.setattr(attempts, "fingerprints", seen)
    driver.queries()["S7_fingerprints"](spark, SF_DIR)
    moved = [line for plan in plans for line in plan.splitlines() if "RepartitionByExpression" in line]
    assert moved and not any(line.rstrip().endswith(", 7") for line in moved)
