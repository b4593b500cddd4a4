from __future__ import annotations

from datetime import date, datetime, timedelta

from pathlib import Path

from pyspark.sql.types import StructType

from schoolmetrics.streaming import content_access
from schoolmetrics.streaming.content_access import (
    access_counts,
    compact,
    count_days,
    event_stream,
    fact_content_access,
    read_log,
    run_access_counts,
    run_access_log,
    store_batch,
)

SCHEMA = "ts timestamp_ntz, student_id string, content_id string, access_type string"
START = datetime(2024, 1, 1, 12)


def _write(spark, path, hours):
    data = [(START + timedelta(hours=h), f"U{h % 3}", f"D{h % 2}", "view") for h in hours]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_files_out_of_order_lose_nothing(spark, tmp_path, rows):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    total = 0
    for hours in (range(216, 240), range(48, 60), range(264, 280), range(0, 5)):
        _write(spark, folder, hours)
        total += len(hours)
        run_access_log(event_stream(spark, folder, SCHEMA), out, state).awaitTermination()
        log = spark.read.parquet(out)
        assert log.count() == total
        assert rows(access_counts(log)) == rows(access_counts(spark.read.parquet(folder)))
    # The last window is still open, and there.
    assert access_counts(log).agg({"access_count": "sum", "window_start": "max"}).first()[0] is not None
    assert sum(r["access_count"] for r in access_counts(log).collect()) == total


def test_log_is_a_plain_table_by_day(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    _write(spark, folder, range(0, 30))
    run_access_log(event_stream(spark, folder, SCHEMA), out, state).awaitTermination()
    days = [r[0] for r in spark.read.parquet(out).select("access_date").distinct().orderBy("access_date").collect()]
    assert days == [date(2024, 1, 1), date(2024, 1, 2)]


def test_fact_keeps_accesses_without_a_dimension_row(spark, rows):
    data = [(START, "U1", "D1", "view"), (START, "U1", "D1", "view"), (START, "U9", "D1", "view"), (START, None, "D9", "open")]
    dims = {
        "dim_student": spark.createDataFrame([("U1", 7)], "student_id string, student_key int"),
        "dim_content": spark.createDataFrame([("D1", 3)], "content_id string, content_key int"),
    }
    got = fact_content_access(spark.createDataFrame(data, SCHEMA), dims).collect()
    assert sorted(tuple(r) for r in got if r.student_key) == [(7, 3, 20240101, "view", 2)]
    assert sorted((r.content_key or 0, r.access_type, r.access_count) for r in got if not r.student_key) == [(0, "open", 1), (3, "view", 1)]


def _columns() -> StructType:
    return StructType.fromDDL(SCHEMA)


def test_changed_days_are_counted_anew_and_small_files_merged(spark, tmp_path, rows, monkeypatch):
    folder, log, counts, state = (str(tmp_path / n) for n in ("in", "log", "counts", "state"))
    wanted = ["window_start", "window_end", "content_id", "access_type", "access_count"]

    def agree():
        stored = spark.read.parquet(counts).select(*wanted)
        every = spark.read.parquet(folder)
        assert rows(stored) == rows(access_counts(every))
        assert read_log(spark, log, _columns()).count() == every.count()

    def days() -> dict[str, int]:
        return {str(p): p.stat().st_mtime_ns for p in Path(counts).rglob("*.parquet")}

    def run():
        run_access_counts(event_stream(spark, folder, SCHEMA, per_batch=1), log, counts, state).awaitTermination()

    for hours in (range(0, 30), range(20, 40), range(5, 8)):
        _write(spark, folder, hours)
    run()
    agree()
    before = days()
    _write(spark, folder, range(60, 61))  # a day of its own
    run()
    agree()
    assert all(days().get(p) == t for p, t in before.items())

    # A batch that comes again replaces itself, in the log and in the counts.
    again = spark.read.schema(SCHEMA).parquet(f"{log}/batches/batch_id=0")
    kept = spark.createDataFrame(again.drop("access_date").collect(), _columns())
    touched = store_batch(kept, 0, log)
    count_days(spark, log, counts, _columns(), touched)
    agree()

    # A merge that is cut short before it is listed is not read.
    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(content_access, "literal_table", fail)
        try:
            compact(spark, log, _columns(), least=2)
        except RuntimeError:
            pass
    agree()
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    assert sorted(compact(spark, log, _columns(), least=2)) == [first, second]
    agree()
    assert compact(spark, log, _columns(), least=2) == []
    files = [p for p in Path(log).rglob("*.parquet") if f"access_date={first}" in str(p)]
    assert len(files) == 1
    # Later batches add to merged days, and merge again.
    for hours in (range(1, 3), range(3, 5), range(62, 63)):
        _write(spark, folder, hours)
    run()
    agree()
    assert compact(spark, log, _columns(), least=2) == [first]
    agree()
    assert [p.parent.name for p in Path(log).glob(f"days/*/access_date={first}")] == ["upto=5"]


def test_empty_stream_and_accesses_without_a_time(spark, tmp_path):
    folder, log, counts, state = (str(tmp_path / n) for n in ("in", "log", "counts", "state"))
    spark.createDataFrame([(None, "U1", "D1", "view"), (START, "U1", "D1", "view")], SCHEMA).write.parquet(folder)
    run_access_counts(event_stream(spark, folder, SCHEMA), log, counts, state).awaitTermination()
    assert read_log(spark, log, _columns()).count() == 2
    assert spark.read.parquet(counts).agg({"access_count": "sum"}).first()[0] == 1
    assert compact(spark, log, _columns()) == []
