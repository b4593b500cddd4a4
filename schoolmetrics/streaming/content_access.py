"""Content accesses from an event stream.

The stream appends one row per access to a table partitioned by day. It keeps no state, so no event is ever too late and
there is nothing that outgrows memory; offsets see to it that each file is taken once. Counts per window and the fact table
are batch aggregations over that table: late rows and windows still open are in them.

`run_access_counts` keeps counts up to date instead: each micro-batch is stored in a folder of its own, so that a batch that
comes again replaces itself, and only the days it touches are counted anew. `compact` merges the small files of days that
many batches brought. Layout of such a log: `batches/batch_id=N/access_date=D`, `days/upto=N/access_date=D` (all batches up
to N) and `compacted`, the list of finished merges. A merge counts from its line in that list on, so one that was cut short
is not read. One stream and one compaction, not at the same time, may write a log; log and checkpoint belong together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from schoolmetrics.functions.clock import as_instant, as_wall_clock
from schoolmetrics.operators.star import date_key
from schoolmetrics.sources.tables import delete_path, literal_table, path_exists, read_table


COMPACTED = "access_date date, upto long"


def event_stream(
    spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream, `per_batch` files at a time if given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader if per_batch is None else reader.option("maxFilesPerTrigger", per_batch)).parquet(folder)


def _event_time(events: DataFrame) -> Column:
    ts = F.col("ts")
    return as_instant(ts) if dict(events.dtypes)["ts"] == "timestamp_ntz" else ts


def access_log(events: DataFrame) -> DataFrame:
    """The accesses with their day (UTC); `events` has ts and whatever names the access, streaming or not."""
    return events.withColumn("access_date", as_wall_clock(_event_time(events)).cast("date"))


def run_access_log(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the accesses of a stream to a Parquet table by day until the available input is used up.

    Offsets live in `checkpoint`, so a restarted run goes on where it stopped.
    """
    return (
        access_log(events)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("access_date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def access_counts(accesses: DataFrame, window: str = "1 day") -> DataFrame:
    """Accesses per time window (UTC), content and kind of access; all windows, closed or not."""
    return (
        accesses.withColumn("ts", _event_time(accesses))
        .groupBy(F.window("ts", window).alias("w"), "content_id", "access_type")
        .agg(F.count("*").alias("access_count"))
        .select(
            as_wall_clock(F.col("w.start")).alias("window_start"),
            as_wall_clock(F.col("w.end")).alias("window_end"),
            "content_id",
            "access_type",
            "access_count",
        )
    )


def fact_content_access(accesses: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Accesses per student, content, day and kind, with the keys of dim_student and dim_content.

    Accesses are counted before the keys are joined. An id that a dimension lacks gives a NULL key, and keeps its accesses.
    """
    counted = (
        accesses.groupBy("student_id", "content_id", "access_type", date_key(F.col("ts")).alias("date_key"))
        .agg(F.count("*").alias("access_count"))
        .join(dims["dim_student"].select("student_id", "student_key"), "student_id", "left")
        .join(dims["dim_content"].select("content_id", "content_key"), "content_id", "left")
    )
    keys = ["student_key", "content_key", "date_key", "access_type"]
    return counted.groupBy(*keys).agg(F.sum("access_count").alias("access_count"))


def _stored_as(schema: StructType, marker: str) -> StructType:
    return StructType(list(schema.fields)).add("access_date", "date").add(marker, "long")


def _batches(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    return read_table(spark, f"{log}/batches", _stored_as(schema, "batch_id"))


def _merged_upto(spark: SparkSession, log: str) -> DataFrame:
    """The last batch that is merged, one row per compacted day."""
    if not path_exists(spark, f"{log}/compacted"):
        return spark.createDataFrame([], COMPACTED)
    listed = read_table(spark, f"{log}/compacted", StructType.fromDDL(COMPACTED))
    return listed.groupBy("access_date").agg(F.max("upto").alias("upto"))


def read_log(
    spark: SparkSession, log: str, schema: StructType, days: Sequence[date] | None = None, last: int | None = None
) -> DataFrame:
    """The accesses of a log with access_date, of some days alone, or of batches up to `last`.

    A day comes from its last finished merge and the batches after it. The list of merges has one row per day.
    """
    upto = F.broadcast(_merged_upto(spark, log))
    batches = _batches(spark, log, schema)
    chosen = F.lit(True) if days is None else F.col("access_date").isin(list(days))
    in_time = F.lit(True) if last is None else F.col("batch_id") <= last
    fresh = batches.where(chosen & in_time).join(upto, "access_date", "left")
    rows = fresh.where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))).drop("upto", "batch_id")
    if path_exists(spark, f"{log}/days"):
        merged = read_table(spark, f"{log}/days", _stored_as(schema, "upto"))
        rows = rows.unionByName(merged.where(chosen).join(upto, ["access_date", "upto"]).drop("upto"))
    return rows


def store_batch(batch: DataFrame, batch_id: int, log: str) -> list[date]:
    """Write one micro-batch by day into its own folder, and return its days; again, it replaces what it wrote before."""
    path = f"{log}/batches/batch_id={batch_id}"
    access_log(batch).write.mode("overwrite").partitionBy("access_date").parquet(path)
    days = read_table(batch.sparkSession, path, StructType(list(batch.schema.fields)).add("access_date", "date"))
    found = days.select("access_date").distinct().collect()  # folder names: one a day
    return [r[0] for r in found if r[0] is not None]


def count_days(
    spark: SparkSession, log: str, counts: str, schema: StructType, days: Sequence[date], window: str = "1 day"
) -> None:
    """Count the given days anew and replace their partitions of the counts; windows must not cross days."""
    counted = access_counts(read_log(spark, log, schema, days), window)
    by_day = counted.withColumn("access_date", F.col("window_start").cast("date"))
    writer = by_day.hint("rebalance", "access_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("access_date").parquet(counts)


def run_access_counts(
    events: DataFrame, log: str, counts: str, checkpoint: str, window: str = "1 day"
) -> StreamingQuery:
    """Store the available input batch by batch and count the days that each touches anew.

    A batch that was cut short comes again with the same rows and replaces what it left, in the log and in the counts.
    Accesses without a time are in the log and in no window.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        days = store_batch(batch, batch_id, log)
        if days:
            count_days(batch.sparkSession, log, counts, batch.schema, days, window)

    return (
        events.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, log: str, schema: StructType, least: int = 8) -> list[date]:
    """Merge the batches of days that `least` or more have brought since their last merge; returns these days.

    The last batch stays out, since it may come again. What a merge stands for is deleted after the merge is listed.
    Between runs of the stream.
    """
    parts = _batches(spark, log, schema).select("access_date", "batch_id").distinct()
    last = parts.agg(F.max("batch_id")).first()[0]
    if last is None or last < 1:
        return []
    upto, limit = F.broadcast(_merged_upto(spark, log)), last - 1
    waiting = parts.where(F.col("access_date").isNotNull() & (F.col("batch_id") <= limit)).join(upto, "access_date", "left")
    waiting = waiting.where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto")))
    per_day = waiting.groupBy("access_date", "upto").agg(F.collect_list("batch_id").alias("ids"))
    due = per_day.where(F.size("ids") >= least).collect()  # numbers of the folders that are deleted below
    days = [r["access_date"] for r in due]
    if not days:
        return []
    rows = read_log(spark, log, schema, days, limit).hint("rebalance", "access_date")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("access_date")
    writer.parquet(f"{log}/days/upto={limit}")
    finished = literal_table(spark, [(day, limit) for day in days], COMPACTED)
    finished.coalesce(1).write.mode("append").parquet(f"{log}/compacted")
    for row in due:
        day = f"access_date={row['access_date']}"
        for batch_id in row["ids"]:
            delete_path(spark, f"{log}/batches/batch_id={batch_id}/{day}")
        if row["upto"] is not None:
            delete_path(spark, f"{log}/days/upto={row['upto']}/{day}")
    return days
