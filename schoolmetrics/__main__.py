"""Run the pipeline over stored entity tables: `spark-submit` or `python -m schoolmetrics`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from schoolmetrics.plans.pipeline import materialize
from schoolmetrics.sources.integrity import refuse_schema_differences
from schoolmetrics.sources.tables import read_entities, register_views


def main(argv: Sequence[str] | None = None) -> dict[str, str]:
    """Write the result tables and return their paths."""
    parser = argparse.ArgumentParser(prog="schoolmetrics", description=main.__doc__)
    parser.add_argument("entities", help="folder with one Parquet table per entity")
    parser.add_argument("results", help="folder the run is written below")
    parser.add_argument("run_id", help="name of the run; a later run of that name takes its place")
    parser.add_argument("--ml", action="store_true", help="also write student features and models")
    parser.add_argument("--star", action="store_true", help="also write dimensions, facts and KPIs")
    parser.add_argument("--fact-partition", choices=["date_key", "month_key", "school_key"], default="date_key")
    parser.add_argument("--holidays", nargs="*", default=[], metavar="YYYY-MM-DD", help="days marked in the calendar")
    parser.add_argument("--partitions", type=int, help="parts of the model input; by default from the number of students")
    parser.add_argument("--mean", choices=["double", "decimal"], default="double", help="type of means and shares")
    parser.add_argument("--monthly", help="folder of monthly roll-ups that runs share; reports add them up")
    parser.add_argument("--months", nargs="*", type=int, metavar="YYYYMM", help="months that changed; by default all are made anew")
    parser.add_argument("--effective", metavar="YYYY-MM-DD", help="day the delivery takes effect; keys and history go on from earlier runs")
    parser.add_argument("--resume", action="store_true", help="go on after the finished steps of a try with equal inputs")
    parser.add_argument("--check-files", action="store_true", help="first refuse files that lack or retype a declared column")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("schoolmetrics").getOrCreate()
    if args.check_files:
        refuse_schema_differences(spark, args.entities)
    source = read_entities(spark, args.entities)
    register_views(source)
    return materialize(
        spark,
        source,
        args.results,
        args.run_id,
        ml=args.ml,
        mean=args.mean,
        partitions=args.partitions,
        with_star=args.star,
        fact_partition=args.fact_partition,
        holidays=args.holidays,
        monthly=args.monthly,
        months=args.months,
        effective=args.effective,
        resume=args.resume,
    )


if __name__ == "__main__":
    for name, path in main().items():
        print(f"{name}\t{path}")
