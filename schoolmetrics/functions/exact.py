"""Means and shares from whole-number sums: one rounding step, same result on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from schoolmetrics.functions.scales import GradeScale


def mean_points(tenths: Column, n: Column, scale: GradeScale, form: str = "double") -> Column:
    """Mean grade points from a sum of tenths and a count; NULL when the count is 0 or NULL.

    `form="decimal"` gives the type and the five decimals of Spark's AVG over the scale's decimals.
    """
    divisor = F.nullif(n * 10, F.lit(0))
    if form == "double":
        return tenths.cast("double") / divisor
    if form == "decimal":
        return (tenths.cast("decimal(20,0)") / divisor.cast("decimal(20,0)")).cast(scale.mean_type)
    raise ValueError(f"form must be 'double' or 'decimal', not {form!r}")


def share(n: Column, total: Column, form: str = "double") -> Column:
    """n as a percentage of total, rounded half up to two decimals."""
    hundredths = F.call_function("div", n * 20000 + total, total * 2)
    if form == "double":
        return hundredths.cast("double") / 100
    if form == "decimal":
        return (hundredths.cast("decimal(25,0)") / F.lit(100)).cast("decimal(27,2)")
    raise ValueError(f"form must be 'double' or 'decimal', not {form!r}")
