"""Text shown beside chart marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a blank between words (Unicode spaces and the four separators).
_BLANK = r"\s\x1c-\x1f"


def short_name(name: Column) -> Column:
    """Last word of a name, '&' taken as a blank; '' for blank or NULL, the name itself if only '&'."""
    last = F.regexp_extract(F.translate(name, "&", " "), rf"(?U)([^{_BLANK}]+)[{_BLANK}]*$", 1)
    blank = name.isNull() | ~name.rlike(rf"(?U)[^{_BLANK}]")
    return F.when(blank, F.lit("")).when(last == "", name).otherwise(last)


def fixed(value: Column, decimals: int) -> Column:
    """printf-style '%.<decimals>f': ties are settled on the exact binary value, then half-even."""
    zeros = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", value.cast("double"), F.lit(zeros))


def whole(value: Column) -> Column:
    """printf-style '%d'."""
    return value.cast("bigint").cast("string")


def percent(n: Column, total: Column) -> Column:
    """Share of a pie wedge with one decimal and a percent sign."""
    return F.concat(fixed(n.cast("double") * 100 / total, 1), F.lit("%"))
