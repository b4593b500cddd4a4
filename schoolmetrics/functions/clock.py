"""Moving between wall-clock timestamps and instants, taking the wall clock as UTC.

Streams need an instant as event time while the tables hold wall-clock times. Going through
UTC fields keeps results independent of the session time zone and of its clock changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_instant(wall: Column) -> Column:
    """TIMESTAMP_NTZ to TIMESTAMP."""
    fields = [part(wall) for part in (F.year, F.month, F.day, F.hour, F.minute)]
    return F.make_timestamp(*fields, F.extract(F.lit("SECOND"), wall), F.lit("UTC"))


def as_wall_clock(instant: Column) -> Column:
    """TIMESTAMP to TIMESTAMP_NTZ."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
