"""Wall-clock time functions. On zone-less timestamps they do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def hour_start(ts: Column) -> Column:
    """First instant of the hour, zone-less.

    `date_trunc` would go through the session zone and shift hours in a DST gap.
    """
    local = ts.cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.hour(local), F.to_date(local).cast("timestamp_ntz"))


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def hours_between(start: Column, end: Column) -> Column:
    """Hours from `start` to `end`, counted in whole seconds."""
    seconds = F.to_unix_timestamp(end) - F.to_unix_timestamp(start)
    return seconds.cast("double") / F.lit(3600.0)


def literal_like(df: DataFrame, column: str, value: dt.date | dt.datetime | str) -> Column:
    """`value` as a constant of the column's own type.

    A constant of another time type would put a cast on the column and keep the
    comparison from reaching the file scan.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(str(value)).cast(kind)
    return F.lit(value)
