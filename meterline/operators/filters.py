"""Row predicates that reach the file scan."""

from __future__ import annotations

import datetime as dt
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import literal_like

_COMPARE = {
    "=": operator.eq,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def as_moment(value: dt.date | dt.datetime | str) -> dt.datetime:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value


def last_day_below(hi: dt.date | dt.datetime | str) -> dt.date:
    """Last calendar day with an instant before `hi`."""
    return (as_moment(hi) - dt.timedelta(microseconds=1)).date()


def in_half_open(df: DataFrame, column: str, lo, hi) -> Column:
    return (F.col(column) >= literal_like(df, column, as_moment(lo))) & (
        F.col(column) < literal_like(df, column, as_moment(hi))
    )


def half_open(df: DataFrame, column: str, lo=None, hi=None, date_col: str | None = None) -> DataFrame:
    """Rows with `lo <= column < hi`; either bound may be left out.

    `date_col` names a partition column that holds the day of `column`: the implied day
    bounds are added, since Spark does not derive partition filters from the timestamp.
    """
    if lo is not None:
        df = df.where(F.col(column) >= literal_like(df, column, as_moment(lo)))
        if date_col:
            df = df.where(F.col(date_col) >= literal_like(df, date_col, as_moment(lo).date()))
    if hi is not None:
        df = df.where(F.col(column) < literal_like(df, column, as_moment(hi)))
        if date_col:
            df = df.where(F.col(date_col) <= literal_like(df, date_col, last_day_below(hi)))
    return df


def closed_range(df: DataFrame, column: str, lo, hi, date_col: str | None = None) -> DataFrame:
    """Rows with `lo <= column <= hi`.

    A bare date as `hi` means its midnight, so nearly all of that day is left out.
    """
    df = df.where(
        (F.col(column) >= literal_like(df, column, as_moment(lo)))
        & (F.col(column) <= literal_like(df, column, as_moment(hi)))
    )
    if date_col:
        df = df.where(
            F.col(date_col).between(
                literal_like(df, date_col, as_moment(lo).date()), literal_like(df, date_col, as_moment(hi).date())
            )
        )
    return df


def on_date(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    """Rows of one day. Written as a range, which is pushed down."""
    start = as_moment(day)
    return half_open(df, column, start, start + dt.timedelta(days=1))


def on_month_day(df: DataFrame, column: str, month: int, day: int) -> DataFrame:
    """Rows of that calendar day in any year; needs a look at every row."""
    return df.where((F.month(column) == month) & (F.dayofmonth(column) == day))


def compare(df: DataFrame, column: str, op: str, value) -> DataFrame:
    if op not in _COMPARE:
        raise ValueError(f"unknown comparison {op!r}")
    return df.where(_COMPARE[op](F.col(column), literal_like(df, column, value)))


def valid_pair(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows where both are known and `end` is not before `start`."""
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start)))
