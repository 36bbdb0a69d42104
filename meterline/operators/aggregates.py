"""Counts, measures by group and distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.measures import fixed_avg, fixed_sum, from_units, unit_sum


def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_measures(
    df: DataFrame,
    keys: Sequence[Column | str],
    sums: Mapping[str, str] | None = None,
    avgs: Mapping[str, str] | None = None,
    maxes: Mapping[str, str] | None = None,
    count: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Group once and take `{output: column}` sums, averages and maxima, and a row count.

    Sums and averages are the plain floating-point ones, whose last digits depend on the order
    in which tasks finish. Where the amounts are known to have `scale` decimals, such as money,
    say so: the results are then the same on every run.
    """
    add = F.sum if scale is None else lambda c: fixed_sum(c, scale)
    mean = F.avg if scale is None else lambda c: fixed_avg(c, scale)
    wanted = [
        *(add(F.col(c)).alias(out) for out, c in (sums or {}).items()),
        *(mean(F.col(c)).alias(out) for out, c in (avgs or {}).items()),
        *(F.max(c).alias(out) for out, c in (maxes or {}).items()),
        *([F.count("*").alias(count)] if count else []),
    ]
    return df.groupBy(*keys).agg(*wanted)


def partial_measures(df: DataFrame, keys: Sequence[Column | str], columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """Mergeable states of sums and averages: for each column its sum, in units if it has `scale` decimals, and its count."""
    add = F.sum if scale is None else lambda c: unit_sum(c, scale)
    states = [x for c in columns for x in (add(F.col(c)).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"))]
    return df.groupBy(*keys).agg(*states)


def merge_measures(
    parts: DataFrame,
    keys: Sequence[Column | str],
    sums: Mapping[str, str] | None = None,
    avgs: Mapping[str, str] | None = None,
    scale: int | None = None,
) -> DataFrame:
    """What `group_measures` gives for the rows that the parts were made of."""

    def total(column: str) -> Column:
        whole = F.sum(f"sum_{column}")
        return whole if scale is None else from_units(whole, scale)

    wanted = [total(c).alias(out) for out, c in (sums or {}).items()]
    wanted += [(total(c) / F.nullif(F.sum(f"count_{c}"), F.lit(0))).alias(out) for out, c in (avgs or {}).items()]
    return parts.groupBy(*keys).agg(*wanted)


def max_of(df: DataFrame, expression: Column, name: str) -> DataFrame:
    return df.agg(F.max(expression).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
