"""One row per key, and the first k rows of an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep the first row of each composite key; NULL keys count as equal.

    The default order is all other columns, so the survivor does not depend on row order.
    Spark cuts each task's rows to one per key before the shuffle (window group limit), so a
    key with a large share of the rows sends one row per task.
    """
    if order is None:
        order = [c for c in df.columns if c not in set(keys)] or list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str], nulls: str = "last") -> DataFrame:
    """The k largest by `by`; ties go by `tie_break` ascending. NULLs come last unless asked first."""
    first = F.col(by).desc_nulls_last() if nulls == "last" else F.col(by).desc_nulls_first()
    return df.orderBy(first, *tie_break).limit(k)


def bottom_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(by).asc_nulls_last(), *tie_break).limit(k)
