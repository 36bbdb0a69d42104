"""Unions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def unite(frames: Iterable[DataFrame], by: str = "name", allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, duplicates kept.

    By name is the safe default; by position needs equal column order. `allow_missing`
    fills columns that a frame lacks with NULL.
    """
    if by == "position":
        return reduce(DataFrame.unionAll, frames)
    if by != "name":
        raise ValueError(f"unknown union {by!r}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
