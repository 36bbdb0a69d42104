"""Lookups against dimensions and outer joins of aggregates.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is below
`spark.sql.autoBroadcastJoinThreshold`, and otherwise sorts and merges, where adaptive
execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join a dimension on `{fact column: dimension column}`; both keys are kept."""
    matches = [F.col(f"fact.`{fact}`") == F.col(f"dim.`{key}`") for fact, key in on.items()]
    return df.alias("fact").join(dim.alias("dim"), reduce(lambda a, b: a & b, matches), how)


def lookup_roles(
    df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str], columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join one dimension several times: `{role: fact column}` adds `<role>_<column>` for each role."""
    for role, fact_column in roles.items():
        role_key = f"__{role}_key"
        side = dim.select(F.col(key).alias(role_key), *(F.col(c).alias(f"{role}_{c}") for c in columns))
        df = lookup(df, side, {fact_column: role_key}, how).drop(role_key)
    return df


def outer_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], prefixes: tuple[str, str] = ("left_", "right_")
) -> DataFrame:
    """Full outer join on shared keys; the other columns get their side's prefix.

    Keys appear once. NULL keys match nothing, so such rows stay apart.
    """
    sides = [
        side.select(*keys, *(F.col(c).alias(prefix + c) for c in side.columns if c not in keys))
        for side, prefix in zip((left, right), prefixes)
    ]
    return sides[0].join(sides[1], on=list(keys), how="outer")
