"""Declared tables: columns, keys, build strategy and data checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from meterline.types import BY_NAME

STRATEGIES = ("view", "table", "append", "merge", "delete_insert", "time_interval")
GRANULARITIES = ("timestamp", "date")


@dataclass(frozen=True)
class Check:
    """One data check. `column` is None for checks on the whole table."""

    kind: str
    column: str | None = None
    values: tuple = ()


@dataclass(frozen=True)
class QueryCheck:
    """A scalar query whose result, as a number, has to equal `value`.

    `query` names its input as `{table}`.
    """

    name: str
    query: str
    value: float = 1


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    description: str = ""
    primary_key: bool = False
    checks: Sequence[str] = ()
    accepted: Sequence = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Sequence[Column]
    strategy: str = "table"
    incremental_key: str | None = None
    granularity: str = "timestamp"
    # whether columns that a frame has beside the declared ones are kept, and columns that come later added
    more: bool = False
    # whether a window built again writes only the days that differ
    only_changes: bool = False
    # partitions by a hash of the primary key, through which upserts reach a table that is not kept by day
    slots: int = 0
    # what a view is declared by, over stored tables; without it a view lasts for the session
    query: str | None = None
    query_checks: Sequence[QueryCheck] = field(default_factory=tuple)

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy!r}")
        if self.granularity not in GRANULARITIES:
            raise ValueError(f"unknown granularity {self.granularity!r}")
        if self.strategy == "time_interval" and self.incremental_key is None:
            raise ValueError("time_interval needs an incremental_key")
        if self.query is not None and self.strategy != "view":
            raise ValueError("only a view is declared by a query")
        if self.only_changes and self.strategy != "time_interval":
            raise ValueError("only time_interval can write changes only")
        if self.more and self.strategy not in ("view", "table", "append"):
            raise ValueError(f"{self.strategy} needs all columns declared")
        if self.strategy in ("merge", "delete_insert") and not self.primary_key:
            raise ValueError(f"{self.strategy} needs primary key columns")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, BY_NAME[c.type]) for c in self.columns])

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def checks(self) -> list[Check]:
        """Column checks in declared order, then uniqueness of the primary key."""
        found = [
            Check(kind, c.name, tuple(c.accepted) if kind == "accepted_values" else ())
            for c in self.columns
            for kind in c.checks
        ]
        if self.primary_key:
            found.append(Check("primary_key", values=tuple(self.primary_key)))
        return found
