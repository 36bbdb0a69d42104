"""Data checks. Every check is one row: table, column, check, failed_rows, passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.sets import unite
from meterline.spec import Check, QueryCheck, TableSpec

RESULT_COLUMNS = ("table_name", "column_name", "check_name", "failed_rows", "passed")


class ChecksFailed(Exception):
    pass


def _failures(check: Check) -> Column:
    """Aggregate that counts the rows breaking a row-wise check; NULL breaks only not_null."""
    if check.kind == "row_count":
        return F.when(F.count("*") > 0, 0).otherwise(1).cast("long")
    value = F.col(check.column)
    broken = {
        "not_null": lambda: value.isNull(),
        "positive": lambda: value <= 0,
        "non_negative": lambda: value < 0,
        "accepted_values": lambda: ~value.isin(*check.values),
    }[check.kind]()
    return F.count_if(broken)


def _result(table: str, column: str | None, name: str, failed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(name).alias("check_name"),
        failed.alias("failed_rows"),
        (failed == 0).alias("passed"),
    )


def _rowwise(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks of a table from one pass over it."""
    counts = df.agg(*(_failures(c).alias(f"c{i}") for i, c in enumerate(checks)))
    results = F.array(*(_result(table, c.column, c.kind, F.col(f"c{i}")) for i, c in enumerate(checks)))
    return counts.select(F.inline(results))


def _repeats(df: DataFrame, table: str, check: Check) -> DataFrame:
    """Rows beyond the first of each key. `unique` skips NULL; a primary key counts it as a value."""
    if check.kind == "unique":
        keys, label, rows = [check.column], check.column, df.where(F.col(check.column).isNotNull())
    else:
        keys, label, rows = list(check.values), ",".join(check.values), df
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    failed = sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed"))
    return failed.select(F.inline(F.array(_result(table, label, check.kind, F.col("failed")))))


def query_check(scalar: DataFrame, table: str, name: str, value: float = 1) -> DataFrame:
    """Compare a one-cell result with a number; true counts as 1 and false as 0."""
    scalar, cell = scalar.toDF("cell"), F.col("cell").cast("double")
    holds = (F.count("*") == 1) & (F.coalesce(F.max(cell), F.lit(float("nan"))) == F.lit(float(value)))
    failed = scalar.agg(F.when(holds, 0).otherwise(1).cast("long").alias("failed"))
    return failed.select(F.inline(F.array(_result(table, None, name, F.col("failed")))))


def run_checks(
    df: DataFrame, table: str, checks: Sequence[Check], query_checks: Sequence[QueryCheck] = ()
) -> DataFrame:
    """Results of all checks on a frame, without building anything.

    Row-wise checks share one scan; each uniqueness check groups by its own key.
    """
    rowwise = [c for c in checks if c.kind not in ("unique", "primary_key")]
    frames = [_rowwise(df, table, rowwise)] if rowwise else []
    frames += [_repeats(df, table, c) for c in checks if c.kind in ("unique", "primary_key")]
    frames += [
        query_check(df.sparkSession.sql(q.query, table=df), table, q.name, q.value) for q in query_checks
    ]
    if not frames:
        raise ValueError("no checks given")
    return unite(frames)


def check_table(spec: TableSpec, df: DataFrame) -> DataFrame:
    return run_checks(df, spec.name, spec.checks, spec.query_checks)


def enforce(results: DataFrame) -> None:
    """Raise if a check failed. One row per declared check comes to the driver."""
    failed = [r for r in results.collect() if not r.passed]
    if failed:
        raise ChecksFailed("; ".join(f"{r.table_name}.{r.column_name or '*'}: {r.check_name}" for r in failed))
