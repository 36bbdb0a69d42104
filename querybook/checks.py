"""Data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators.checks import check_table, run_checks
from meterline.plans.rankings import name_counts
from meterline.spec import Check, Column, QueryCheck, TableSpec
from querybook.registry import query


def result(column: str | None, check: str, failed: str, table: str, source: str | None = None) -> str:
    """SQL of one check result; `failed` is a scalar expression over the source."""
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""
      SELECT '{table}' AS table_name, {name} AS column_name, '{check}' AS check_name,
             CAST(failed AS BIGINT) AS failed_rows, failed = 0 AS passed
      FROM (SELECT {failed} AS failed FROM {source or table})
    """


def surplus(keys: str, table: str, where: str = "true") -> str:
    return f"(SELECT n FROM (SELECT {keys}, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY ALL))"


def column_check(name: str, kind: str, columns: list[str], table: str, broken: str, values: tuple = ()):
    sql = " UNION ALL ".join(
        result(c, kind, f"count_if({broken.format(c)})", table) for c in columns
    )
    query(name, sql)(lambda t: run_checks(t(table), table, [Check(kind, c, values) for c in columns]))


column_check("check_not_null", "not_null", ["l_orderkey", "l_shipdate"], "lineitem", "{} IS NULL")
column_check("check_positive", "positive", ["l_quantity", "l_discount"], "lineitem", "{} <= 0")
column_check("check_non_negative", "non_negative", ["c_acctbal", "c_nationkey"], "customer", "{} < 0")
column_check(
    "check_accepted_values", "accepted_values", ["event_type"], "events",
    "{} NOT IN ('signup', 'purchase', 'view', 'click')", ("signup", "purchase", "view", "click"),
)


@query(
    "check_unique",
    result(
        "l_orderkey", "unique", "coalesce(SUM(n - 1), 0)", "lineitem",
        surplus("l_orderkey", "lineitem", "l_orderkey IS NOT NULL"),
    ),
)
def check_unique(t):
    return run_checks(t("lineitem"), "lineitem", [Check("unique", "l_orderkey")])


KEY = ("l_orderkey", "l_linenumber")


@query(
    "check_primary_key",
    result(
        ",".join(KEY), "primary_key", "coalesce(SUM(n - 1), 0)", "lineitem", surplus(", ".join(KEY), "lineitem")
    ),
)
def check_primary_key(t):
    return run_checks(t("lineitem"), "lineitem", [Check("primary_key", values=KEY)])


MANY_ROWS = QueryCheck("row_count_greater_than_one", "SELECT count(*) > 1 FROM {table}")


@query(
    "check_custom",
    result(None, MANY_ROWS.name, "CASE WHEN COUNT(*) > 1 THEN 0 ELSE 1 END", "orders")
    + " UNION ALL "
    + result(None, "no_open_orders", "CASE WHEN count_if(o_orderstatus = 'P') = 0 THEN 0 ELSE 1 END", "orders"),
)
def check_custom(t):
    """One query giving a boolean, one giving a number."""
    no_open = QueryCheck("no_open_orders", "SELECT count_if(o_orderstatus = 'P') FROM {table}", 0)
    return run_checks(t("orders"), "orders", [], [MANY_ROWS, no_open])


@query("check_row_count", result(None, "row_count", "CASE WHEN COUNT(*) > 0 THEN 0 ELSE 1 END", "events"))
def check_row_count(t):
    return run_checks(t("events"), "events", [Check("row_count")])


PLAYER_STATS = TableSpec(
    name="player_stats",
    columns=(
        Column("name", "string", "Name of the players", checks=("not_null", "unique")),
        Column("player_count", "bigint", "Players of that name", checks=("not_null", "positive")),
    ),
    query_checks=(MANY_ROWS,),
)
STATS = "(SELECT c_mktsegment AS name, COUNT(*) AS player_count FROM customer GROUP BY 1)"


@query(
    "run_checks",
    " UNION ALL ".join(
        [
            result("name", "not_null", "count_if(name IS NULL)", "player_stats", STATS),
            result("name", "unique", "COUNT(name) - COUNT(DISTINCT name)", "player_stats", STATS),
            result("player_count", "not_null", "count_if(player_count IS NULL)", "player_stats", STATS),
            result("player_count", "positive", "count_if(player_count <= 0)", "player_stats", STATS),
            result(None, MANY_ROWS.name, "CASE WHEN COUNT(*) > 1 THEN 0 ELSE 1 END", "player_stats", STATS),
        ]
    ),
)
def run_all_checks(t):
    """The declared checks of a table against a frame, nothing built."""
    return check_table(PLAYER_STATS, name_counts(t("customer").select(F.col("c_mktsegment").alias("name"))))
