"""Landed trips to staged trips to the daily report, as declared tables and as plain frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.aggregates import group_measures
from meterline.operators.checks import check_table, enforce
from meterline.operators.filters import as_moment
from meterline.operators.joins import lookup
from meterline.operators.ordering import dedup, top_k
from meterline.sinks.ledger import Built, files_digest, known, record
from meterline.sinks.strategies import DAY, materialise, window_rows
from meterline.sources.landing import MONTH_FILE, ingest_months, landed_files
from meterline.sources.seeds import PAYMENT_LOOKUP, load_seed
from meterline.spec import Column, QueryCheck, TableSpec

# Fixed value: the check's name and query.
HAS_ROWS = QueryCheck("row_count_greater_than_zero", "SELECT count(*) > 0 FROM {table}")

# The columns that together identify a trip.
TRIP_KEY = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "taxi_type",
)

STAGED_COLUMNS = (*TRIP_KEY, "payment_type_name")

INGESTED_TRIPS = TableSpec(
    name="ingestion.trips",
    strategy="append",
    incremental_key="pickup_datetime",
    more=True,
    columns=(
        Column("pickup_datetime", "timestamp_ntz", "Start of the trip"),
        Column("dropoff_datetime", "timestamp_ntz", "End of the trip"),
        Column("pickup_location_id", "int", "Zone of the start"),
        Column("dropoff_location_id", "int", "Zone of the end"),
        Column("fare_amount", "double", "Fare"),
        Column("payment_type", "int", "Code of the payment type"),
        Column("taxi_type", "string", "Feed the trip came from"),
        Column("extracted_at", "timestamp_ntz", "When the run read the trip"),
    ),
)

STAGED_TRIPS = TableSpec(
    name="staging.trips",
    strategy="time_interval",
    incremental_key="pickup_datetime",
    granularity="timestamp",
    only_changes=True,
    columns=(
        Column("pickup_datetime", "timestamp_ntz", "Start of the trip", primary_key=True, checks=("not_null",)),
        Column("dropoff_datetime", "timestamp_ntz", "End of the trip", primary_key=True),
        Column("pickup_location_id", "int", "Zone of the start", primary_key=True),
        Column("dropoff_location_id", "int", "Zone of the end", primary_key=True),
        Column("fare_amount", "double", "Fare", primary_key=True),
        Column("taxi_type", "string", "Feed the trip came from", primary_key=True),
        Column("payment_type_name", "string", "Name of the payment type"),
    ),
    query_checks=(HAS_ROWS,),
)

TRIPS_REPORT = TableSpec(
    name="reports.trips_report",
    strategy="time_interval",
    incremental_key="trip_date",
    granularity="date",
    only_changes=True,
    columns=(
        Column("trip_date", "date", "Day of the pickup", primary_key=True),
        Column("taxi_type", "string", "Feed", primary_key=True),
        Column("payment_type", "string", "Name of the payment type", primary_key=True),
        Column("trip_count", "bigint", "Trips", checks=("non_negative",)),
        Column("total_fare", "double", "Sum of fares"),
        Column("avg_fare", "double", "Mean fare"),
    ),
)

_REPORT_ROWS = """
SELECT to_date(pickup_datetime) AS trip_date, taxi_type, payment_type_name AS payment_type, fare_amount
FROM {trips}
WHERE pickup_datetime >= CAST(:start_at AS TIMESTAMP_NTZ) AND pickup_datetime < CAST(:end_at AS TIMESTAMP_NTZ)
"""


def windowed_sql(spark: SparkSession, query: str, window: tuple, **frames: DataFrame) -> DataFrame:
    """Run SQL with `:start_at` and `:end_at` bound to the window and `{name}` to frames."""
    start, end = (str(as_moment(bound)) for bound in window)
    return spark.sql(query, args={"start_at": start, "end_at": end}, **frames)


def staging_trips(
    trips: DataFrame, payments: DataFrame, window: tuple, order: Sequence[str] | None = None
) -> DataFrame:
    """Trips picked up in the window, one per key, with the payment's name where it is known."""
    inside = window_rows(trips, "pickup_datetime", *window)
    if order is None:
        inside = inside.select(*TRIP_KEY, "payment_type")
    named = lookup(inside, payments, {"payment_type": "payment_type_id"}, "left")
    return dedup(named, TRIP_KEY, order).select(*STAGED_COLUMNS)


def trips_report(staged: DataFrame, window: tuple, scale: int | None = None) -> DataFrame:
    """Trips and fares of the window by day, feed and payment name (NULL is its own group)."""
    trips = windowed_sql(staged.sparkSession, _REPORT_ROWS, window, trips=staged)
    keys = ["trip_date", "taxi_type", "payment_type"]
    fares = {"total_fare": "fare_amount"}, {"avg_fare": "fare_amount"}
    report = group_measures(trips, keys, *fares, count="trip_count", scale=scale)
    return report.select(*keys, "trip_count", "total_fare", "avg_fare")


def top_payment_types(report: DataFrame, k: int = 10) -> DataFrame:
    """Payment names with the most trips over the whole report."""
    totals = report.groupBy("payment_type").agg(F.sum("trip_count").alias("trips"))
    return top_k(totals, "trips", k, ["payment_type"])


def _placed(spec: TableSpec, bases: Mapping[str, str]) -> TableSpec:
    """The spec with its database's name as the mapping has it."""
    base, table = spec.name.split(".")
    return replace(spec, name=f"{bases.get(base, base)}.{table}")


def build_trip_tables(
    spark: SparkSession,
    landed: str,
    seed: str,
    types: Sequence[str],
    window: tuple[dt.date, dt.date],
    full_refresh: bool = False,
    layout: str = MONTH_FILE,
    bases: Mapping[str, str] | None = None,
    skip_ingested: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """Ingest, stage and report one window of whole days, checking each table after it is built.

    The databases `ingestion`, `staging` and `reports`, or those that `bases` names instead, have to exist.
    Re-running a window gives the same staged trips and report: ingestion appends, staging keeps one row per key,
    and days that come out as they are stored are not written. With `skip_ingested` a month is ingested only if its files
    are not those of an earlier run, so a run over the same files writes nothing.
    """
    start, end = window
    last = end - dt.timedelta(days=1)
    ingested, lookup_spec, staged_spec, report_spec = (
        _placed(spec, bases or {}) for spec in (INGESTED_TRIPS, PAYMENT_LOOKUP, STAGED_TRIPS, TRIPS_REPORT)
    )
    fresh, seen = None, {}
    if skip_ingested:
        fresh, seen = _fresh_months(spark, ingested.name, landed_files(spark, landed, types, start, last, layout), full_refresh)
    if fresh is None or fresh or full_refresh or not spark.catalog.tableExists(ingested.name):
        landed_trips = ingest_months(spark, landed, types, start, last, layout=layout, landed=fresh)
        materialise(spark, ingested, landed_trips, full_refresh=full_refresh)
    if seen:
        record(spark, ingested.name, seen)
    trips = spark.table(ingested.name)
    payments = materialise(spark, lookup_spec, load_seed(spark, seed, PAYMENT_LOOKUP))

    staged = materialise(spark, staged_spec, staging_trips(trips, payments, window), window, full_refresh)
    enforce(check_table(staged_spec, window_rows(staged, "pickup_datetime", *window)))

    source = window_rows(staged, "pickup_datetime", *window).drop(DAY)
    report = materialise(spark, report_spec, trips_report(source, window, scale), window, full_refresh)
    enforce(check_table(report_spec, window_rows(report, "trip_date", *window)))
    return report


def _fresh_months(
    spark: SparkSession, table: str, files: DataFrame, all_of_them: bool
) -> tuple[list[str], dict[str, Built]]:
    """Landed names of months that have a file the table's ledger doesn't know, and what to enter for each of their names."""
    now = {r["name"]: r["files"] for r in files_digest(files, "name").collect()}
    before = {} if all_of_them else known(spark, table)
    months = {name.rsplit(".", 1)[0] for name, digest in now.items() if name not in before or before[name].files != digest}
    fresh = [name for name in now if name.rsplit(".", 1)[0] in months]
    return fresh, {name: Built(0, "", now[name]) for name in fresh}
