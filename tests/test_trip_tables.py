"""Landed files to report, over two windows and a repeat."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators.checks import ChecksFailed
from meterline.plans import staging
from meterline.sinks.files import write_parquet
from tests.conftest import plan_of, rows

JAN, FEB, MAR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


@pytest.fixture
def landed(spark, folder):
    for base in ("ingestion", "staging", "reports"):
        spark.sql(f"DROP DATABASE IF EXISTS {base} CASCADE")
        spark.sql(f"CREATE DATABASE {base} LOCATION '{folder}/db_{base}'")
    for month in (1, 2):
        trips = spark.range(40).select(
            F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(f"2024-0{month}-10").cast("timestamp_ntz"))
            .alias("tpep_pickup_datetime"),
            F.lit(f"2024-0{month}-20").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
            F.lit(1).alias("PULocationID"), F.lit(2).alias("DOLocationID"),
            F.lit(2.5).alias("fare_amount"), F.pmod("id", F.lit(3)).cast("int").alias("payment_type"),
        )
        write_parquet(trips.unionAll(trips), f"{folder}/yellow_tripdata_2024-0{month}.parquet")
    spark.sql("SELECT '0' AS payment_type_id, 'flexible' AS payment_type_name UNION ALL SELECT '1', 'card'").coalesce(
        1).write.option("header", True).csv(f"{folder}/seed")
    yield folder
    for base in ("ingestion", "staging", "reports"):
        spark.sql(f"DROP DATABASE IF EXISTS {base} CASCADE")


def build(spark, landed, window, **more):
    return staging.build_trip_tables(spark, landed, f"{landed}/seed", ["yellow"], window, **more)


def test_staging_reads_only_the_days_of_its_window(spark, landed):
    build(spark, landed, (JAN, FEB))
    payments = spark.table("ingestion.payment_lookup")
    text = plan_of(staging.staging_trips(spark.table("ingestion.trips"), payments, (JAN, FEB)))
    assert "PartitionFilters: [isnotnull(_day" in text


def test_windows_build_up_and_repeat(spark, landed):
    build(spark, landed, (JAN, FEB))
    assert spark.table("staging.trips").count() == 40
    report = build(spark, landed, (FEB, MAR))
    assert spark.table("staging.trips").count() == 80 and spark.table("ingestion.trips").count() == 160
    before = rows(report)
    again = build(spark, landed, (FEB, MAR))
    assert rows(again) == before and spark.table("ingestion.trips").count() == 240
    totals = report.groupBy("payment_type").agg(F.sum("trip_count").alias("n"), F.sum("total_fare").alias("f"))
    assert rows(totals.select("payment_type", "n", "f")) == rows(
        spark.createDataFrame([("flexible", 28, 70.0), ("card", 26, 65.0), (None, 26, 65.0)], "a string, b bigint, c double")
    )
    assert [r.payment_type for r in staging.top_payment_types(report, 1).collect()] == ["flexible"]


def test_window_without_trips_fails_its_check(spark, landed):
    with pytest.raises(ChecksFailed, match="row_count_greater_than_zero"):
        build(spark, landed, (dt.date(2023, 1, 1), dt.date(2023, 2, 1)))


def test_full_refresh_keeps_only_the_window(spark, landed):
    build(spark, landed, (JAN, FEB))
    build(spark, landed, (FEB, MAR), full_refresh=True)
    assert spark.table("staging.trips").count() == 40 and spark.table("ingestion.trips").count() == 80
