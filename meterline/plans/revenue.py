"""Revenue reports over two trip services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.clock import day_of, hour_start, month_start
from meterline.operators.aggregates import group_measures, merge_measures, partial_measures
from meterline.operators.filters import half_open
from meterline.operators.joins import lookup, outer_on
from meterline.operators.sets import unite
from meterline.operators.shape import common_columns, rename, with_tag
from meterline.sinks.strategies import MONTH, time_interval

# Column names of the two services and of the monthly report.
GREEN_NAMES = {"lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime"}
YELLOW_NAMES = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}
MONTHLY_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
}
MONTHLY_AVERAGES = {
    "avg_monthly_passenger_count": "passenger_count",
    "avg_monthly_trip_distance": "trip_distance",
}


def union_services(green: DataFrame, yellow: DataFrame, by: str = "name") -> DataFrame:
    """Trips of both services with the columns they share and a `service_type`."""
    green, yellow = rename(green, GREEN_NAMES), rename(yellow, YELLOW_NAMES)
    shared = common_columns(green, yellow)
    tagged = [
        with_tag(trips.select(*shared), "service_type", service)
        for trips, service in ((green, "green"), (yellow, "yellow"))
    ]
    return unite(tagged, by)


def monthly_revenue(green: DataFrame, yellow: DataFrame, scale: int | None = None) -> DataFrame:
    """Eight revenue sums and two averages by pickup zone, month and service."""
    keys = [
        F.col("PULocationID").alias("revenue_zone"),
        month_start(F.col("pickup_datetime")).alias("revenue_month"),
        "service_type",
    ]
    return group_measures(union_services(green, yellow), keys, MONTHLY_SUMS, MONTHLY_AVERAGES, scale=scale)


def revenue_parts(green: DataFrame, yellow: DataFrame, window: tuple, scale: int | None = None) -> DataFrame:
    """States of the monthly report by pickup zone, service and day, for the days of a window."""
    trips = half_open(union_services(green, yellow), "pickup_datetime", *window)
    keys = [day_of(F.col("pickup_datetime")).alias("day"), F.col("PULocationID").alias("revenue_zone"), "service_type"]
    return partial_measures(trips, keys, [*MONTHLY_SUMS.values(), *MONTHLY_AVERAGES.values()], scale)


def keep_revenue(
    spark: SparkSession, name: str, green: DataFrame, yellow: DataFrame, window: tuple, scale: int | None = None
) -> DataFrame:
    """Bring the kept states of a window's days up to date, and give the monthly report over all days kept.

    Only the window's trips are read, and only its months' states written: late trips cost their own days.
    """
    parts = time_interval(spark, name, revenue_parts(green, yellow, window, scale), "day", *window, "date", by="month")
    keys = ["revenue_zone", F.col(MONTH).cast("timestamp_ntz").alias("revenue_month"), "service_type"]
    return merge_measures(parts, keys, MONTHLY_SUMS, MONTHLY_AVERAGES, scale)


def hourly_revenue(trips: DataFrame, pickup: str, since=None, scale: int | None = None) -> DataFrame:
    """Revenue and trips by pickup hour and zone, from `since` on."""
    keys = [hour_start(F.col(pickup)).alias("hour_ts"), F.col("PULocationID").alias("zone")]
    return group_measures(
        half_open(trips, pickup, lo=since), keys, {"amount": "total_amount"}, count="number_records", scale=scale
    )


def outer_join_hourly(green_hours: DataFrame, yellow_hours: DataFrame) -> DataFrame:
    """Both services side by side; NULL where a service had no trip in that hour and zone.

    Both sides are aggregates, one row per key, so no key can be large in this join.
    """
    return outer_on(green_hours, yellow_hours, ["hour_ts", "zone"], ("green_", "yellow_"))


def revenue_by_zone(hours: DataFrame, zones: DataFrame) -> DataFrame:
    """Hourly revenue with the zone's attributes in place of its number.

    The number is renamed first: dropping `zone` by name would drop the `Zone` attribute too.
    """
    numbered = hours.withColumnRenamed("zone", "zone_id")
    return lookup(numbered, zones, {"zone_id": "LocationID"}).drop("zone_id", "LocationID")
