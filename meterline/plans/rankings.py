"""Top and bottom lists, daily statistics and single-figure reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.base_ids import base_id
from meterline.functions.clock import day_of, hours_between
from meterline.functions.text import join_text
from meterline.operators.aggregates import group_measures, max_of
from meterline.operators.filters import compare, half_open, on_date, valid_pair
from meterline.operators.joins import lookup, lookup_roles
from meterline.operators.ordering import bottom_k, top_k


def name_counts(people: DataFrame) -> DataFrame:
    return people.groupBy("name").agg(F.count("*").alias("player_count"))


def daily_zone_stats(trips: DataFrame, time: str, zone: str, maxes: dict[str, str]) -> DataFrame:
    """Trips and maxima by day and zone, in that order."""
    keys = [day_of(F.col(time)).alias("day"), F.col(zone).alias("zone")]
    return group_measures(trips, keys, maxes=maxes, count="trips").orderBy("day", "zone")


def daily_stats_by_count(trips: DataFrame, time: str, maxes: dict[str, str]) -> DataFrame:
    """Trips and maxima by day, busiest day first."""
    days = group_measures(trips, [day_of(F.col(time)).alias("day")], maxes=maxes, count="trips")
    return days.orderBy(F.col("trips").desc(), "day")


def trip_zone_names(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips labelled `borough / zone` at both ends."""
    roles = {"pickup": "PULocationID", "dropoff": "DOLocationID"}
    named = lookup_roles(trips, zones, "LocationID", roles, ["Borough", "Zone"])
    labels = {f"{end}_location": join_text(F.col(f"{end}_Borough"), " / ", F.col(f"{end}_Zone")) for end in roles}
    return named.withColumns(labels).drop(*(f"{end}_{c}" for end in roles for c in ("Borough", "Zone")))


def top_trips_by_distance(trips: DataFrame, below: float, tie_break: list[str], k: int = 5) -> DataFrame:
    """Days of the longest trips shorter than a limit."""
    longest = top_k(compare(trips, "trip_distance", "<", below), "trip_distance", k, tie_break)
    return longest.select(day_of(F.col("pickup_datetime")).alias("day"), "trip_distance")


def _by_zone_name(per_zone: DataFrame, zones: DataFrame) -> DataFrame:
    """Totals by zone number with the zone's name, ready to add up where zones share one.

    One row per zone goes to the join, however uneven the zones are.
    """
    return lookup(per_zone, zones.select("LocationID", "Zone"), {"zone_id": "LocationID"})


def top_zone_by_total(trips: DataFrame, zones: DataFrame, day, k: int = 1, scale: int | None = None) -> DataFrame:
    """Pickup zone with the largest total amount on a day."""
    per_zone = group_measures(
        on_date(trips, "pickup_datetime", day),
        [F.col("PULocationID").alias("zone_id")],
        {"total": "total_amount"},
        scale=scale,
    )
    names = [F.col("Zone").alias("pickup_zone")]
    totals = group_measures(_by_zone_name(per_zone, zones), names, {"sum_total_amount": "total"}, scale=scale)
    return top_k(totals, "sum_total_amount", k, ["pickup_zone"])


def least_busy_zones(trips: DataFrame, zones: DataFrame, k: int = 5) -> DataFrame:
    """Pickup zones with the fewest trips, of those with any."""
    per_zone = trips.groupBy(F.col("PULocationID").alias("zone_id")).agg(F.count("*").alias("n"))
    counts = _by_zone_name(per_zone, zones).groupBy("Zone").agg(F.sum("n").alias("trips"))
    return bottom_k(counts, "trips", k, ["Zone"])


def largest_tip_dropoff(
    trips: DataFrame, zones: DataFrame, pickup_zone: str, lo, hi, tie_break: list[str], k: int = 1
) -> DataFrame:
    """Drop-off zone of the largest tip among trips from one zone in a time range.

    The pickup zone is filtered before the join, so that only its trips move on.
    """
    starts = compare(zones, "Zone", "=", pickup_zone).select(F.col("LocationID").alias("start_id"))
    ends = zones.select(F.col("LocationID").alias("end_id"), F.col("Zone").alias("dropoff_zone"))
    inside = half_open(trips, "pickup_datetime", lo, hi)
    named = lookup(lookup(inside, starts, {"PULocationID": "start_id"}), ends, {"DOLocationID": "end_id"})
    best = top_k(named, "tip_amount", k, [*tie_break, "dropoff_zone"])
    return best.select("dropoff_zone", "tip_amount", "pickup_datetime")


def longest_duration_hours(trips: DataFrame, start: str, end: str) -> DataFrame:
    return max_of(valid_pair(trips, start, end), hours_between(F.col(start), F.col(end)), "max_hours")


def base_report(
    trips: DataFrame, licence: str, pickup: str, dropoff: str, columns: list[str], label=base_id
) -> DataFrame:
    """Base label and both dates of each for-hire trip; `label` may be another function of the licence."""
    return trips.select(
        label(F.col(licence)).alias("base_id"),
        day_of(F.col(pickup)).alias("pickup_date"),
        day_of(F.col(dropoff)).alias("dropoff_date"),
        *columns,
    )


def licence_trips(trips: DataFrame, licence: str, columns: list[str]) -> DataFrame:
    """Chosen columns of the trips of one licence."""
    return compare(trips, "hvfhs_license_num", "=", licence).select(*columns)
