"""The test tables under trip column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.joins import lookup
from meterline.operators.shape import ensure_columns
from meterline.sources.files import read_parquet
from meterline.types import struct_of

CENTS = 2  # decimals of every amount in the tables

MEASURES = struct_of(
    "passenger_count int, trip_distance double, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double"
)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.path(name))


def payment_code():
    return F.substring("o_orderpriority", 1, 1).cast("int")


def green_feed(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderdate").alias("lpep_pickup_datetime"),
        F.col("o_custkey").alias("PULocationID"),
        payment_code().alias("passenger_count"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").alias("total_amount"),
        payment_code().alias("payment_type"),
        F.col("o_orderstatus").alias("trip_type"),
    )


def yellow_feed(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_tax").alias("tip_amount"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_partkey").alias("ratecode"),
    )


def green(t: Tables) -> DataFrame:
    return ensure_columns(green_feed(t), MEASURES)


def yellow(t: Tables) -> DataFrame:
    return ensure_columns(yellow_feed(t), MEASURES)


def zones(t: Tables) -> DataFrame:
    named = lookup(t("nation"), t("region"), {"n_regionkey": "r_regionkey"})
    return named.select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


def supplier_zones(t: Tables) -> DataFrame:
    """Every supplier as a zone; suppliers of one nation share its name."""
    named = lookup(t("supplier"), t("nation"), {"s_nationkey": "n_nationkey"})
    return named.select(F.col("s_suppkey").alias("LocationID"), F.col("n_name").alias("Zone"))


def hourly_trips(t: Tables, event_type: str) -> DataFrame:
    """Events of one kind as trips; the zone is one of seven groups of users."""
    return t("events").where(F.col("event_type") == event_type).select(
        F.col("ts").alias("pickup_datetime"),
        (F.col("user_id") % 7).cast("int").alias("PULocationID"),
        F.col("value").alias("total_amount"),
    )


def line_trips(t: Tables) -> DataFrame:
    """Order lines as trips from the supplier's nation to the customer's.

    Orders meet customers before lines, so the largest table is joined on the order once.
    """
    ends = lookup(t("orders"), t("customer"), {"o_custkey": "c_custkey"})
    ends = ends.select("o_orderkey", "o_orderdate", F.col("c_nationkey").alias("DOLocationID"))
    lines = lookup(t("lineitem"), ends, {"l_orderkey": "o_orderkey"})
    return lookup(lines, t("supplier"), {"l_suppkey": "s_suppkey"}).select(
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("s_nationkey").alias("PULocationID"),
        "DOLocationID",
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_tax").alias("tip_amount"),
        "l_orderkey",
        "l_linenumber",
    )


def for_hire(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_returnflag").alias("hvfhs_license_num"),
        F.concat(F.lit("B"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("dispatching_base_num"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.date_add("l_shipdate", F.col("l_linenumber")).alias("dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
    )
