"""Projections, filters, joins, aggregates, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.clock import day_of
from meterline.operators import filters, shape
from meterline.operators.aggregates import count_rows, distinct_values
from meterline.operators.joins import lookup
from meterline.operators.ordering import dedup, top_k
from meterline.operators.sets import unite
from meterline.plans.revenue import GREEN_NAMES, YELLOW_NAMES, union_services
from meterline.sources.landing import TRIP_SPELLINGS
from meterline.types import struct_of
from querybook.feeds import green, green_feed, yellow, yellow_feed
from querybook.registry import query


@query("select_all_zones", "SELECT * FROM nation")
def select_all_zones(t):
    return t("nation").select("*")


@query("project_columns", "SELECT l_suppkey, l_partkey FROM lineitem")
def project_columns(t):
    return t("lineitem").select("l_suppkey", "l_partkey")


@query(
    "rename_columns",
    """
    SELECT l_shipdate AS pickup_datetime, l_suppkey AS "PULocationID", l_extendedprice AS total_amount
    FROM lineitem
    """,
)
def rename_columns(t):
    names = {"l_shipdate": "pickup_datetime", "l_suppkey": "PULocationID", "l_extendedprice": "total_amount"}
    return shape.rename(t("lineitem").select(*names), names)


SERVICES = """
  SELECT o_orderdate AS pickup_datetime, o_custkey AS "PULocationID",
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
         o_totalprice AS fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax,
         CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount,
         CAST(NULL AS DOUBLE) AS improvement_surcharge, o_totalprice AS total_amount,
         CAST(NULL AS DOUBLE) AS congestion_surcharge, 'green' AS service_type
  FROM orders
  UNION ALL
  SELECT l_shipdate, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_tax, NULL, NULL,
         l_extendedprice, NULL, 'yellow'
  FROM lineitem
"""


@query("union_services", SERVICES)
def services(t):
    return union_services(green(t), yellow(t))


@query(
    "common_columns",
    """
    SELECT o_orderdate AS pickup_datetime, o_custkey AS "PULocationID", o_totalprice AS fare_amount,
           o_totalprice AS total_amount, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS passenger_count
    FROM orders
    """,
)
def common_columns(t):
    """Green trips with the columns that yellow has too, in green's order."""
    first, second = shape.rename(green_feed(t), GREEN_NAMES), shape.rename(yellow_feed(t), YELLOW_NAMES)
    return first.select(*shape.common_columns(first, second))


@query(
    "rename_first_present",
    """
    SELECT o_orderdate AS pickup_datetime, o_custkey AS pickup_location_id, o_totalprice AS fare_amount,
           o_orderstatus AS status
    FROM orders
    """,
)
def rename_first_present(t):
    feed = t("orders").select(
        F.col("o_orderdate").alias("lpep_pickup_datetime"),
        F.col("o_custkey").alias("PULocationID"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )
    return shape.rename_first_present(feed, TRIP_SPELLINGS)[0]


@query(
    "ensure_columns",
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS INTEGER) AS payment_type, CAST(NULL AS DOUBLE) AS tip FROM orders",
)
def ensure_columns(t):
    wanted = struct_of("o_orderkey bigint, payment_type int, tip double")
    return shape.ensure_columns(t("orders").select("o_orderkey", "o_totalprice"), wanted)


@query(
    "coerce_timestamps",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IS DISTINCT FROM 'R' THEN l_shipdate END AS pickup_datetime
    FROM lineitem
    """,
)
def coerce_timestamps(t):
    """Ship dates as text, with returned lines carrying none that can be read."""
    text = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("not known "), F.col("l_shipdate").cast("string")))
    lines = t("lineitem").select(
        "l_orderkey", "l_linenumber", text.otherwise(F.col("l_shipdate").cast("string")).alias("pickup_datetime")
    )
    return shape.coerce_timestamps(lines, ["pickup_datetime"])


@query(
    "filter_half_open",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-17 18:00:00'",
)
def filter_half_open(t):
    return filters.half_open(t("events"), "ts", "2024-01-05 06:00:00", "2024-01-17 18:00:00")


@query(
    "filter_closed_range",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-15'",
)
def filter_closed_range(t):
    return filters.closed_range(t("events"), "ts", "2024-01-03", "2024-01-15")


@query(
    "count_short_trips",
    """
    SELECT COUNT(*) AS row_count FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-11-01' AND l_shipdate < TIMESTAMP '1998-12-01' AND l_quantity <= 1
    """,
)
def count_short_trips(t):
    month = filters.half_open(t("lineitem"), "l_shipdate", "1998-11-01", "1998-12-01")
    return count_rows(filters.compare(month, "l_quantity", "<=", 1.0))


@query("count_zero_fare", "SELECT COUNT(*) AS row_count FROM lineitem WHERE l_discount = 0")
def count_zero_fare(t):
    return count_rows(filters.compare(t("lineitem"), "l_discount", "=", 0.0))


@query(
    "count_by_date_parts",
    "SELECT COUNT(*) AS row_count FROM events WHERE month(ts) = 1 AND day(ts) = 15",
)
def count_by_date_parts(t):
    return count_rows(filters.on_month_day(t("events"), "ts", 1, 15))


@query("count_on_date", "SELECT COUNT(*) AS row_count FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def count_on_date(t):
    return count_rows(filters.on_date(t("events"), "ts", "2024-01-15"))


@query(
    "join_zone",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_suppkey AS "LocationID", n_name AS "Zone"
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    """,
)
def join_zone(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = t("supplier").select(F.col("s_suppkey").alias("LocationID"), "s_nationkey")
    nations = t("nation").select("n_nationkey", F.col("n_name").alias("Zone"))
    zoned = lookup(lookup(lines, suppliers, {"l_suppkey": "LocationID"}), nations, {"s_nationkey": "n_nationkey"})
    return zoned.drop("s_nationkey", "n_nationkey")


@query(
    "left_lookup",
    """
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
           CASE WHEN substr(o_orderpriority, 1, 1) <> '3' THEN substr(o_orderpriority, 3) END AS payment_type_name
    FROM orders
    """,
)
def left_lookup(t):
    """Payment names from the orders themselves, with one code missing."""
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    names = t("orders").select("o_orderpriority").distinct().select(
        code.alias("payment_type_id"), F.substr("o_orderpriority", F.lit(3)).alias("payment_type_name")
    )
    orders = t("orders").select("o_orderkey", code.alias("payment_type"))
    named = lookup(orders, names.where("payment_type_id <> 3"), {"payment_type": "payment_type_id"}, "left")
    return named.select("o_orderkey", "payment_type", "payment_type_name")


@query("count_rows", "SELECT COUNT(*) AS row_count FROM lineitem")
def count_all_rows(t):
    return count_rows(t("lineitem"))


BY_SERVICE = f"SELECT service_type, COUNT(*) AS trips FROM ({SERVICES}) GROUP BY 1"


@query("count_by_service", BY_SERVICE)
def count_by_service(t):
    return services(t).groupBy("service_type").agg(F.count("*").alias("trips"))


@query("count_by_service_sql", BY_SERVICE)
def count_by_service_sql(t):
    return t.spark.sql("SELECT service_type, count(1) AS trips FROM {trips} GROUP BY service_type", trips=services(t))


@query("distinct_zone", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_zone(t):
    return distinct_values(t("lineitem"), "l_suppkey")


@query(
    "distinct_vendor_unpruned",
    """
    SELECT DISTINCT event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-15'
    """,
)
def distinct_vendor_unpruned(t):
    return distinct_values(filters.closed_range(t("events"), "ts", "2024-01-03", "2024-01-15"), "event_type")


@query(
    "dedup_composite",
    """
    SELECT * EXCLUDE (rank) FROM (
      SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
                   l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
                   l_shipdate NULLS FIRST) AS rank
      FROM lineitem) WHERE rank = 1
    """,
)
def dedup_composite(t):
    return dedup(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("limit_rows", "SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100")
def limit_rows(t):
    return top_k(t("orders"), "o_totalprice", 100, ["o_orderkey"])


@query(
    "union_positional",
    """
    SELECT CAST(c_nationkey AS BIGINT) AS zone, c_acctbal AS amount FROM customer
    UNION ALL SELECT l_suppkey, l_extendedprice FROM lineitem
    """,
)
def union_positional(t):
    """An int and a bigint column at the same position come out as bigint."""
    first = t("customer").select(F.col("c_nationkey").alias("zone"), F.col("c_acctbal").alias("amount"))
    second = t("lineitem").select(F.col("l_suppkey").alias("pickup"), F.col("l_extendedprice").alias("total"))
    return unite([first, second], by="position")


@query(
    "union_missing_columns",
    """
    SELECT o_orderkey AS id, o_totalprice AS total, o_orderstatus AS status, CAST(NULL AS DOUBLE) AS distance
    FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_quantity FROM lineitem
    """,
)
def union_missing_columns(t):
    first = t("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status")
    )
    second = t("lineitem").select(
        F.col("l_quantity").alias("distance"), F.col("l_extendedprice").alias("total"), F.col("l_orderkey").alias("id")
    )
    return unite([first, second], allow_missing=True)


@query("fn_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def fn_to_date(t):
    return t("events").select("event_id", day_of(F.col("ts")).alias("day"))
