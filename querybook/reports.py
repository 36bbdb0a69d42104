"""Named reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterline.functions.base_ids import base_id_udf
from meterline.operators.aggregates import count_rows
from meterline.plans import rankings, revenue, staging
from meterline.session import scratch_database, workspace
from meterline.sinks import strategies
from meterline.sinks.ledger import day_files
from querybook.feeds import CENTS, for_hire, green, hourly_trips, line_trips, supplier_zones, yellow, zones
from querybook.registry import query
from querybook.sources import LANDED_AS, land_lines


def money(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE)"


def mean(column: str) -> str:
    return f"{money(column)} / COUNT({column})"


TRIPS = """
  SELECT o_orderdate AS pickup_datetime, o_custkey AS zone, 'green' AS service_type,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS passengers, CAST(NULL AS DOUBLE) AS distance,
         o_totalprice AS fare, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS tax,
         o_totalprice AS total, CAST(NULL AS DOUBLE) AS nothing
  FROM orders
  UNION ALL
  SELECT l_shipdate, l_suppkey, 'yellow', l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice, NULL
  FROM lineitem
"""


MONTHLY = f"""
    SELECT zone AS revenue_zone, CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month,
           service_type,
           {money('fare')} AS revenue_monthly_fare,
           {money('extra')} AS revenue_monthly_extra,
           {money('tax')} AS revenue_monthly_mta_tax,
           {money('tax')} AS revenue_monthly_tip_amount,
           {money('nothing')} AS revenue_monthly_tolls_amount,
           {money('nothing')} AS revenue_monthly_improvement_surcharge,
           {money('total')} AS revenue_monthly_total_amount,
           {money('nothing')} AS revenue_monthly_congestion_surcharge,
           {mean('passengers')} AS avg_monthly_passenger_count,
           {mean('distance')} AS avg_monthly_trip_distance
    FROM ({TRIPS}) GROUP BY 1, 2, 3
"""


@query("monthly_revenue", MONTHLY)
def monthly_revenue(t):
    return revenue.monthly_revenue(green(t), yellow(t), CENTS)


@query("monthly_revenue_kept", f"SELECT * FROM ({MONTHLY}) WHERE revenue_month IS NOT NULL")
def monthly_revenue_kept(t):
    """The same report from states kept by day: a first build, days after it with wrong fares, and those days again."""
    green_trips, yellow_trips, name = green(t), yellow(t), f"{scratch_database(t.spark, 'kept')}.parts"
    wrong = yellow_trips.withColumn("fare_amount", F.col("fare_amount") + 1)
    revenue.keep_revenue(t.spark, name, green_trips, yellow_trips, ("1990-01-01", "1997-03-15"), CENTS)
    revenue.keep_revenue(t.spark, name, green_trips, wrong, ("1997-03-15", "1999-06-10"), CENTS)
    return revenue.keep_revenue(t.spark, name, green_trips, yellow_trips, ("1997-03-15", "2010-01-01"), CENTS)


def hourly_sql(event_type: str) -> str:
    return f"""
    SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts, CAST(user_id % 7 AS INTEGER) AS zone,
           {money('value')} AS amount, COUNT(*) AS number_records
    FROM events WHERE event_type = '{event_type}' AND ts >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY 1, 2
    """


def green_hours(t):
    return revenue.hourly_revenue(hourly_trips(t, "view"), "pickup_datetime", "2024-01-02", CENTS)


def yellow_hours(t):
    return revenue.hourly_revenue(hourly_trips(t, "click"), "pickup_datetime", "2024-01-02", CENTS)


query("hourly_revenue_green", hourly_sql("view"))(green_hours)
query("hourly_revenue_yellow", hourly_sql("click"))(yellow_hours)

OUTER = f"""
  SELECT hour_ts, zone, g.amount AS green_amount, g.number_records AS green_number_records,
         y.amount AS yellow_amount, y.number_records AS yellow_number_records
  FROM ({hourly_sql('view')}) g FULL OUTER JOIN ({hourly_sql('click')}) y USING (hour_ts, zone)
"""


@query("outer_join_hourly", OUTER)
def outer_join_hourly(t):
    return revenue.outer_join_hourly(green_hours(t), yellow_hours(t))


@query(
    "revenue_by_zone",
    f"""
    SELECT hour_ts, green_amount, green_number_records, yellow_amount, yellow_number_records,
           r_name AS "Borough", n_name AS "Zone"
    FROM ({OUTER}) h JOIN nation ON h.zone = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def revenue_by_zone(t):
    return revenue.revenue_by_zone(outer_join_hourly(t), zones(t))


# The run window of the staged trips and their report.
WINDOW = ("1996-01-01", "1998-07-01")


def landed_trips(t):
    """Order lines as ingested trips; the line's order gives the payment code."""
    orders = t("orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type")
    )
    lines = t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("l_shipdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_suppkey").alias("pickup_location_id"),
        F.col("l_linenumber").alias("dropoff_location_id"),
        F.col("l_quantity").alias("fare_amount"),
        F.when(F.col("l_returnflag") == "A", "yellow").otherwise("green").alias("taxi_type"),
        "payment_type",
    )


def payment_names(t):
    """Payment names seen in the orders; code 5 is left out, so that its trips have none."""
    seen = t("orders").select("o_orderpriority").distinct()
    return seen.select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type_id"),
        F.substr("o_orderpriority", F.lit(3)).alias("payment_type_name"),
    ).where("payment_type_id <> 5")


def staged(t):
    return staging.staging_trips(landed_trips(t), payment_names(t), WINDOW)


STAGED = f"""
  SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount, taxi_type,
         payment_type_name
  FROM (
    SELECT *, row_number() OVER (
        PARTITION BY pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount, taxi_type
        ORDER BY payment_type ASC NULLS FIRST) AS rank
    FROM (
      SELECT l_shipdate AS pickup_datetime, l_shipdate AS dropoff_datetime, l_suppkey AS pickup_location_id,
             l_linenumber AS dropoff_location_id, l_quantity AS fare_amount,
             CASE WHEN l_returnflag = 'A' THEN 'yellow' ELSE 'green' END AS taxi_type,
             CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ) t
    LEFT JOIN (
      SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type_id,
             substr(o_orderpriority, 3) AS payment_type_name
      FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5'
    ) p ON t.payment_type = p.payment_type_id
    WHERE pickup_datetime >= TIMESTAMP '{WINDOW[0]}' AND pickup_datetime < TIMESTAMP '{WINDOW[1]}'
  ) WHERE rank = 1
"""

query("staging_trips", STAGED)(staged)

REPORT = f"""
  SELECT CAST(pickup_datetime AS DATE) AS trip_date, taxi_type, payment_type_name AS payment_type,
         COUNT(*) AS trip_count, {money('fare_amount')} AS total_fare, {mean('fare_amount')} AS avg_fare
  FROM ({STAGED}) GROUP BY 1, 2, 3
"""


@query("trips_report", REPORT)
def trips_report(t):
    return staging.trips_report(staged(t), WINDOW, CENTS)


@query(
    "top_payment_types",
    f"""
    SELECT payment_type, CAST(SUM(trip_count) AS BIGINT) AS trips FROM ({REPORT})
    GROUP BY 1 ORDER BY trips DESC, payment_type ASC NULLS FIRST LIMIT 10
    """,
)
def top_payment_types(t):
    return staging.top_payment_types(trips_report(t))


# The run window of the asset pipeline: one of its months has landed as CSV.
BUILT = (dt.date(1996, 1, 1), dt.date(1996, 7, 1))


@query(
    "asset_pipeline",
    f"""
    SELECT CAST(pickup AS DATE) AS trip_date, taxi_type, payment_type_name AS payment_type, COUNT(*) AS trip_count,
           {money('fare')} AS total_fare, {mean('fare')} AS avg_fare,
           0 AS days_written_again, 0 AS trips_ingested_again, 0 AS landed_columns_lost
    FROM (
      SELECT l_shipdate AS pickup, l_suppkey, l_extendedprice AS fare,
             CASE WHEN l_returnflag = 'A' THEN 'yellow' ELSE 'green' END AS taxi_type, MIN(l_linenumber) AS code
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{BUILT[0]}' AND l_shipdate < TIMESTAMP '{BUILT[1]}'
      GROUP BY ALL) t
    LEFT JOIN (
      SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type_id,
             substr(o_orderpriority, 3) AS payment_type_name
      FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5') p ON code = payment_type_id
    GROUP BY 1, 2, 3
    """,
)
def asset_pipeline(t):
    """Landed lines ingested, staged and reported, with all checks, twice: the second run writes no day and no trip."""
    spark, root, seed = t.spark, land_lines(t), workspace(t.spark, "seed")
    payment_names(t).write.option("header", True).csv(seed)
    bases = {base: scratch_database(spark, base) for base in ("ingestion", "staging", "reports")}
    names = [f"{bases['staging']}.trips", f"{bases['reports']}.trips_report"]
    days = (strategies.DAY, "trip_date")
    files = []
    for _ in range(2):
        report = staging.build_trip_tables(
            spark, root, seed, ["yellow", "green"], BUILT, layout=LANDED_AS, bases=bases, skip_ingested=True, scale=CENTS
        )
        stored = [day_files(spark, name, day, *BUILT) for name, day in zip(names, days, strict=True)]
        files.append((stored, count_rows(spark.table(f"{bases['ingestion']}.trips")).first()[0]))
    (first, before), (second, after) = files
    written = sum(a.get(day) != digest for a, b in zip(first, second, strict=True) for day, digest in b.items())
    lost = {"trip_distance", "passenger_count", "total_amount", "refused"} - {*spark.table(f"{bases['ingestion']}.trips").columns}
    return report.withColumns(
        {"days_written_again": F.lit(written), "trips_ingested_again": F.lit(after - before), "landed_columns_lost": F.lit(len(lost))}
    )


@query("name_counts", "SELECT c_mktsegment AS name, COUNT(*) AS player_count FROM customer GROUP BY 1")
def name_counts(t):
    return rankings.name_counts(t("customer").select(F.col("c_mktsegment").alias("name")))


@query(
    "top_trips_by_distance",
    """
    SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice AS trip_distance FROM orders
    WHERE o_totalprice < 400000 ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 5
    """,
)
def top_trips_by_distance(t):
    trips = t("orders").select(
        "o_orderkey", F.col("o_orderdate").alias("pickup_datetime"), F.col("o_totalprice").alias("trip_distance")
    )
    return rankings.top_trips_by_distance(trips, 400000.0, ["o_orderkey"])


@query(
    "top_zone_by_total",
    f"""
    SELECT n_name AS pickup_zone, {money('l_extendedprice')} AS sum_total_amount
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    WHERE l_shipdate >= TIMESTAMP '1998-11-18' AND l_shipdate < TIMESTAMP '1998-11-19'
    GROUP BY 1 ORDER BY sum_total_amount DESC, pickup_zone LIMIT 1
    """,
)
def top_zone_by_total(t):
    trips = yellow(t).withColumnRenamed("tpep_pickup_datetime", "pickup_datetime")
    return rankings.top_zone_by_total(trips, supplier_zones(t), "1998-11-18", scale=CENTS)


@query(
    "largest_tip_dropoff",
    """
    SELECT d.n_name AS dropoff_zone, l_tax AS tip_amount, o_orderdate AS pickup_datetime
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation p ON s_nationkey = p.n_nationkey
    JOIN nation d ON c_nationkey = d.n_nationkey
    WHERE p.n_name = 'NATION_3' AND o_orderdate >= TIMESTAMP '1998-11-01' AND o_orderdate < TIMESTAMP '1998-12-01'
    ORDER BY l_tax DESC NULLS LAST, o_orderdate, l_orderkey, l_linenumber, d.n_name LIMIT 1
    """,
)
def largest_tip_dropoff(t):
    return rankings.largest_tip_dropoff(
        line_trips(t), zones(t), "NATION_3", "1998-11-01", "1998-12-01",
        ["pickup_datetime", "l_orderkey", "l_linenumber"],
    )


@query(
    "least_busy_zones",
    """
    SELECT n_name AS "Zone", COUNT(*) AS trips
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1 ORDER BY trips, 1 LIMIT 5
    """,
)
def least_busy_zones(t):
    return rankings.least_busy_zones(yellow(t), supplier_zones(t))


@query(
    "longest_duration_hours",
    """
    SELECT MAX((floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 3600.0::DOUBLE) AS max_hours
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL AND l_shipdate >= o_orderdate
    """,
)
def longest_duration_hours(t):
    orders = t("orders").select("o_orderkey", "o_orderdate")
    trips = t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rankings.longest_duration_hours(trips, "o_orderdate", "l_shipdate")


BASES = """
  SELECT CASE WHEN l_suppkey % 7 = 0 THEN 's' WHEN l_suppkey % 3 = 0 THEN 'a' ELSE 'e' END
           || printf('/%03x', l_suppkey) AS base_id,
         CAST(l_shipdate AS DATE) AS pickup_date, CAST(l_shipdate AS DATE) + l_linenumber AS dropoff_date,
         l_suppkey AS "PULocationID", l_partkey AS "DOLocationID"
  FROM lineitem
"""
BASE_COLUMNS = ("dispatching_base_num", "pickup_datetime", "dropoff_datetime", ["PULocationID", "DOLocationID"])


@query("base_id_native", BASES)
def base_id_native(t):
    return rankings.base_report(for_hire(t), *BASE_COLUMNS)


@query("base_id_udf", BASES)
def base_id_by_udf(t):
    return rankings.base_report(for_hire(t), *BASE_COLUMNS, label=base_id_udf())


@query(
    "filter_equals",
    """
    SELECT l_shipdate AS pickup_datetime, l_suppkey AS "PULocationID", l_partkey AS "DOLocationID"
    FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def filter_equals(t):
    return rankings.licence_trips(for_hire(t), "R", ["pickup_datetime", "PULocationID", "DOLocationID"])


@query(
    "daily_zone_stats",
    """
    SELECT CAST(ts AS DATE) AS day, user_id AS zone, MAX(value) AS max_total,
           MAX(CAST(json_extract(props, '$.k') AS INTEGER)) AS max_passengers, COUNT(*) AS trips
    FROM events GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def daily_zone_stats(t):
    trips = t("events").withColumn("passengers", F.get_json_object("props", "$.k").cast("int"))
    return rankings.daily_zone_stats(trips, "ts", "user_id", {"max_total": "value", "max_passengers": "passengers"})


@query(
    "daily_stats_by_count",
    """
    SELECT CAST(l_shipdate AS DATE) AS day, MAX(l_extendedprice) AS max_total, MAX(l_linenumber) AS max_passengers,
           COUNT(*) AS trips
    FROM lineitem GROUP BY 1 ORDER BY trips DESC, day
    """,
)
def daily_stats_by_count(t):
    return rankings.daily_stats_by_count(
        t("lineitem"), "l_shipdate", {"max_total": "l_extendedprice", "max_passengers": "l_linenumber"}
    )


@query(
    "trip_zone_names",
    names_sql := """
    SELECT o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime, l_extendedprice AS total_amount,
           pr.r_name || ' / ' || p.n_name AS pickup_location, dr.r_name || ' / ' || d.n_name AS dropoff_location
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation p ON s_nationkey = p.n_nationkey JOIN region pr ON p.n_regionkey = pr.r_regionkey
    JOIN nation d ON c_nationkey = d.n_nationkey JOIN region dr ON d.n_regionkey = dr.r_regionkey
    """,
)
def trip_zone_names(t):
    named = rankings.trip_zone_names(line_trips(t), zones(t))
    return named.select("pickup_datetime", "dropoff_datetime", "total_amount", "pickup_location", "dropoff_location")


@query("trip_zone_names_comma", names_sql)
def trip_zone_names_comma(t):
    """The same with the join terms in WHERE."""
    return t.spark.sql(
        """
        SELECT pickup_datetime, dropoff_datetime, total_amount,
               concat(coalesce(p.Borough, ''), ' / ', coalesce(p.Zone, '')) AS pickup_location,
               concat(coalesce(d.Borough, ''), ' / ', coalesce(d.Zone, '')) AS dropoff_location
        FROM {trips} t, {zones} p, {zones} d
        WHERE t.PULocationID = p.LocationID AND t.DOLocationID = d.LocationID
        """,
        trips=line_trips(t),
        zones=zones(t),
    )
