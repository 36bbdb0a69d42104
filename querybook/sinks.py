"""Sinks and build strategies: write to the shared folder, return what is stored there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators.aggregates import group_measures
from meterline.operators.filters import closed_range, half_open
from meterline.operators.ordering import dedup
from meterline.operators.sets import unite
from meterline.plans.rankings import name_counts
from meterline.session import scratch_database, workspace
from meterline.sinks import files, strategies, tables
from meterline.sources.tables import external_table
from querybook.feeds import CENTS
from querybook.registry import query


def new_table(t, label: str) -> str:
    return f"{scratch_database(t.spark, label)}.stored"


@query("write_errorifexists", "SELECT *, true AS second_refused FROM orders")
def write_errorifexists(t):
    path = workspace(t.spark, "once")
    files.write_parquet(t("orders"), path)
    try:
        files.write_parquet(t("orders"), path)
        refused = False
    except AnalysisException:
        refused = True
    return t.spark.read.parquet(path).withColumn("second_refused", F.lit(refused))


@query("write_overwrite", "SELECT * FROM customer")
def write_overwrite(t):
    path = workspace(t.spark, "replaced")
    files.write_parquet(t("orders"), path)
    files.write_parquet(t("customer"), path, "overwrite")
    return t.spark.read.parquet(path)


ROWS_PER_FILE = 10_000_000


@query(
    "write_repartitioned",
    "SELECT COUNT(*) AS row_count, CAST(greatest(4, ceil(COUNT(*) / 10000000.0)) AS BIGINT) AS files FROM lineitem",
)
def write_repartitioned(t):
    """Even files: four, or as many as keep each below ten million rows."""
    path, lines = workspace(t.spark, "spread"), t("lineitem")
    files.write_parquet(lines, path, files=files.even_files(lines, 4, ROWS_PER_FILE))
    per_file = t.spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("row_count"), F.count("*").alias("files"))


@query(
    "write_single_file",
    """
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
           COUNT(*) AS orders, CAST(1 AS BIGINT) AS files
    FROM orders GROUP BY 1
    """,
)
def write_single_file(t):
    """A report of one row per day in one file."""
    path = workspace(t.spark, "single")
    days = [F.to_date("o_orderdate").alias("day")]
    report = group_measures(t("orders"), days, {"total": "o_totalprice"}, count="orders", scale=CENTS)
    files.write_parquet(report, path, files=1)
    stored = t.spark.read.parquet(path)
    count = stored.agg(F.count_distinct("_metadata.file_path").alias("n"))
    return stored.withColumn("files", count.scalar())


@query(
    "csv_to_parquet_months",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders
    """,
)
def csv_to_parquet_months(t):
    landed, out = workspace(t.spark, "csv"), workspace(t.spark, "months")
    orders = t("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    orders.write.option("header", True).option("compression", "gzip").csv(landed)
    files.csv_to_parquet_months(t.spark, landed, orders.schema, "o_orderdate", out)
    return t.spark.read.parquet(out)


@query("load_replace_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def load_replace_append(t):
    """Two replacing loads leave one copy, an appending one adds the second."""
    name = new_table(t, "load")
    for mode in ("replace", "replace", "append"):
        stored = tables.load_table(t("customer"), name, mode)
    return stored


@query("multi_file_single_table", "SELECT * FROM orders")
def multi_file_single_table(t):
    """Orders landed in two folders, loaded as one table, replaced by a second load."""
    root, name = workspace(t.spark, "parts"), new_table(t, "multi")
    half = F.when(F.col("o_orderstatus") == "O", "open").otherwise("other")
    files.write_parquet(t("orders").withColumn("half", half), root, partition_by=["half"])
    for _ in range(2):
        stored = tables.multi_source_replace(t.spark, [f"{root}/half=open", f"{root}/half=other"], name)
    return stored


@query(
    "per_resource_layout",
    "SELECT strftime(o_orderdate, '%Y-%m') AS resource, COUNT(*) AS row_count FROM orders GROUP BY 1",
)
def per_resource_layout(t):
    root = f"{workspace(t.spark, 'resources')}/sales/orders"
    files.write_per_resource(t("orders"), root, F.date_format("o_orderdate", "'m'yyyy-MM"))
    stored = t.spark.read.parquet(root).groupBy("resource").agg(F.count("*").alias("row_count"))
    return stored.withColumn("resource", F.substring("resource", 2, 7))


@query("ctas_count", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT l_suppkey) AS zones FROM lineitem")
def ctas_count(t):
    """An external table copied to a native one."""
    base = scratch_database(t.spark, "warehouse")
    landed = external_table(t.spark, f"{base}.landed", f"{t.sf_dir}/lineitem*.parquet")
    native = tables.ctas(t.spark, f"{base}.native", landed)
    return native.agg(F.count("*").alias("row_count"), F.count_distinct("l_suppkey").alias("zones"))


def events_by_day(t):
    return tables.ctas_partitioned(t("events"), new_table(t, "clustered"), "ts", ["event_type"])


@query(
    "partitioned_table_distinct",
    "SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events FROM events GROUP BY 1, 2",
)
def partitioned_table_distinct(t):
    return events_by_day(t).groupBy("day", "event_type").agg(F.count("*").alias("events"))


@query(
    "distinct_vendor_pruned",
    """
    SELECT DISTINCT event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-15'
    """,
)
def distinct_vendor_pruned(t):
    stored = closed_range(events_by_day(t), "ts", "2024-01-03", "2024-01-15", date_col="day")
    return stored.select("event_type").distinct()


@query(
    "interleaved_table_lookup",
    """
    SELECT 'one user' AS wanted, event_type, COUNT(*) AS events FROM events WHERE user_id = 7 GROUP BY 2
    UNION ALL SELECT 'one type', event_type, COUNT(*) FROM events WHERE event_type = 'purchase' GROUP BY 2
    """,
)
def interleaved_table_lookup(t):
    """Events in day partitions, clustered by type and user alike, looked up by either."""
    stored = tables.ctas_interleaved(t("events"), new_table(t, "interleaved"), "ts", ["event_type", "user_id"])
    picks = {"one user": F.col("user_id") == 7, "one type": F.col("event_type") == "purchase"}
    found = [
        stored.where(wanted).groupBy("event_type").agg(F.count("*").alias("events")).select(F.lit(name).alias("wanted"), "event_type", "events")
        for name, wanted in picks.items()
    ]
    return unite(found)


SEGMENTS = "SELECT c_mktsegment AS name, COUNT(*) AS player_count FROM customer GROUP BY 1"


def segments(t):
    return name_counts(t("customer").select(F.col("c_mktsegment").alias("name")))


@query("mat_view", SEGMENTS)
def mat_view(t):
    """A view in a database, over a stored table that is built after it once more."""
    base = scratch_database(t.spark, "views")
    tables.replace_table(t("customer").limit(0), f"{base}.customers")
    query = f"SELECT c_mktsegment AS name, COUNT(*) AS player_count FROM {base}.customers GROUP BY c_mktsegment"
    view = strategies.as_catalog_view(t.spark, f"{base}.segment_counts", query)
    tables.replace_table(t("customer"), f"{base}.customers")
    return t.spark.table(f"{base}.segment_counts").select(*view.columns)


@query("mat_table", SEGMENTS)
def mat_table(t):
    name = new_table(t, "rebuilt")
    tables.replace_table(t("nation"), name)
    return tables.replace_table(segments(t), name)


@query("mat_append", "SELECT o_orderkey, o_totalprice, CAST(2 AS BIGINT) AS copies FROM orders")
def mat_append(t):
    """The same orders appended twice, then one kept per key beside the number stored."""
    name, orders = new_table(t, "appended"), t("orders").select("o_orderkey", "o_totalprice")
    tables.replace_table(orders, name)
    stored = tables.append_rows(orders.select("o_totalprice", "o_orderkey"), name)
    copies = stored.groupBy(F.col("o_orderkey").alias("key")).agg(F.count("*").alias("copies"))
    once = dedup(stored, ["o_orderkey"])
    return once.join(copies, F.col("o_orderkey") == F.col("key")).drop("key")


@query(
    "mat_merge",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus FROM orders
    UNION ALL SELECT -1 - o_orderkey, o_totalprice, 'N' FROM orders WHERE o_orderstatus = 'P'
    """,
)
def mat_merge(t):
    """Open orders get another price, and each pending order a new twin, in a table kept by a hash of the key."""
    name, orders = new_table(t, "merged"), t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    tables.keyed_table(orders, name, ["o_orderkey"], slots=8)
    changed = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.where("o_orderstatus = 'P'").select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", F.lit("N").alias("o_orderstatus")
    )
    return strategies.merge(t.spark, name, changed.unionByName(new), ["o_orderkey"]).drop(tables.SLOT)


@query(
    "mat_delete_insert",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_returnflag = 'R')
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def mat_delete_insert(t):
    """All lines of an order with returns give way to its changed returned lines."""
    name, lines = new_table(t, "deleted"), t("lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    tables.replace_table(lines.select(*columns), name)
    returned = lines.where("l_returnflag = 'R'").select(*columns).withColumn("l_quantity", F.col("l_quantity") + 1)
    return strategies.delete_insert(t.spark, name, returned, ["l_orderkey"])


LO, HI = "2024-01-10 06:00:00", "2024-01-20 06:00:00"


@query(
    "mat_time_interval",
    f"""
    SELECT event_id, ts, event_type, value FROM events
    WHERE (ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}') IS NOT TRUE
    UNION ALL
    SELECT event_id, ts, event_type, value + 1 FROM events
    WHERE ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}' AND event_type <> 'error'
    """,
)
def mat_time_interval(t):
    """A window off midnight rebuilt without errors and with other values."""
    name, events = new_table(t, "interval"), t("events").select("event_id", "ts", "event_type", "value")
    by_day = events.withColumn(strategies.DAY, F.to_date("ts"))
    tables.replace_table(by_day, name, [strategies.DAY])
    rebuilt = half_open(events, "ts", LO, HI).where("event_type <> 'error'")
    rebuilt = rebuilt.withColumn("value", F.col("value") + 1)
    return strategies.time_interval(t.spark, name, rebuilt, "ts", LO, HI).drop(strategies.DAY)
