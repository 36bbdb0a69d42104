"""Loads of normalised records, their history and their incremental state."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.nested import LOAD_ID, MARK, TABLE, FannedOut, fan_out, schema_version
from meterline.operators.ordering import dedup
from meterline.sinks.files import write_parquet
from meterline.sources.files import read_if_there

LOADS, STATE, EDGES = "_loads", "_state", "_edges"
LOADED = 0


def _append(root: str, table: str, rows: DataFrame) -> None:
    """Add the few rows of one load to a bookkeeping table."""
    write_parquet(rows, f"{root}/{table}", "append", files=1)


def replace_load(
    records: DataFrame,
    root: str,
    table: str,
    keys: Sequence[str],
    load_id: str,
    order: Sequence[str] | None = None,
    loaded_at: dt.datetime | None = None,
    spread: bool = False,
) -> dict[str, DataFrame]:
    """Normalise records, one per key, and put the tables in the place of those of the last load.

    One pass makes, writes and counts the rows of all tables, in a folder of the load's own. Its row in the history is
    written last and names that folder: readers go by it, so they see one load or the other whole, and a load that
    was lost halfway leaves the last one in place. The load before the last is kept for those still reading it.
    """
    spark = records.sparkSession
    fanned = fan_out(dedup(records, keys, order), table, keys, load_id, spread)
    folder = f"{root}/{table}/{load_id}-{uuid.uuid4().hex}"
    seen = Observation(f"rows of {table}")
    fanned.rows.observe(seen, *fanned.counts()).write.partitionBy(TABLE).parquet(folder)
    earlier = _finished(spark, root, table)
    record_load(spark, root, load_id, table, schema_version(records), loaded_at, len(earlier), folder, seen.get, fanned.rows.schema)
    for load in earlier[:-1]:
        _remove(spark, load["folder"])
    return stored_tables(spark, root, table)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def record_load(
    spark: SparkSession,
    root: str,
    load_id: str,
    table: str,
    version: str,
    loaded_at: dt.datetime | None = None,
    turn: int = 0,
    folder: str | None = None,
    row_counts: dict[str, int] | None = None,
    stored: T.StructType | None = None,
) -> None:
    at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    columns = (
        f"{LOAD_ID} string, table_name string, status int, schema_version string, loaded_at timestamp_ntz, "
        "turn long, folder string, row_counts map<string, long>, stored string"
    )
    row = (load_id, table, LOADED, version, at, turn, folder, row_counts, stored.json() if stored else None)
    _append(root, LOADS, spark.createDataFrame([row], columns))


def load_history(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{LOADS}")


def _finished(spark: SparkSession, root: str, table: str) -> list[Row]:
    """The finished loads of a table, the last one last: one row for each load comes to the driver."""
    history = read_if_there(spark, f"{root}/{LOADS}")
    if history is None:
        return []
    return history.where((F.col("table_name") == table) & (F.col("status") == LOADED)).orderBy("turn").collect()


def stored_tables(spark: SparkSession, root: str, table: str) -> dict[str, DataFrame]:
    """The tables of the last finished load, all of that load."""
    loads = _finished(spark, root, table)
    if not loads:
        raise FileNotFoundError(f"no finished load of {table} below {root}")
    load = loads[-1]
    rows = spark.read.schema(T.StructType.fromJson(json.loads(load["stored"]))).parquet(load["folder"])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    flat = {
        name: [f.name for f in kinds[name].fields if f.name != MARK] if name in kinds else [] for name in load["row_counts"]
    }
    fanned = FannedOut(rows, flat, table, load[LOAD_ID])
    return {name: fanned.table(name) for name in sorted(flat, key=lambda name: (len(name), name))}


def _state(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    return read_if_there(spark, f"{root}/{STATE}/{table}")


def _increments(source: DataFrame, root: str, table: str) -> DataFrame:
    """All loads of a table. Load ids are text even where they look like numbers."""
    loads = T.StructType([*source.schema.fields, T.StructField(LOAD_ID, T.StringType())])
    return source.sparkSession.read.schema(loads).parquet(f"{root}/{table}")


def _edge_rows(rows: DataFrame) -> GroupedData:
    """Groups of equal rows, by a hash of 16 bytes that tells NULLs apart."""
    cells = [x for c in rows.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    digest = F.struct(*(F.xxhash64(F.lit(seed), *cells).alias(f"h{seed}") for seed in (0, 1)))
    return rows.groupBy(digest.alias("digest"))


def _not_kept(tied: DataFrame, edge: DataFrame) -> DataFrame:
    """The tied rows beyond those that the edge has, as often as they are more."""
    cells = F.struct(*(F.col(f"`{c}`") for c in tied.columns))
    counted = _edge_rows(tied).agg(F.first(cells).alias("row"), F.count("*").alias("now"))
    more = counted.join(edge, "digest", "left").withColumn("more", F.col("now") - F.coalesce("n", F.lit(0)))
    return more.where("more > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("more")))).select("row.*")


def load_increment(source: DataFrame, root: str, table: str, cursor: str, load_id: str) -> DataFrame:
    """Append the source rows from the last cursor value on that are not kept yet, and keep the new value.

    The state also keeps digests of the rows at the last value and how often each occurs. Rows that tie with it are compared
    with those, so no kept load is read again.

    One row of state comes to the driver; its cursor goes into the filter and so reaches the
    scan. A row without a cursor value would be in no load, so it fails the load. Every load has
    a folder of its own: a load run again before its state was kept replaces that folder, and
    one run again afterwards does nothing.
    """
    spark = source.sparkSession
    state = _state(spark, root, table)
    kind = source.schema[cursor].dataType
    fresh, last, edge = source, None, None
    if state is not None:
        done = state.agg(
            F.max("cursor").alias("cursor"), F.count_if(F.col(LOAD_ID) == load_id).alias("n"), F.max_by("edge", "turn").alias("edge")
        ).first()
        if done["n"]:
            return _increments(source, root, table)
        if done["cursor"] is not None:
            last, edge = F.lit(str(done["cursor"])).cast(kind), spark.read.parquet(done["edge"])
            tied = _not_kept(source.where(F.col(cursor) == last), edge)
            fresh = source.where((F.col(cursor) > last) | F.col(cursor).isNull()).union(tied)
    unknown = F.raise_error(F.lit(f"row without {cursor}")).cast(kind)
    fresh = fresh.withColumn(cursor, F.when(F.col(cursor).isNotNull(), F.col(cursor)).otherwise(unknown))
    folder = f"{root}/{table}/{LOAD_ID}={load_id}"
    write_parquet(fresh, folder, "overwrite")
    stored = spark.read.schema(fresh.schema).parquet(folder)
    newest = stored.agg(F.max(cursor)).first()[0]
    at_newest = F.lit(False) if newest is None else F.col(cursor) == F.lit(str(newest)).cast(kind)
    new_edge = _edge_rows(stored.where(at_newest)).agg(F.count("*").alias("n"))
    if edge is not None and (newest is None or newest == done["cursor"]):
        new_edge = new_edge.union(edge).groupBy("digest").agg(F.sum("n").alias("n"))
    edge_folder = f"{root}/{EDGES}/{table}/{uuid.uuid4().hex}"
    write_parquet(new_edge, edge_folder)
    columns = T.StructType([
        T.StructField(LOAD_ID, T.StringType()), T.StructField("cursor", kind), T.StructField("turn", T.LongType()),
        T.StructField("edge", T.StringType()),
    ])
    turn = 0 if state is None else state.count()
    _append(root, f"{STATE}/{table}", spark.createDataFrame([(load_id, newest, turn, edge_folder)], columns))
    return _increments(source, root, table)


def load_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One row for the table: its last load and cursor value."""
    state = _state(spark, root, table)
    latest = state.agg(F.max_by(LOAD_ID, "turn").alias(LOAD_ID), F.max("cursor").alias("cursor"))
    return latest.select(F.lit(table).alias("table_name"), LOAD_ID, "cursor")
