"""Catalog tables: create, copy, partition, load."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import day_of
from meterline.session import scratch_database
from meterline.sinks.files import balanced
from meterline.sources.files import read_parquet
from meterline.sources.schemas import common_schema, widen
from meterline.sources.tables import quoted


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_options(spark: SparkSession, name: str) -> dict[str, str]:
    """Write options kept with a table."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}
    pairs = (pair.partition("=") for pair in told.get("Storage Properties", "[]")[1:-1].split(", ") if pair)
    return {key: value for key, _, value in pairs if key not in ("path", "serialization.format")}


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), **options) -> DataFrame:
    """Drop and rebuild a table from the frame, which must not read that table.

    Write options are kept with the table and hold for later inserts too.
    """
    if partition_by:
        df = balanced(df, *partition_by)
    df.write.mode("overwrite").format("parquet").options(**options).partitionBy(*partition_by).saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Compute a frame once, for several uses: a table in the shared folder, dropped afterwards.

    Unlike a cache, it outlives lost executors, and its true size is known to the planner.
    """
    spark = df.sparkSession
    base = scratch_database(spark, label)
    try:
        yield replace_table(df, f"{base}.held")
    finally:
        spark.sql(f"DROP DATABASE {quoted(base)} CASCADE")


def ctas(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Copy a frame, such as an external table, to a native table."""
    return replace_table(df, name)


def ctas_partitioned(
    df: DataFrame, name: str, time_column: str, cluster_by: Sequence[str], day_column: str = "day"
) -> DataFrame:
    """Copy to a table in day partitions, clustered: rows are sorted by the cluster columns in each file.

    Sorted files let the reader skip row groups by their minimum and maximum. Buckets would
    put all rows of one frequent cluster value in one file per day.
    """
    dated = df.withColumn(day_column, day_of(F.col(time_column)))
    sorted_rows = balanced(dated, day_column).sortWithinPartitions(day_column, *cluster_by)
    sorted_rows.write.mode("overwrite").format("parquet").partitionBy(day_column).saveAsTable(name)
    return df.sparkSession.table(name)


#: Values per column that ranges are made from, and bits of a range's number.
SAMPLE, BITS = 20_000, 5


def _borders(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Up to 2^BITS - 1 values of each column that part it evenly, from a sample of about SAMPLE rows."""
    rows = df.count()
    picked = df.select(*columns).sample(min(1.0, SAMPLE / max(rows, 1)), seed=0).limit(2 * SAMPLE)
    parts, found = 1 << BITS, {}
    sample = picked.collect()
    for place, column in enumerate(columns):
        values = sorted(row[place] for row in sample if row[place] is not None)
        found[column] = sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []
    return found


def _range_number(column: Column, borders: Sequence) -> Column:
    """How many borders a value reaches, by halving; NULL reaches none."""
    if not borders:
        return F.lit(0)
    middle = len(borders) // 2
    above = _range_number(column, borders[middle + 1 :]) + (middle + 1)
    return F.when(column >= F.lit(borders[middle]), above).otherwise(_range_number(column, borders[:middle]))


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """A number that orders rows by all columns alike: the bits of the columns' ranges in turn, the highest first."""
    borders = _borders(df, columns)
    numbers = [_range_number(F.col(c), borders[c]) for c in columns]
    bits = [
        F.shiftleft(F.shiftright(number, bit).bitwiseAND(1), bit * len(columns) + len(columns) - 1 - k)
        for bit in range(BITS)
        for k, number in enumerate(numbers)
    ]
    return reduce(Column.bitwiseOR, (bit.cast("long") for bit in bits))


def ctas_interleaved(
    df: DataFrame, name: str, time_column: str, cluster_by: Sequence[str], day_column: str = "day"
) -> DataFrame:
    """Copy to a table in day partitions whose files are each a small range of every cluster column.

    Sorting by one column after the other lets a reader skip files by the first only. Here a filter on any of the columns
    skips files and row groups. A day that holds most of the rows is parted into many files, rows of one place by a hash.
    """
    dated = df.withColumn(day_column, day_of(F.col(time_column)))
    placed = dated.withColumns({"__place": interleaved(df, cluster_by), "__hash": F.xxhash64(*df.columns)})
    ranged = placed.repartitionByRange(day_column, "__place", "__hash").sortWithinPartitions(day_column, "__place")
    ranged.drop("__place", "__hash").write.mode("overwrite").format("parquet").partitionBy(day_column).saveAsTable(name)
    return df.sparkSession.table(name)


#: Partition column of keyed tables, and the table properties that say what it is made of.
SLOT, SLOT_KEYS, SLOTS = "_slot", "meterline.slot_keys", "meterline.slots"


def _slot(columns: Sequence[str], keys: Sequence[str], slots: int) -> Column:
    """Slot of a row by its key. Rows without a whole key match nothing, so they are spread by all their columns."""
    whole = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    hash_ = F.when(whole, F.xxhash64(*keys)).otherwise(F.xxhash64(*columns))
    return F.pmod(hash_, F.lit(slots)).cast("int")


def keyed_table(df: DataFrame, name: str, keys: Sequence[str], slots: int, **options) -> DataFrame:
    """Build a table that upserts by the keys can reach into: partitioned by a hash of them, which is kept with the table.

    An upsert reads and rewrites the slots that hold one of its keys. Choose their number so that one slot is a file or two.
    """
    keys = sorted(keys)
    replace_table(df.withColumn(SLOT, _slot(df.columns, keys, slots)), name, [SLOT], **options)
    kept = f"'{SLOT_KEYS}' = '{','.join(keys)}', '{SLOTS}' = '{slots}'"
    df.sparkSession.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ({kept})")
    return df.sparkSession.table(name)


def slot_keys(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """Keys and number of the slots of a keyed table."""
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
    return (told[SLOT_KEYS].split(","), int(told[SLOTS])) if SLOT_KEYS in told else None


def with_slot(df: DataFrame, name: str) -> DataFrame:
    """Add the slot, if the table is a keyed one."""
    keyed = slot_keys(df.sparkSession, name)
    columns = [c for c in df.columns if c != SLOT]
    return df.withColumn(SLOT, _slot(columns, *keyed)) if keyed else df


def append_rows(df: DataFrame, name: str) -> DataFrame:
    """Insert rows, matching columns by name, and touch nothing that is there."""
    spark = df.sparkSession
    df = with_slot(df, name)
    rows, partitions = df.select(*spark.table(name).columns), partition_columns(spark, name)
    if partitions:
        rows = balanced(rows, *partitions)
    rows.write.insertInto(name, overwrite=False)
    return spark.table(name)


def fit_table(df: DataFrame, name: str) -> DataFrame:
    """The frame with the table's columns and types; columns that the table lacks are added to it first.

    A column that the frame lacks is NULL. One whose values the table's type does not hold is refused: only
    a new table can have a wider one.
    """
    spark = df.sparkSession
    stored = spark.table(name).schema
    both = common_schema([stored, df.schema])
    wider = [f"{f.name}: {f.dataType.simpleString()}" for f, own in zip(both.fields, stored.fields) if f.dataType != own.dataType]
    if wider:
        raise ValueError(f"{name} would have to be built anew with {', '.join(wider)}")
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in both.fields[len(stored.fields) :]]
    if added:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({', '.join(added)})")
    partitions = set(partition_columns(spark, name))
    return widen(df, T.StructType([f for f in both.fields if f.name not in partitions or f.name in df.columns]))


def load_table(df: DataFrame, name: str, mode: str = "replace", batch_rows: int | None = None) -> DataFrame:
    """Create the table empty from the frame's schema if replacing, then append.

    With `batch_rows`, the table's files hold at most so many rows. That is set when it is created:
    inserts take write options from the table, not from the writer.
    """
    if mode == "replace":
        replace_table(df.limit(0), name, **({"maxRecordsPerFile": batch_rows} if batch_rows else {}))
    elif mode != "append":
        raise ValueError(f"unknown mode {mode!r}")
    return append_rows(df, name)


def multi_source_replace(spark: SparkSession, paths: Sequence[str], name: str) -> DataFrame:
    """Many files into one table, replacing it."""
    return replace_table(read_parquet(spark, *paths), name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
