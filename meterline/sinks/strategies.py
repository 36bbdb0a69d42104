"""Ways to bring a declared table up to date: view, table, append, merge, delete_insert, time_interval."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.clock import day_of, month_start
from meterline.operators.filters import as_moment, half_open, in_half_open, last_day_below
from meterline.operators.sets import unite
from meterline.sinks.files import balanced
from meterline.sinks.ledger import LEDGER, Built, day_digests, day_files, known, record
from meterline.sinks.tables import (
    SLOT, append_rows, drop_table, fit_table, held, keyed_table, partition_columns, replace_table, slot_keys, table_options,
    with_slot,
)
from meterline.sources.tables import quoted
from meterline.spec import TableSpec

DAY, MONTH = "_day", "_month"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_mode = RLock()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Store nothing; the view follows its sources for the life of the session, so its name has no database."""
    if "." in name:
        raise ValueError(f"{name}: a view of a database is made from a query, by as_catalog_view")
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_catalog_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Store a query over stored tables and views in the catalog, for every session that shares it.

    A query over session views is refused by Spark, as they would be gone.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {query}")
    return spark.table(name)


def _swap_in(spark: SparkSession, new: DataFrame, name: str) -> DataFrame:
    """Put a new version in a table's place.

    The version is complete before the old one moves aside, and the old one is dropped last.
    A job lost between the two renames leaves the old one aside; `put_back` undoes that.
    """
    following, previous = f"{name}__next", f"{name}__previous"
    drop_table(spark, previous)
    replace_table(new, following, partition_columns(spark, name), **table_options(spark, name))
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(previous)}")
    try:
        spark.sql(f"ALTER TABLE {quoted(following)} RENAME TO {quoted(name)}")
    except Exception:
        spark.sql(f"ALTER TABLE {quoted(previous)} RENAME TO {quoted(name)}")
        raise
    drop_table(spark, previous)
    return spark.table(name)


def put_back(spark: SparkSession, name: str) -> None:
    """Return the old version to its place if a swap was lost halfway."""
    previous = f"{name}__previous"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(previous):
        spark.sql(f"ALTER TABLE {quoted(previous)} RENAME TO {quoted(name)}")


def without_keys(target: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(known, list(keys), "left_anti")


def _replace_keys(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], follows: bool = False, once: bool = False
) -> DataFrame:
    """Rows of the table whose key is not in the source, and all source rows.

    The source's keys are computed first and held: a small set is broadcast, and against a
    large one both join sides are plain shuffles, so that adaptive execution can split the
    table's rows of one frequent key; an aggregate below the join would prevent that. `once`: each whole key may
    occur once.

    Of a partitioned table only those partitions are rewritten that hold such a key or get a row. If the partition
    columns are keys, or follow from them, as `follows` says and as slots of a keyed table do, these are the source's own;
    otherwise the keys are looked up in the table.
    """
    put_back(spark, name)
    target = spark.table(name)
    columns, partitions = target.columns, partition_columns(spark, name)
    if SLOT in partitions:
        source, follows = with_slot(source, name), follows or set(slot_keys(spark, name)[0]) <= set(keys)
    with held(source.groupBy(*keys).agg(F.count("*").alias("__n")), "keys") as counted:
        if once and not counted.dropna(subset=list(keys)).where("__n > 1").isEmpty():
            raise ValueError(f"merge into {name}: source has several rows for one key")
        known = counted.drop("__n")
        if not partitions:
            kept = without_keys(target, known, keys).select(*columns)
            _swap_in(spark, unite([kept, source.select(*columns)]), name)
            return spark.table(name)
        gets, holds = source.select(*partitions).distinct(), None
        if not follows and not set(partitions) <= set(keys):
            holds = target.join(known, list(keys), "left_semi").select(*partitions).distinct()
        with _reach(gets if holds is None else gets.union(holds).distinct()) as reached:
            kept = without_keys(reached(target), known, keys).select(*columns)
            overwrite_partitions(unite([kept, source.select(*columns)]), name)
            # a partition that all rows have left was not written, so its old rows are still there
            if holds is not None:
                again = reached(spark.table(name))
                left = again.join(gets, _same(again, gets), "left_anti")
                stale = left.join(known, list(keys), "left_semi").select(*partitions).distinct()
                _drop_partitions(spark, name, partitions, stale)
    return spark.table(name)


#: Partitions whose values are listed in a filter; more of them are joined with.
LISTED = 2000


def _name_of(partitions: Sequence[str]) -> Column:
    """The values of a partition as one text, apart from any other's."""
    return F.to_json(F.struct(*partitions), {"ignoreNullFields": "false"})


def _same(table: DataFrame, partitions: DataFrame) -> Column:
    return reduce(Column.__and__, (table[c].eqNullSafe(partitions[c]) for c in partitions.columns))


@contextmanager
def _reach(touched: DataFrame) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A filter for the rows of a table's touched partitions; others are not listed or read, unless many are touched."""
    columns = touched.columns
    values = [tuple(row) for row in touched.limit(LISTED + 1).collect()]
    if len(values) > LISTED:
        with held(touched, "partitions") as many:
            yield lambda table: table.join(many, _same(table, many), "left_semi")
    elif len(columns) == 1:
        given = F.col(columns[0]).isin([v for (v,) in values if v is not None])
        yield lambda table: table.where(given | F.col(columns[0]).isNull() if (None,) in values else given)
    else:
        spark = touched.sparkSession
        named = spark.createDataFrame(values, touched.schema).select(_name_of(columns))
        names = [r[0] for r in named.collect()]
        yield lambda table: table.where(_name_of(columns).isin(names))


def _drop_partitions(spark: SparkSession, name: str, partitions: Sequence[str], stale: DataFrame) -> None:
    """Drop partitions by their values, some hundreds in one statement."""
    specs = []
    for row in stale.collect():
        values = ("NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for v in row)
        specs.append("PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in zip(partitions, values, strict=True)) + ")")
    for a in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {', '.join(specs[a : a + 500])}")


def merge(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], follows: bool = False) -> DataFrame:
    """Update rows with a matching key, insert the others. A repeated source key is an error.

    NULL matches nothing: such source rows are inserted. `follows`: the partition column is derived from a key.
    """
    with held(source, "merge") as rows:
        return _replace_keys(spark, name, rows, keys, follows, once=True)


def refuse_repeats(source: DataFrame, name: str, keys: Sequence[str]) -> None:
    if not source.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"merge into {name}: source has several rows for one key")


def delete_insert(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], follows: bool = False) -> DataFrame:
    """Delete rows with a key that the source has, then insert every source row. `follows` is as for merge."""
    with held(source, "delete_insert") as rows:
        return _replace_keys(spark, name, rows, keys, follows)


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Let overwriting inserts replace only the partitions they write.

    `insertInto` on a file table ignores the writer option of the same name and would empty
    the whole table, so the session setting is changed for the length of the write. Writes of
    other threads wait, as they would undo it.
    """
    with _mode:
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(OVERWRITE_MODE, before)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that the frame has rows for; it may read the same table."""
    spark = df.sparkSession
    with dynamic_overwrite(spark):
        balanced(df, *partition_columns(spark, name)).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def _only_in_window(source: DataFrame, key: str, lo, hi) -> DataFrame:
    """Fail the write if a source row lies outside the window; costs no extra pass."""
    inside = F.coalesce(in_half_open(source, key, lo, hi), F.lit(False))
    refused = F.raise_error(F.lit(f"row outside the window by {key}")).cast(source.schema[key].dataType)
    return source.withColumn(key, F.when(inside, F.col(key)).otherwise(refused))


def time_interval(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    key: str,
    lo: dt.datetime | dt.date | str,
    hi: dt.datetime | dt.date | str,
    granularity: str = "timestamp",
    only_changes: bool = False,
    by: str = "day",
) -> DataFrame:
    """Replace the rows with `lo <= key < hi` by the source's rows, which must lie in that window.

    The table is stored in day partitions: of `_day`, derived from the key, or of the key
    itself for `date` granularity, where a window off midnight is refused. Only the days the
    window touches are read and written; a day left without rows is dropped. Rows with a NULL
    key are in no window and stay. A small table may be kept `by` month instead, in partitions of `_month`, the month's first
    day; what is said of days then holds for months.

    With `only_changes` the table has a ledger of its days, and of a window built again only the days whose
    content differs are written. It costs a pass over the new rows, and a second one if some differ.
    """
    lo, hi = as_moment(lo), as_moment(hi)
    if granularity == "date":
        if lo.time() != dt.time() or hi.time() != dt.time():
            raise ValueError("a date window has to start and end at midnight")
    new = _only_in_window(source, key, lo, hi)
    if by == "month":
        day, new = MONTH, new.withColumn(MONTH, day_of(month_start(F.col(key))))
    elif granularity == "date":
        day = key
    else:
        day, new = DAY, new.withColumn(DAY, day_of(F.col(key)))
    if hi <= lo:
        return spark.table(name) if spark.catalog.tableExists(name) else replace_table(new.limit(0), name, [day])
    first, last = lo.date(), last_day_below(hi)
    if by == "month":
        first, last = first.replace(day=1), last.replace(day=1)
    if not spark.catalog.tableExists(name):
        replace_table(new, name, [day])
        if only_changes:
            _record_days(spark, name, day, first, last, day_files(spark, name, day, first, last))
        return spark.table(name)

    if partition_columns(spark, name) != [day]:
        raise ValueError(f"{name} is not partitioned by {day}")
    table = spark.table(name)
    before = day_files(spark, name, day, first, last)
    content = new.select(*table.columns)
    edge_days = sorted({first, last} & before.keys())
    if day != key and edge_days:
        survivors = table.where(F.col(day).isin(edge_days) & ~in_half_open(table, key, lo, hi))
        content = unite([survivors, content])
    if only_changes:
        _overwrite_changes(spark, name, day, content, before, first, last)
        return spark.table(name)
    overwrite_partitions(content, name)
    after = day_files(spark, name, day, first, last)
    _drop_days(spark, name, day, (d for d, files in before.items() if after.get(d) == files))
    return spark.table(name)


def _drop_days(spark: SparkSession, name: str, day: str, days: Iterable[dt.date]) -> None:
    for emptied in sorted(days):
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION (`{day}` = DATE '{emptied}')")


def _record_days(spark: SparkSession, name: str, day: str, first: dt.date, last: dt.date, files: dict[dt.date, str]) -> None:
    """Enter what is stored for each day of the range."""
    found = day_digests(spark.table(name).where(F.col(day).between(F.lit(first), F.lit(last))), day)
    record(spark, name, {str(d): Built(rows, digest, files[d]) for d, (rows, digest, _) in found.items()})


def _overwrite_changes(
    spark: SparkSession, name: str, day: str, content: DataFrame, before: dict[dt.date, str], first: dt.date, last: dt.date
) -> None:
    """Bring the days of a range to the content, writing those whose digest differs from what the ledger holds."""
    entries = {dt.date.fromisoformat(item): entry for item, entry in known(spark, name).items()}
    trusted = {d: entries[d] for d, files in before.items() if d in entries and entries[d].files == files}
    if not trusted:
        overwrite_partitions(content, name)
        after = day_files(spark, name, day, first, last)
        gone = [d for d, files in before.items() if after.get(d) == files]
        _drop_days(spark, name, day, gone)
        _record_days(spark, name, day, first, last, after)
        return record(spark, name, {}, map(str, gone)) if gone else None
    found = day_digests(content, day)
    changed = sorted(d for d, entry in found.items() if d not in trusted or entry[:2] != trusted[d][:2])
    gone = sorted(before.keys() - found.keys())
    if changed:
        overwrite_partitions(content.where(F.col(day).isin(changed)), name)
    _drop_days(spark, name, day, gone)
    if changed or gone:
        after = day_files(spark, name, day, first, last)
        record(spark, name, {str(d): Built(*found[d][:2], after[d]) for d in changed}, map(str, gone))


def window_rows(table: DataFrame, key: str, lo, hi) -> DataFrame:
    """Rows of a stored window, pruned to its days."""
    return half_open(table, key, lo, hi, date_col=DAY if DAY in table.columns else None)


def materialise(
    spark: SparkSession, spec: TableSpec, df: DataFrame | None = None, window: tuple | None = None, full_refresh: bool = False
) -> DataFrame:
    """Build a declared table by its strategy. `full_refresh` drops what is stored first. A view with a query needs no frame.

    A table with an incremental key is stored in day partitions of it, whatever the strategy,
    so that the next step reads only the days of its window.
    """
    if spec.query is not None:
        listed = ", ".join(f"CAST(`{c.name}` AS {c.type}) AS `{c.name}`" for c in spec.columns)
        return as_catalog_view(spark, spec.name, f"SELECT {listed} FROM ({spec.query})")
    if df is None:
        raise ValueError(f"{spec.name} needs a frame")
    declared = [F.col(c.name).cast(c.type).alias(c.name) for c in spec.columns]
    names = {c.name.lower() for c in spec.columns}
    df = df.select(*declared, *([c for c in df.columns if c.lower() not in names] if spec.more else []))
    if spec.strategy == "view":
        return as_view(df, spec.name)
    if full_refresh:
        drop_table(spark, spec.name)
        drop_table(spark, f"{spec.name}{LEDGER}")
    else:
        put_back(spark, spec.name)
    if spec.strategy == "time_interval":
        if window is None:
            raise ValueError("time_interval needs a window")
        return time_interval(spark, spec.name, df, spec.incremental_key, *window, spec.granularity, spec.only_changes)
    days = []
    if spec.incremental_key:
        days = [spec.incremental_key] if spec.granularity == "date" else [DAY]
        df = df if spec.granularity == "date" else df.withColumn(DAY, day_of(F.col(spec.incremental_key)))
    if spec.strategy == "table" or not spark.catalog.tableExists(spec.name):
        if spec.strategy == "merge":
            refuse_repeats(df, spec.name, spec.primary_key)
        if spec.slots and spec.strategy in ("merge", "delete_insert") and not days:
            return keyed_table(df, spec.name, spec.primary_key, spec.slots)
        return replace_table(df, spec.name, days)
    if spec.strategy == "append":
        return append_rows(fit_table(df, spec.name) if spec.more else df, spec.name)
    act = merge if spec.strategy == "merge" else delete_insert
    return act(spark, spec.name, df, spec.primary_key, follows=spec.incremental_key in spec.primary_key)
