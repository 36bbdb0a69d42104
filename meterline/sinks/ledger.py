"""What has been built: digests of a table's days and of landed files, so that a run repeats only what differs.

A ledger is a small table beside the one it is about. It is trusted for a day only while the day's files are those that it
saw, so a table written by other means, or a ledger that was lost, costs work but never a wrong result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sinks.tables import replace_table
from meterline.sources.schemas import paths_below
from meterline.sources.tables import quoted

LEDGER = "__ledger"
_PART, _BITS = (1 << 30) - 1, 30


class Built(NamedTuple):
    rows: int
    digest: str
    files: str = ""


def _sums(hash_: Column) -> list[Column]:
    """A 64-bit hash added up in three parts, so that 2^33 rows fit a long."""
    parts = [F.shiftrightunsigned(hash_, shift).bitwiseAND(_PART) for shift in (0, _BITS, 2 * _BITS)]
    return [F.sum(part).cast("string") for part in parts]


def content_digest(df: DataFrame) -> list[Column]:
    """Aggregates `rows` and `digest`: equal for the same rows in any order, however often each occurs.

    Whether a cell is NULL goes into the hash by itself, as the hash function passes NULLs over.
    """
    cells = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [s for seed in (0, 1) for s in _sums(F.xxhash64(F.lit(seed), *cells))]
    return [F.count("*").alias("rows"), F.concat_ws("-", *sums).alias("digest")]


def day_digests(df: DataFrame, day: str) -> dict[dt.date, Built]:
    """Rows and digest of each day of a frame; one row for each day comes to the driver."""
    found = df.groupBy(F.col(day).alias("__day")).agg(*content_digest(df)).collect()
    return {r["__day"]: Built(r["rows"], r["digest"]) for r in found}


def files_digest(listed: DataFrame, *keys: str) -> DataFrame:
    """One row (keys, files) for each set of listed files: a digest of their paths, lengths and times."""
    hashes = _sums(F.xxhash64("path", "length", "modificationTime"))
    return listed.groupBy(*keys).agg(F.concat_ws("-", F.count("*").cast("string"), *hashes).alias("files"))


def stored_days(spark: SparkSession, name: str, day: str) -> list[dt.date]:
    """Days of a table's partitions, from the catalog."""
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()]
    values = (p.removeprefix(f"{day}=") for p in parts)
    return sorted(dt.date.fromisoformat(v) for v in values if v[:1].isdigit())


def location(spark: SparkSession, name: str) -> str:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").first()
    return told["data_type"]


def day_files(spark: SparkSession, name: str, day: str, first: dt.date, last: dt.date) -> dict[dt.date, str]:
    """A digest of the files of each stored day in the range, from one listing; no row is read."""
    days = [d for d in stored_days(spark, name, day) if first <= d <= last]
    if not days:
        return {}
    pattern = f"{location(spark, name)}/{day}={{{','.join(map(str, days))}}}"
    listed = paths_below(spark, pattern).withColumn("day", F.regexp_extract("path", f"/{day}=([-0-9]+)/", 1))
    return {dt.date.fromisoformat(r["day"]): r["files"] for r in files_digest(listed, "day").collect()}


def known(spark: SparkSession, name: str) -> dict[str, Built]:
    """What a table's ledger says of each of its days or landed files."""
    if not spark.catalog.tableExists(f"{name}{LEDGER}"):
        return {}
    return {r["item"]: Built(r["rows"], r["digest"], r["files"]) for r in spark.table(f"{name}{LEDGER}").collect()}


def record(spark: SparkSession, name: str, built: Mapping[str, Built], gone: Iterable[str] = ()) -> None:
    """Put items into a table's ledger and take others out. It has one row for each, so it is written anew."""
    every = known(spark, name) | dict(built)
    for item in gone:
        every.pop(item, None)
    rows = [(item, *entry) for item, entry in sorted(every.items())]
    columns = "item string, rows long, digest string, files string"
    replace_table(spark.createDataFrame(rows, columns).coalesce(1), f"{name}{LEDGER}")
