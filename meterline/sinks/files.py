"""Writers of Parquet folders and relational targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import month_start
from meterline.sources.files import read_csv

BATCH_ROWS = 100_000


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one output directory together, in pieces of even size.

    Adaptive execution merges small pieces and splits a directory that holds most of the
    rows, which hashing on the directory columns alone would leave to one task.
    """
    return df.hint("rebalance", *(F.col(c) for c in columns))


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    files: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write a folder. The default refuses to write where something is.

    `files` is the number of even output files, made by a shuffle, so that even `files=1`
    leaves the work before it spread over all tasks; use it for reports of known small size.
    """
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = balanced(df, *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def even_files(df: DataFrame, least: int, most_rows: int) -> int:
    """Number of even files for `df`: `least`, or as many as keep each at or below `most_rows` rows.

    One count comes to the driver, read from the files' footers where the plan allows.
    """
    return max(least, -(-df.count() // most_rows))


def write_per_resource(df: DataFrame, root: str, resource: Column, mode: str = "overwrite") -> None:
    """One Parquet folder for each resource value below the root, in one job."""
    write_parquet(df.withColumn("resource", resource), root, mode, partition_by=["resource"])


def csv_to_parquet_months(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    time_column: str,
    out: str,
    mode: str = "overwrite",
) -> None:
    """Convert CSV directories to Parquet in year and month directories: one read, one write.

    The month is taken from each row's time. Rows without one go to the default directory.
    """
    trips = read_csv(spark, paths, schema)
    first_day = month_start(F.col(time_column))
    dated = trips.withColumns({"year": F.year(first_day), "month": F.month(first_day)})
    write_parquet(dated, out, mode, partition_by=["year", "month"])


def jdbc_options(
    url: str, table: str, mode: str, batch_rows: int = BATCH_ROWS, connections: int = 8, **properties: str
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        "truncate": str(mode == "overwrite").lower(),
        **properties,
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Insert into a relational table that all executors can reach, in batches.

    Tasks write side by side over at most `connections` connections. A replaced table keeps
    its definition. A failed task is run again, so rows of an appended table may repeat.
    """
    df.write.format("jdbc").options(**jdbc_options(url, table, mode, **options)).mode(mode).save()
