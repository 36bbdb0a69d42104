"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import workspace


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """Write a frame below the shared folder and read it back: lineage ends there, and executors may be lost.

    The files are left for the cluster's own clean-up of that folder, as the frame returned reads them lazily.
    """
    path = workspace(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n. A null id counts as an empty text."""
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)), F.lit(n))


def pieces(texts: Iterable[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs [start, end) of about `limit` characters, so that numpy's arrays stay small.

    Every text is in exactly one run; one longer than the limit has a run of its own.
    """
    start = size = i = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if size or start < i + 1:
        yield start, i + 1
