"""Catalog tables over files that are already there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def external_table(spark: SparkSession, name: str, glob: str, format: str = "parquet") -> DataFrame:
    """Declare a table on a file glob and read it. Dropping the table leaves the files."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    location = glob.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted(name)} USING {format} OPTIONS (path '{location}')")
    return spark.table(name)
