"""The column types in use, by the names that SQL gives them. Every column may be NULL."""

from __future__ import annotations

from pyspark.sql import types as T

BY_NAME = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct_of(columns: str) -> T.StructType:
    """`"a int, b double"` as a schema. Unlike Spark's own parser, works before a session exists."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, BY_NAME[kind]) for name, kind in pairs])
