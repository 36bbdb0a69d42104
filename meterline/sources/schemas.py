"""Types of files that were written at different times: which agree, what holds them all, and reading them as one.

Executors read the footers. The driver gets one schema for each set of files that agree, never one for each file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.sets import unite

LOOKS = 16
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
BROKEN = ("CANNOT_READ_FILE_FOOTER",)
DIFFERENT = ("CANNOT_MERGE_SCHEMAS",)

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_INTEGERS = list(_DIGITS)


class NoCommonType(TypeError):
    pass


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both.

    Whole numbers widen, beside fractions they become decimals or doubles (which hold whole numbers to 2^53), dates beside
    timestamps become timestamps, those with and without a zone wall-clock ones, and any other two atomic types text.
    Lists, maps and structs do so inside; a nested type beside another kind has no common type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if any(isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) for kind in (a, b)):
        raise NoCommonType(f"{a.simpleString()} and {b.simpleString()}")
    kinds = {type(a), type(b)}
    if kinds <= set(_INTEGERS):
        return max(a, b, key=lambda kind: _INTEGERS.index(type(kind)))
    if all(isinstance(kind, T.NumericType) for kind in (a, b)):
        if kinds <= {T.DecimalType, *_INTEGERS}:
            scale = max(getattr(kind, "scale", 0) for kind in (a, b))
            whole = max(kind.precision - kind.scale if isinstance(kind, T.DecimalType) else _DIGITS[type(kind)] for kind in (a, b))
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        small = {T.FloatType, T.ByteType, T.ShortType}
        return T.FloatType() if kinds <= small else T.DoubleType()
    if kinds <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType() if kinds == {T.DateType, T.TimestampType} else T.TimestampNTZType()
    return T.StringType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns, in the order and spelling first seen, by their common types."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        key = field.name.lower()
        if key in fields:
            try:
                kind = common_type(fields[key].dataType, field.dataType)
            except NoCommonType as problem:
                raise NoCommonType(f"column {field.name}: {problem}") from None
            fields[key] = T.StructField(fields[key].name, kind)
        else:
            fields[key] = T.StructField(field.name, field.dataType)
    return T.StructType(list(fields.values()))


def _widened(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if given == wanted:
        return column
    if isinstance(wanted, T.StructType):
        own = {f.name.lower(): f for f in given.fields}
        parts = [
            _widened(column.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return F.transform(column, lambda item: _widened(item, given.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        keys = F.transform_keys(column, lambda key, _: _widened(key, given.keyType, wanted.keyType))
        return F.transform_values(keys, lambda _, value: _widened(value, given.valueType, wanted.valueType))
    return column.cast(wanted)


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, each cast up from the frame's own type; NULL where the frame lacks one."""
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        given = own.get(field.name.lower())
        column = F.lit(None).cast(field.dataType) if given is None else _widened(F.col(f"`{given.name}`"), given.dataType, field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def unite_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames under their common schema."""
    schema = common_schema(frame.schema for frame in frames)
    return unite([widen(frame, schema) for frame in frames])


def _agree(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name.lower(): (f.name, f.dataType) for f in a.fields}
    return all(kinds.get(f.name.lower(), (f.name, f.dataType)) == (f.name, f.dataType) for f in b.fields)


def schema_groups(
    spark: SparkSession, paths: Sequence[str], members: Callable[[str], list[str]], **options
) -> tuple[list[tuple[list[str], T.StructType]], list[str]]:
    """Parquet paths in groups whose files agree in the types of the columns they share, with all their columns, and the
    paths that are missing or unreadable.

    One job reads all footers. Only if files disagree are the paths halved and each half tried, side by side, and a single
    path that disagrees within itself replaced by its `members`. So feeds whose types changed now and then cost some rounds
    of jobs for each change, whatever the number of files. Groups that agree are put together again at the end.
    """

    def look(group: list[str]) -> T.StructType | str:
        try:
            return spark.read.options(mergeSchema=True, **options).parquet(*group).schema
        except Exception as problem:  # a failed merge comes as the JVM's own error
            name = next((n for n in (*NOTHING_THERE, *BROKEN, *DIFFERENT) if n in str(problem)), None)
            if name is None:
                raise
            return name

    found: list[tuple[list[str], T.StructType]] = []
    unreadable: list[str] = []
    pending = [list(paths)] if paths else []
    with ThreadPoolExecutor(LOOKS) as readers:
        while pending:
            following = []
            for group, seen in zip(pending, readers.map(look, pending), strict=True):
                if isinstance(seen, T.StructType):
                    found.append((group, seen))
                elif len(group) > 1:
                    following += [group[: len(group) // 2], group[len(group) // 2 :]]
                elif seen in DIFFERENT and (inner := members(group[0])) != group:
                    following.append(inner)
                else:
                    unreadable.append(group[0])
            pending = following
    together: list[tuple[list[str], T.StructType]] = []
    for group, schema in sorted(found, key=lambda pair: pair[0]):
        for at, (others, known) in enumerate(together):
            if _agree(known, schema):
                together[at] = ([*others, *group], common_schema([known, schema]))
                break
        else:
            together.append((group, schema))
    return together, unreadable


def read_groups(spark: SparkSession, groups: Sequence[tuple[list[str], T.StructType]], **options) -> list[DataFrame]:
    """One frame for each group, read with the group's own types."""
    return [spark.read.options(**options).schema(schema).parquet(*paths) for paths, schema in groups]


def paths_below(spark: SparkSession, root: str, **options) -> DataFrame:
    """Rows (path, length, modificationTime) of the files below a root; contents are not read."""
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, **options).load(root)
    return listed.select("path", "length", "modificationTime")


def members_of(spark: SparkSession, **options) -> Callable[[str], list[str]]:
    """The folders below a path that hold files, or its files if it holds them itself or a folder lies in another."""

    def members(path: str) -> list[str]:
        listed = paths_below(spark, path, **options)
        folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
        folders = sorted(r.folder for r in listed.select(folder).distinct().collect())
        nested = any(b.startswith(f"{a}/") for a, b in zip(folders, folders[1:], strict=False))
        if len(folders) > 1 and not nested:
            return folders
        return sorted(r.path for r in listed.select("path").collect())

    return members


def found_below(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Rows (name, path, length, modificationTime) of the files that the relative names are or hold, below a root.

    One listing; Spark takes paths for patterns, so the names must not hold a sign that has a meaning there.
    """
    if odd := [name for name in names if set(name) & set("\\*?[]{},")]:
        raise ValueError(f"names with signs of patterns: {odd}")
    nothing = spark.createDataFrame([], "name string, path string, length long, modificationTime timestamp")
    if not names:
        return nothing
    try:
        listed = paths_below(spark, f"{root.rstrip('/')}/{{{','.join(names)}}}")
    except PySparkException as problem:
        if problem.getCondition() not in NOTHING_THERE:
            raise
        return nothing
    parts = F.split("path", "/")
    found = []
    for depth in sorted({name.count("/") + 1 for name in names}):
        runs = F.transform(F.sequence(F.lit(1), F.size(parts) - depth + 1), lambda i: F.array_join(F.slice(parts, i, depth), "/"))
        own = listed.select(F.explode(runs).alias("name"), *listed.columns)
        found.append(own.where(F.col("name").isin([n for n in names if n.count("/") + 1 == depth])))
    return unite(found)
