"""Readers of landed files. Paths may use any scheme that Spark is configured for."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.sets import unite
from meterline.operators.shape import ensure_columns
from meterline.sources.schemas import LOOKS, NOTHING_THERE, members_of, read_groups, schema_groups, unite_widened


def read_csv_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """Header row, every column text."""
    return spark.read.option("header", True).csv(list(paths))


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str = "PERMISSIVE", refused: str | None = None
) -> DataFrame:
    """Header row and declared types; a cell that does not fit is NULL. Compressed files are read as they are.

    `refused` names one more column: the whole line, where a cell did not fit or their number is not that of the schema.
    All cells are then read whatever columns are selected, so that a line's verdict does not depend on it.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if refused is not None:
        schema = T.StructType([*schema.fields, T.StructField(refused, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", refused)
    lines = reader.schema(schema).csv(path)
    if refused is None:
        return lines
    # Spark checks only the cells that are asked for, so all are asked for with the line
    asked = F.left(F.concat_ws("", *(F.col(f"`{f.name}`").cast("string") for f in schema.fields[:-1])), F.lit(0))
    return lines.withColumn(refused, F.concat(refused, asked))


def infer_csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types that all cells of a CSV file fit. The executors read the whole file for it."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path).schema


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_parquet_tree(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """All files below nested directories whose name matches; directory names are not columns.

    The columns are those of all files together, NULL where a file lacks one; executors read the footers. A column whose
    type differs between files has the common type of all; files that agree are read by one scan, which sees filters.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": glob}
    groups, unreadable = schema_groups(spark, [root], members_of(spark, pathGlobFilter=glob), **options)
    if unreadable:
        raise FileNotFoundError(f"no readable Parquet at {unreadable}")
    return unite_widened(read_groups(spark, groups, **options))


def group_by_schema(schemas: dict[str, T.StructType]) -> list[list[str]]:
    """Paths that share a schema, in the order first seen."""
    groups: dict[str, list[str]] = {}
    for path, schema in schemas.items():
        groups.setdefault(schema.json(), []).append(path)
    return list(groups.values())


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or None if there is no such path or nothing in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in NOTHING_THERE:
            raise
        return None


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, T.StructType]:
    """Columns of each CSV path, from one header; paths that are missing are left out."""

    def look(path: str) -> T.StructType | None:
        try:
            return read_csv_raw(spark, path).schema
        except AnalysisException as problem:
            if problem.getCondition() not in NOTHING_THERE:
                raise
            return None

    with ThreadPoolExecutor(LOOKS) as readers:
        found = dict(zip(paths, readers.map(look, paths), strict=True))
    return {path: schema for path, schema in found.items() if schema is not None}


def read_parquet_as(spark: SparkSession, schema: T.StructType, *paths: str) -> DataFrame:
    """Only the declared columns, cast to the declared types; absent ones are NULL.

    A column counts as there if any file of a path has it.

    Files are read with their own types and cast afterwards: asking the reader for another
    type fails, or loses the whole file when corrupt files are skipped.
    """
    groups, missing = schema_groups(spark, paths, members_of(spark))
    if missing:
        raise FileNotFoundError(f"no readable Parquet at {missing}")
    frames = []
    for frame in read_groups(spark, groups):
        complete = ensure_columns(frame, schema)
        frames.append(complete.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields)))
    return unite(frames)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path and length of every file below a root, but for those of no length; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(F.col("_metadata.file_path").alias("path"), "length")


def read_tolerant(
    spark: SparkSession, root: str, schema: T.StructType | None = None, glob: str = "*.parquet"
) -> tuple[DataFrame, DataFrame]:
    """Rows of the readable Parquet files, and a report on every listed file.

    Without a schema the files' own types are used, from the footers that can be read. A schema
    has to have those types: a file of other ones is skipped as if it were broken.

    Report columns: path, length, rows_read. A file with `rows_read = 0` was skipped (or holds
    no rows). Counting depends on a hash of all columns, so that the report decodes them and a
    file whose pages or types cannot be read shows up too; it costs a full scan and runs only
    if the report is used.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    reader = reader.option("ignoreCorruptFiles", True)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    rows = reader.parquet(root)
    decoded = F.bit_xor(F.xxhash64(*rows.columns)).isNotNull()
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("path"))
    read = per_file.agg(F.when(decoded, F.count("*")).alias("rows_read"))
    report = list_files(spark, root, glob).join(read, "path", "left")
    return rows, report.select("path", "length", F.coalesce("rows_read", F.lit(0)).alias("rows_read"))


def generated_rows(spark: SparkSession, count: int, **constants) -> DataFrame:
    """Numbered rows with constant columns."""
    return spark.range(count).select("id", *(F.lit(v).alias(k) for k, v in constants.items()))
