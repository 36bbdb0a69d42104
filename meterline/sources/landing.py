"""Monthly landed files: which months a window touches, and reading those that exist."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.sets import unite
from meterline.operators.shape import conform, rename_first_present, with_tag
from meterline.sources.files import csv_headers, group_by_schema, read_csv_raw
from meterline.sources.schemas import common_type, found_below, members_of, read_groups, schema_groups
from meterline.types import struct_of

logger = logging.getLogger(__name__)

# Accepted spellings of each column, best first.
TRIP_SPELLINGS = {
    "pickup_datetime": ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"),
    "dropoff_datetime": ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"),
    "pickup_location_id": ("PULocationID", "pulocationid", "PUlocationID", "pickup_location_id"),
    "dropoff_location_id": ("DOLocationID", "dolocationid", "DOlocationID", "dropoff_location_id"),
    "fare_amount": ("fare_amount", "fare", "total_amount", "total"),
    "payment_type": ("payment_type", "payment_type_id", "paymenttype", "payment"),
}

TRIP_SCHEMA = struct_of(
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pickup_location_id int, "
    "dropoff_location_id int, fare_amount double, payment_type int"
)

# Fixed value: how landed files are named.
MONTH_FILE = "{type}_tripdata_{year:04d}-{month:02d}"


# What a month may have landed as, the first that can be read.
ENDINGS = ("parquet", "csv")

REFUSED = "refused"


def month_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every (year, month) from `start` to `end`, both included."""
    bounds = spark.sql("SELECT :start AS first_day, :end AS last_day", args={"start": start, "end": end})
    return months_touched(bounds, F.col("first_day"), F.col("last_day"))


def months_touched(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per month from the first to the last date of each row of `df`; none if they are reversed."""
    first, last = (F.trunc(F.to_date(bound), "month") for bound in (start, end))
    firsts = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    months = df.select(F.explode(firsts).alias("first_day"))
    return months.select(F.year("first_day").alias("year"), F.month("first_day").alias("month"))


def _months(start: dt.date, end: dt.date) -> list[tuple[int, int]]:
    span = range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    return [(index // 12, index % 12 + 1) for index in span]


def landed_files(
    spark: SparkSession, root: str, types: Sequence[str], start: dt.date, end: dt.date, layout: str = MONTH_FILE
) -> DataFrame:
    """Files that have landed for each type and month in the window, from one listing."""
    names = [layout.format(type=kind, year=y, month=m) for kind in types for y, m in _months(start, end)]
    return found_below(spark, root, [f"{name}.{ending}" for name in names for ending in ENDINGS])


def ingest_months(
    spark: SparkSession,
    root: str,
    types: Sequence[str],
    start: dt.date,
    end: dt.date,
    extracted_at: dt.datetime | None = None,
    layout: str = MONTH_FILE,
    landed: Collection[str] | None = None,
) -> DataFrame:
    """Trips of each type and month in the window: Parquet if landed, else CSV, else skipped with a warning.

    `layout` gives the path below the root, without the `.parquet` or `.csv` ending; each may be
    a file or a directory. All trips get the columns of TRIP_SCHEMA, `taxi_type`, every other
    column that has landed, under its own name, `refused` (names of the columns whose cell did not
    fit the type; counted by `refused_cells`) and one `extracted_at` for the whole run. With nothing
    landed the frame is empty, with the declared columns.

    One listing tells what has landed. For each feed one job reads all footers; months, or files of a month, whose types
    differ from others' are read apart and cast to the same columns. Who has listed them already names in `landed` the
    files and folders below the root to read.
    """
    stamp = extracted_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    root = root.rstrip("/")
    months = {kind: [layout.format(type=kind, year=y, month=m) for y, m in _months(start, end)] for kind in types}
    if landed is None:
        landed = {r["name"] for r in landed_files(spark, root, types, start, end, layout).select("name").distinct().collect()}
    with ThreadPoolExecutor(max(1, len(months))) as feeds:
        read = list(feeds.map(lambda names: _landed_frames(spark, root, names, landed), months.values()))
    frames = []
    for kind, feed in zip(months, read, strict=True):
        for frame in feed:
            renamed, chosen = rename_first_present(frame, TRIP_SPELLINGS)
            if chosen.get("fare_amount", "fare_amount") not in ("fare_amount", "fare"):
                logger.warning("%s trips: %s stands in for the fare", kind, chosen["fare_amount"])
            frames.append(with_tag(renamed, "taxi_type", kind))

    others, frames = _other_columns(frames)
    schema = T.StructType([*TRIP_SCHEMA.fields, T.StructField("taxi_type", T.StringType()), *others])
    frames = frames or [spark.createDataFrame([], schema)]
    trips = unite([conform(frame, schema, refused=REFUSED) for frame in frames])
    return trips.withColumn("extracted_at", F.lit(str(stamp)).cast("timestamp_ntz"))


def _landed_frames(spark: SparkSession, root: str, names: Sequence[str], landed: Collection[str]) -> list[DataFrame]:
    """What has landed of one feed, files of the same types in one frame: Parquet, and text where that can't be read."""
    parquet = [f"{root}/{name}.parquet" for name in names if f"{name}.parquet" in landed]
    groups, broken = schema_groups(spark, parquet, members_of(spark))
    there = [name for name in names if f"{name}.parquet" in landed and f"{root}/{name}.parquet" not in broken]
    text = [name for name in names if name not in there and f"{name}.csv" in landed]
    headers = csv_headers(spark, [f"{root}/{name}.csv" for name in text])
    for name in sorted({*names} - {*there, *text}):
        logger.warning("no readable file landed for %s/%s", root, name)
    return read_groups(spark, groups) + [read_csv_raw(spark, *group) for group in group_by_schema(headers)]


def _other_columns(frames: Sequence[DataFrame]) -> tuple[list[T.StructField], list[DataFrame]]:
    """What the frames have beyond the declared columns, by one spelling and type each, and the frames in that spelling.

    Text takes the type that the column has elsewhere; other types become their common one.
    """
    own = {name.lower() for name in (*TRIP_SCHEMA.names, "taxi_type", REFUSED, "extracted_at")}
    names: dict[str, str] = {}
    kinds: dict[str, set[T.DataType]] = {}
    for f in (f for frame in frames for f in frame.schema.fields if f.name.lower() not in own):
        names.setdefault(f.name.lower(), f.name)
        kinds.setdefault(f.name.lower(), set()).add(f.dataType)
    fields = []
    for key, found in kinds.items():
        typed = found - {T.StringType()} or found
        fields.append(T.StructField(names[key], reduce(common_type, sorted(typed, key=str))))
    spelled = [frame.withColumnsRenamed({c: names[c.lower()] for c in frame.columns if c.lower() in names}) for frame in frames]
    return fields, spelled


def refused_cells(trips: DataFrame) -> DataFrame:
    """Rows (column, cells): how many landed cells did not fit, for each column that has any."""
    return trips.select(F.explode(REFUSED).alias("column")).groupBy("column").agg(F.count("*").alias("cells"))
