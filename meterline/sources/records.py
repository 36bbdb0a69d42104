"""Records out of landed JSON pages (one row per page: its number and its text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "$"

#: The text of what was not fully understood; NULL for a good row.
REFUSED = "_refused"

_ROWS, _TEXT = "records", "text"


def page_records(body: Column, selector: str, schema: T.StructType) -> Column:
    """The array of records in a page: the page itself for `$`, else the named field.

    A page without the field, or whose text is NULL, has none. Text that does not parse, or a cell that does not fit its
    type, fails the job.
    """
    strict = {"mode": "FAILFAST"}
    records = T.ArrayType(schema)
    if selector == ROOT:
        return F.from_json(body, records, strict)
    return F.from_json(body, T.StructType([T.StructField(selector, records)]), strict).getField(selector)


def select_records(
    pages: DataFrame, selector: str, schema: T.StructType, page: str = "page", body: str = "body"
) -> DataFrame:
    """One row per record, with the page and position it came from, which identify it. A bad page or cell fails the job."""
    records = page_records(F.col(body), selector, schema)
    rows = pages.select(F.col(page), F.posexplode(records).alias("position", "record"))
    return rows.select(page, "position", "record.*")


def _tolerant(text: Column, schema: T.StructType) -> Column:
    """An object's fields, NULL where they don't fit, and the whole text as REFUSED if one does not."""
    marked = T.StructType([*schema.fields, T.StructField(REFUSED, T.StringType())])
    return F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REFUSED})


def _tolerant_page(body: Column, selector: str, element: T.DataType) -> Column:
    """A page as an object with the array under the selector. A bare array is wrapped, as only objects tell what is refused."""
    text = F.concat(F.lit(f'{{"{_ROWS}":'), body, F.lit("}")) if selector == ROOT else body
    return _tolerant(text, T.StructType([T.StructField(_ROWS if selector == ROOT else selector, T.ArrayType(element))]))


def split_records(
    pages: DataFrame, selector: str, schema: T.StructType, page: str = "page", body: str = "body"
) -> DataFrame:
    """Rows (page, position, fields, REFUSED): every record, the good ones and those with a cell that does not fit.

    REFUSED is NULL for a good record. A bad one has the fields that fit and its text there, as JSON without spaces and
    with numbers as Spark writes them. A page that does not parse, or
    whose records are no array, is one row without position whose REFUSED is the page. A page without the field, or whose text
    is NULL, has no rows, as for `select_records`.

    A page whose cells all fit is parsed once. Only the others are parsed again, record by record.
    """
    name = _ROWS if selector == ROOT else selector
    whole, loose = _tolerant_page(F.col(body), selector, schema), _tolerant_page(F.col(_TEXT), selector, T.StringType())
    read = pages.select(page, F.col(body).alias(_TEXT), whole.alias("whole"))
    read = read.withColumn("loose", F.when(F.col(f"whole.{REFUSED}").isNotNull(), loose))
    nothing = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields), F.col(_TEXT).alias(REFUSED))
    fine = F.transform(f"whole.{name}", lambda r, i: F.struct(i.alias("position"), _with_refused(r, schema).alias("record")))
    one_by_one = F.transform(
        f"loose.{name}", lambda text, i: F.struct(i.alias("position"), _read_alone(text, schema).alias("record"))
    )
    broken = F.array(F.struct(F.lit(None).cast("int").alias("position"), nothing.alias("record")))
    rows = (
        F.when(F.col("loose").isNull(), fine)
        .when(F.col(f"loose.{REFUSED}").isNull(), one_by_one)
        .otherwise(broken)
    )
    return read.select(page, F.inline(rows)).select(page, "position", "record.*")


def _with_refused(record: Column, schema: T.StructType) -> Column:
    fields = (record.getField(f.name).alias(f.name) for f in schema.fields)
    return F.struct(*fields, F.lit(None).cast("string").alias(REFUSED))


def _read_alone(text: Column, schema: T.StructType) -> Column:
    """A record by itself. One that is no object, but NULL, is NULL in all fields, as in a good page."""
    read = _tolerant(text, schema)
    fields = (read.getField(f.name).alias(f.name) for f in schema.fields)
    return F.struct(*fields, read.getField(REFUSED).alias(REFUSED))


def good(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REFUSED).isNull()).drop(REFUSED)


def refused(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REFUSED).isNotNull())


def write_split(rows: DataFrame, root: str, mode: str = "errorifexists") -> dict[str, int]:
    """Write good and refused rows below a root in one pass, as `kind=good` and `kind=refused`, and tell how many there are.

    The numbers are counted while the rows are written, by no job of their own.
    """
    seen, kind = Observation("records"), F.when(F.col(REFUSED).isNull(), "good").otherwise("refused")
    counts = [F.count("*").alias("rows"), F.count(REFUSED).alias("refused")]
    rows.observe(seen, *counts).withColumn("kind", kind).write.mode(mode).partitionBy("kind").parquet(root)
    return seen.get


def pages_until_empty(
    pages: DataFrame, selector: str, page: str = "page", body: str = "body", tolerant: bool = False
) -> DataFrame:
    """Pages before the first one, by number, without records.

    The bound is a single value from an aggregate over the pages; it is compared as a
    scalar subquery, so no page is joined or sorted. A page that does not parse fails the job, or, if that is to be
    `tolerant`, is not empty.
    """
    some_record = T.StructType([])
    if tolerant:
        read = _tolerant_page(F.col(body), selector, T.StringType())
        records = F.when(read[REFUSED].isNull(), read[_ROWS if selector == ROOT else selector]).otherwise(F.array(F.lit("")))
    else:
        records = page_records(F.col(body), selector, some_record)
    found = F.coalesce(F.size(records), F.lit(0))
    first_empty = pages.where(found <= 0).agg(F.min(page).alias("first_empty"))
    return pages.where(F.coalesce(F.col(page) < first_empty.scalar(), F.lit(True)))
