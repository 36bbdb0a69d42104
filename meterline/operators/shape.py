"""Column shaping: rename, tag, align and coerce."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def common_columns(first: DataFrame | Sequence[str], second: DataFrame | Sequence[str]) -> list[str]:
    """Columns of both, in the order of the first."""
    first_names, second_names = (x.columns if isinstance(x, DataFrame) else list(x) for x in (first, second))
    shared = set(second_names)
    return [name for name in first_names if name in shared]


def rename_first_present(df: DataFrame, spellings: Mapping[str, Iterable[str]]) -> tuple[DataFrame, dict[str, str]]:
    """Give each target the first of its spellings that the frame has.

    Returns the frame and the `{target: spelling}` choice made, so that a caller can see
    when, say, a total stands in for a missing fare. Spellings that were not chosen stay as
    they are, unless one already carries the target's name: the chosen column replaces it.
    """
    present = set(df.columns)
    chosen: dict[str, str] = {}
    for target, names in spellings.items():
        found = next((name for name in names if name in present), None)
        if found is not None:
            chosen[target] = found
    replaced = [target for target, found in chosen.items() if target != found and target in present]
    renames = {found: target for target, found in chosen.items() if target != found}
    return df.drop(*replaced).withColumnsRenamed(renames), chosen


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's missing columns as typed NULLs; columns already there are untouched."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def coerce_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn columns into zone-less timestamps; text that is none becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast("timestamp_ntz") for name in columns})


def fitted(df: DataFrame, field: T.StructField) -> Column:
    """A column of the frame as the field's type; NULL where a cell does not fit.

    Whole numbers may be written with decimals (`1.0`), as a column with gaps often is; `1.5` does not fit.
    """
    cell, kind, given = F.col(f"`{field.name}`"), field.dataType, df.schema[field.name].dataType
    if given == kind:
        return cell
    if isinstance(kind, T.IntegralType) and isinstance(given, (T.StringType, T.FractionalType)):
        number = cell.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        return F.coalesce(cell.try_cast(kind), whole) if isinstance(given, T.StringType) else whole
    return cell.try_cast(kind)


def conform(df: DataFrame, schema: T.StructType, refused: str | None = None) -> DataFrame:
    """Exactly the schema's columns, in its order, cast; absent ones NULL, bad cells NULL.

    `refused` names one more column: the names of those columns whose cell was neither NULL nor empty and did not fit.
    """
    there = {f.name: fitted(df, f) for f in schema.fields if f.name in df.columns}
    columns = [there.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    if refused is not None:
        recast = [f.name for f in schema.fields if f.name in there and df.schema[f.name].dataType != f.dataType]
        bad = [
            F.when((F.trim(F.col(f"`{name}`").cast("string")) != "") & there[name].isNull(), F.lit(name)) for name in recast
        ]
        columns.append(F.array_compact(F.array(*bad, F.lit(None).cast("string"))).alias(refused))
    return df.select(*columns)
