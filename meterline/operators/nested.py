"""Nested records to linked flat tables.

Every table carries `_row_id` and `_load_id`; a child also has `_parent_id` and its position
in the parent's list. Ids are hashes of 16 bytes of the parent id, the field and the position: parent and
child plans agree on them without sharing data, and a reload gives the same ids.

`normalise` gives each table a plan of its own, which reads just that table's fields. `fan_out` makes the rows of all
tables in one pass, for those who write or count all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.sets import unite

ROW_ID, PARENT_ID, POSITION, LOAD_ID = "_row_id", "_parent_id", "_position", "_load_id"
CHILD_COLUMNS = [ROW_ID, PARENT_ID, POSITION]
VALUE, LIST, SEPARATOR = "value", "list", "__"


@dataclass(frozen=True)
class _Field:
    name: str
    column: Column
    type: T.DataType
    path: tuple[str, ...] = ()


def _fields(
    struct: T.StructType, parent: Column | None = None, prefix: str = "", path: tuple[str, ...] = ()
) -> Iterable[_Field]:
    """Leaves of a struct in order, with `parent__child` names; arrays count as leaves."""
    for f in struct.fields:
        column = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
        name, own = prefix + f.name, (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            yield from _fields(f.dataType, column, name + SEPARATOR, own)
        else:
            yield _Field(name, column, f.dataType, own)


def _flat(fields: Iterable[_Field]) -> list[_Field]:
    return [f for f in fields if not isinstance(f.type, T.ArrayType)]


def _named(fields: Iterable[_Field]) -> list[_Field]:
    fields = list(fields)
    names = [f.name.lower() for f in fields]
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"flattened names clash: {sorted(clash)}")
    return fields


def flatten_struct(df: DataFrame) -> DataFrame:
    """Structs at any depth become `parent__child` columns; arrays stay."""
    return df.select(*(f.column.alias(f.name) for f in _named(_fields(df.schema))))


def row_id(table: str, keys: Sequence[str]) -> Column:
    """Id of a root row from its key, which has to identify the row."""
    parts = F.array(F.lit(table), *(F.col(f"`{k}`").cast("string") for k in keys))
    return F.unhex(F.md5(F.to_json(parts)))


def child_id(parent: Column, field: str | Column, position: Column) -> Column:
    field = F.lit(field) if isinstance(field, str) else field
    place = F.concat(F.lit("/"), field, F.lit("/"), position.cast("string")).cast("binary")
    return F.unhex(F.md5(F.concat(parent, place)))


def _elements(frame: DataFrame, field: str, array: Column) -> DataFrame:
    """One row per element of an array, with its id, parent and position."""
    items = frame.select(F.col(ROW_ID).alias(PARENT_ID), F.posexplode(array).alias(POSITION, "item"))
    return items.withColumn(ROW_ID, child_id(F.col(PARENT_ID), field, F.col(POSITION)))


def _own_values(array: _Field) -> tuple[Column, list[_Field]] | None:
    """An array of structs cut down to the structs' own values, if they hold lists beside them.

    Every value is picked out of the array by itself, which the file reader can follow: lists
    inside the structs, often most of the data, are not read for the table that leaves them out.
    """
    element = array.type.elementType
    if not isinstance(element, T.StructType):
        return None
    leaves = list(_fields(element, array.column))
    own = _flat(leaves)
    if not own or len(own) == len(leaves):
        return None
    zipped = F.arrays_zip(*(f.column.alias(f.name) for f in own))
    return zipped, [_Field(f.name, F.col("item").getField(f.name), f.type) for f in own]


def dealt_out(df: DataFrame) -> DataFrame:
    """The records dealt out evenly if they lie in fewer files than there are tasks at a time, else as they lie.

    What is dealt out is moved as it is: where lists are made from texts, deal out the texts.
    """
    return df if len(df.inputFiles()) >= df.sparkSession.sparkContext.defaultParallelism else df.hint("rebalance")


def normalise(
    df: DataFrame, table: str, keys: Sequence[str], load_id: str, spread: bool = False
) -> dict[str, DataFrame]:
    """The root table and one table per array at any depth, named `parent__field`.

    Only the schema is walked here. Each table is its own plan and reads just the key and its
    own field, so land JSON as Parquet once before calling this on many fields. `spread` deals the
    records out evenly first, see `dealt_out`.
    """
    df = dealt_out(df) if spread else df
    tables: dict[str, DataFrame] = {}

    def add(name: str, frame: DataFrame, own: list[str], fields: Iterable[_Field]) -> None:
        if name in tables:
            raise ValueError(f"two fields would give the table {name}")
        tables[name] = frame.select(*own, F.lit(load_id).alias(LOAD_ID), *(f.column.alias(f.name) for f in fields))

    def descend(frame: DataFrame, parent: str, fields: list[_Field]) -> None:
        for f in fields:
            if not isinstance(f.type, T.ArrayType):
                continue
            name, element = parent + SEPARATOR + f.name, f.type.elementType
            child = _elements(frame, f.name, f.column)
            if isinstance(element, T.StructType):
                inner = _named(_fields(element, F.col("item")))
            else:
                inner = [_Field(LIST if isinstance(element, T.ArrayType) else VALUE, F.col("item"), element)]
            slim = _own_values(f)
            if slim is None:
                add(name, child, CHILD_COLUMNS, _flat(inner))
            else:
                add(name, _elements(frame, f.name, slim[0]), CHILD_COLUMNS, slim[1])
            descend(child, name, inner)

    top = _named(_fields(df.schema))
    rooted = df.withColumn(ROW_ID, row_id(table, keys))
    add(table, rooted, [ROW_ID], _flat(top))
    descend(rooted, table, top)
    return tables


@dataclass(frozen=True)
class _Table:
    """A table that records come apart into: fields that are its columns, and lists that are tables of their own."""

    name: str
    fields: list[_Field]
    flat: list[str]
    children: dict[str, int]  # by the list's name, as places among all tables


def _tables(schema: T.StructType, table: str) -> list[list[_Table]]:
    """All tables by depth. Fields of an element are seen from a column `item`."""
    levels, found, number = [], {table}, 1

    def made(name: str, fields: list[_Field]) -> _Table:
        nonlocal number
        lists = [f.name for f in fields if isinstance(f.type, T.ArrayType)]
        places = {f: number + i for i, f in enumerate(lists)}
        number += len(lists)
        clash = found & {name + SEPARATOR + f for f in lists}
        if clash:
            raise ValueError(f"two fields would give the tables {sorted(clash)}")
        found.update(name + SEPARATOR + f for f in lists)
        return _Table(name, fields, [f.name for f in _flat(fields)], places)

    level = [made(table, _named(_fields(schema)))]
    while level:
        levels.append(level)
        following = []
        for own in level:
            kinds = {f.name: f.type for f in own.fields}
            for name in own.children:
                element = kinds[name].elementType
                if isinstance(element, T.StructType):
                    inner = _named(_fields(element, F.col("item")))
                else:
                    inner = [_Field(LIST if isinstance(element, T.ArrayType) else VALUE, F.col("item"), element)]
                following.append(made(own.name + SEPARATOR + name, inner))
        level = following
    return levels


TABLE, MARK = "_table", "_"


@dataclass(frozen=True)
class FannedOut:
    """Rows of all tables: `_table`, the ids, and for each table a struct of its columns, NULL in the rows of others."""

    rows: DataFrame
    flat: Mapping[str, list[str]]
    root: str
    load_id: str

    def table(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """One table's rows, from the fanned-out rows or from where they were stored."""
        own = (self.rows if rows is None else rows).where(F.col(TABLE) == name)
        ids = [ROW_ID] if name == self.root else CHILD_COLUMNS
        values = [F.col(f"`{name}`").getField(c).alias(c) for c in self.flat[name]]
        return own.select(*ids, F.lit(self.load_id).alias(LOAD_ID), *values)

    def counts(self) -> list[Column]:
        """Aggregates that count each table's rows, to be observed or taken."""
        return [F.count_if(F.col(TABLE) == name).alias(name) for name in self.flat]


def fan_out(df: DataFrame, table: str, keys: Sequence[str], load_id: str, spread: bool = False) -> FannedOut:
    """The rows of all tables that `normalise` gives, from one pass over the records.

    Level by level each row becomes itself, without its lists, and the rows of its lists' elements. Nothing is shuffled
    but for `spread`, as for `normalise`. A task holds the elements of one list at a time.
    """
    levels = _tables(df.schema, table)
    every = [own for level in levels for own in level]
    rooted = (dealt_out(df) if spread else df).withColumn(ROW_ID, row_id(table, keys))
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in ((PARENT_ID, "binary"), (POSITION, "int"))]
    rows = rooted.select(F.lit(0).alias(TABLE), ROW_ID, *empty, _record(every[0], None).alias("c0"))
    number = 1
    for level in levels:
        first, number = number - len(level), number + sum(len(own.children) for own in level)
        if number == first + len(level):
            break
        rows = rows.select(F.inline(_expanded(every, first, len(level), number)))
        field = F.element_at(F.array(*(F.lit(name) for name in _list_names(every))), F.col(TABLE) + 1)
        rows = rows.withColumn(ROW_ID, F.coalesce(ROW_ID, child_id(F.col(PARENT_ID), field, F.col(POSITION))))
    names = F.array(*(F.lit(own.name) for own in every))
    values = [F.col(f"c{k}").alias(own.name) for k, own in enumerate(every) if own.flat]
    rows = rows.select(F.element_at(names, F.col(TABLE) + 1).alias(TABLE), ROW_ID, PARENT_ID, POSITION, *values)
    return FannedOut(rows, {own.name: own.flat for own in every}, table, load_id)


def _record(own: _Table, item: Column | None, flat_only: bool = False) -> Column:
    """A table's row as a struct; MARK keeps one without columns from being empty. `item` replaces the column of that name."""
    fields = [f for f in own.fields if not flat_only or f.name in own.flat]
    seen = [(f.column if item is None else _seen_from(f, item)).alias(f.name) for f in fields]
    return F.struct(*seen, F.lit(True).alias(MARK))


def _seen_from(field: _Field, item: Column) -> Column:
    """A field of an element, found below another column than `item`."""
    found = item
    for name in field.path:
        found = found.getField(name)
    return found


def _list_names(every: list[_Table]) -> list[str]:
    """The list that each table's rows are the elements of."""
    names = {child: field for own in every for field, child in own.children.items()}
    return [names.get(k, "") for k in range(len(every))]


def _expanded(every: list[_Table], first: int, size: int, number: int) -> Column:
    """For each row an array of itself without the lists of its table, and of the rows of their elements.

    The elements' own ids are left out, as a function over a list is not compiled.
    """
    known = first + size
    ids = [ROW_ID, PARENT_ID, POSITION]
    kept = []
    for k in range(known):
        slim = F.struct(*(F.col(f"c{k}").getField(c).alias(c) for c in every[k].flat), F.lit(True).alias(MARK))
        kept.append(F.when(F.col(f"c{k}").isNotNull(), slim) if k >= first else F.col(f"c{k}"))

    def nothing(k: int) -> Column:
        return F.lit(None).cast(_type_of(every[k], k >= known))

    def row(tag: Column, own_ids: list[Column], at: int | None, value: Column | None) -> Column:
        parts = [
            (value if k == at else kept[k] if at is None and k < known else nothing(k)).alias(f"c{k}") for k in range(number)
        ]
        return F.struct(tag.alias(TABLE), *(c.alias(n) for c, n in zip(own_ids, ids, strict=True)), *parts)

    def element_of(child: int) -> Callable[[Column, Column], Column]:
        def made(item: Column, i: Column) -> Column:
            return row(F.lit(child), [F.lit(None).cast("binary"), F.col(ROW_ID), i], child, _record(every[child], item))

        return made

    arrays = [F.array(row(F.col(TABLE), [F.col(c) for c in ids], None, None))]
    for k in range(first, known):
        for field, child in every[k].children.items():

            elements = F.transform(F.col(f"c{k}").getField(field), element_of(child))
            arrays.append(F.coalesce(elements, F.slice(arrays[0], 1, 0)))
    return F.concat(*arrays)


def _type_of(own: _Table, whole: bool) -> T.StructType:
    fields = [T.StructField(f.name, f.type) for f in own.fields if whole or f.name in own.flat]
    return T.StructType([*fields, T.StructField(MARK, T.BooleanType())])


def table_metrics(tables: Mapping[str, DataFrame] | FannedOut, internal_prefix: str = "_") -> DataFrame:
    """Rows of each table; bookkeeping tables are left out. Those of fanned-out records are counted in one pass."""
    if isinstance(tables, FannedOut):
        told = [F.struct(F.lit(n).alias("table_name"), F.col(f"`{n}`").alias("row_count")) for n in tables.flat]
        return tables.rows.select(TABLE).agg(*tables.counts()).select(F.inline(F.array(*told)))
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
        if not name.startswith(internal_prefix)
    ]
    return unite(counts)


def schema_version(df: DataFrame) -> str:
    """Short hash that changes when the schema does."""
    return hashlib.sha256(df.schema.json().encode()).hexdigest()[:16]
