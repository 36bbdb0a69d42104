import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators import nested
from meterline.sinks import loads
from tests.conftest import plan_of, rows

BOOK = (
    "key string, title string, author array<string>, "
    "editions struct<n: int, docs: array<struct<isbn: string, size: struct<h: int>, language: array<string>>>>, "
    "grid array<array<int>>"
)


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame(
        [
            ("b1", "One", ["x", "y"], (2, [("i1", (10,), ["en", "fr"]), ("i2", None, [])]), [[1, 2], [3]]),
            ("b2", "Two", [], (0, []), None),
            ("b3", "Three", None, None, [[]]),
            ("b4", "Four", [None], (1, [("i3", (7,), None)]), []),
        ],
        BOOK,
    )


@pytest.fixture(scope="module")
def tables(books):
    return nested.normalise(books, "books", ["key"], "l1")


def test_tables_and_columns(tables):
    assert {name: frame.columns for name, frame in tables.items()} == {
        "books": ["_row_id", "_load_id", "key", "title", "editions__n"],
        "books__author": ["_row_id", "_parent_id", "_position", "_load_id", "value"],
        "books__editions__docs": ["_row_id", "_parent_id", "_position", "_load_id", "isbn", "size__h"],
        "books__editions__docs__language": ["_row_id", "_parent_id", "_position", "_load_id", "value"],
        "books__grid": ["_row_id", "_parent_id", "_position", "_load_id"],
        "books__grid__list": ["_row_id", "_parent_id", "_position", "_load_id", "value"],
    }


def test_children_link_to_their_parents(tables):
    root, docs = tables["books"], tables["books__editions__docs"]
    languages, cells = tables["books__editions__docs__language"], tables["books__grid__list"]
    up = docs.join(root, docs._parent_id == root._row_id).select("key", "_position", "isbn", "size__h")
    assert rows(up) == [("b1", 0, "i1", 10), ("b1", 1, "i2", None), ("b4", 0, "i3", 7)]
    up = languages.join(docs, languages._parent_id == docs._row_id).select("isbn", "value")
    assert rows(up) == [("i1", "en"), ("i1", "fr")]
    assert rows(tables["books__author"].select("_position", "value")) == [(0, "x"), (0, None), (1, "y")]
    grid = tables["books__grid"].select(F.col("_row_id").alias("row"), F.col("_position").alias("line"))
    assert rows(cells.join(grid, cells._parent_id == grid.row).select("line", "value")) == [(0, 1), (0, 2), (1, 3)]


def test_a_null_element_keeps_its_place(spark):
    df = spark.sql("SELECT 1 AS k, array(named_struct('a', 1, 'b', array('x')), NULL) AS items")
    child = nested.normalise(df, "t", ["k"], "l1")["t__items"]
    assert rows(child.select("_position", "a")) == [(0, 1), (1, None)]


def test_child_table_leaves_inner_lists_unread(spark, books, folder):
    books.write.parquet(folder)
    tables = nested.normalise(spark.read.parquet(folder), "books", ["key"], "l1")
    read = "ReadSchema: struct<key:string,editions:struct<docs:array<struct<"
    assert read + "isbn:string,size:struct<h:int>>>>>" in plan_of(tables["books__editions__docs"])
    assert read + "language:array<string>>>>>" in plan_of(tables["books__editions__docs__language"])


def test_ids_are_unique_and_repeatable(books, tables):
    again = nested.normalise(books.repartition(3), "books", ["key"], "l1")
    for name, frame in tables.items():
        ids = [r[0] for r in frame.select("_row_id").collect()]
        assert len(set(ids)) == len(ids)
        assert rows(again[name]) == rows(frame)


def test_ids_tell_apart_keys_that_read_alike(spark):
    df = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), ('a","b', "c"), (None, "c"), ("null", "c")], "x string, y string")
    assert df.select(nested.row_id("t", ["x", "y"])).distinct().count() == 5


def test_clashing_flat_names_are_refused(spark):
    df = spark.sql("SELECT 1 AS a__b, struct(2 AS b) AS a")
    with pytest.raises(ValueError, match="a__b"):
        nested.flatten_struct(df)
    deep = spark.sql("SELECT 1 AS k, array(1) AS a__b, array(named_struct('b', array(2))) AS a")
    with pytest.raises(ValueError, match="t__a__b"):
        nested.normalise(deep, "t", ["k"], "l1")


def test_nesting_lines_and_taking_them_apart_gives_the_lines(small):
    lines = small("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    got = nested.normalise(orders, "orders", ["l_orderkey"], "l1")
    root, child = got["orders"], got["orders__lines"]
    back = child.join(root, child._parent_id == root._row_id).select("l_orderkey", "l_linenumber", "l_quantity")
    assert rows(back) == rows(lines)


def test_metrics_leave_bookkeeping_out(tables, books):
    got = dict(rows(nested.table_metrics({**tables, "_loads": books})))
    assert got == {"books": 4, "books__author": 3, "books__editions__docs": 3, "books__editions__docs__language": 2,
                   "books__grid": 3, "books__grid__list": 3}


@pytest.mark.parametrize("spread", [False, True])
def test_fanned_out_rows_are_those_of_each_table(books, tables, spread):
    fanned = nested.fan_out(books, "books", ["key"], "l1", spread)
    assert set(fanned.flat) == set(tables)
    for name, frame in tables.items():
        got = fanned.table(name)
        assert got.columns == frame.columns and rows(got) == rows(frame), name
    assert rows(nested.table_metrics(fanned)) == rows(nested.table_metrics(tables))


def test_texts_are_dealt_out_before_their_lists_are_made(spark, folder):
    from querybook.feeds import Tables
    from querybook.nested import child_nested_levels

    docs = spark.createDataFrame([(i, f"a{i} b\nc", "aa", "s") for i in range(40)], "doc_id long, text string, lang string, source string")
    few, many = f"{folder}/few", f"{folder}/many"
    docs.coalesce(1).write.parquet(f"{few}/documents.parquet")
    docs.repartition(2 * spark.sparkContext.defaultParallelism).write.parquet(f"{many}/documents.parquet")
    got = {at: child_nested_levels(Tables(spark, at)) for at in (few, many)}
    assert "Exchange" not in plan_of(got[many])
    # the lists are several times larger than the text
    moved = plan_of(got[few]).split("Exchange\nInput", 1)[1].split("\n", 1)[0]
    assert "text" in moved and "words" not in moved
    assert rows(got[few]) == rows(got[many]) and got[few].count() == 120


def test_records_are_scanned_once_for_all_tables(spark, books, folder):
    books.write.parquet(folder)
    plan = plan_of(nested.fan_out(spark.read.parquet(folder), "books", ["key"], "l1").rows)
    assert plan.count("Location:") == 1 and "Exchange" not in plan


def test_fanning_out_odd_records(spark):
    df = spark.sql(
        "SELECT 1 AS k, array(named_struct('a', 1, 'b', array('x')), NULL) AS items, array(array(array(1, 2)), NULL) AS deep, "
        "array(named_struct('only', array(7))) AS bare UNION ALL SELECT 2, NULL, array(), NULL"
    )
    tables, fanned = nested.normalise(df, "t", ["k"], "l1"), nested.fan_out(df, "t", ["k"], "l1")
    assert set(fanned.flat) == set(tables) and {"t__deep__list__list", "t__bare__only"} <= set(tables)
    for name, frame in tables.items():
        assert rows(fanned.table(name)) == rows(frame), name
    alone = nested.fan_out(spark.range(3), "r", ["id"], "l1")
    assert rows(alone.table("r").select("id")) == [(0,), (1,), (2,)]
    clash = spark.sql("SELECT 1 AS k, array(1) AS a__b, array(named_struct('b', array(2))) AS a")
    with pytest.raises(ValueError, match="t__a__b"):
        nested.fan_out(clash, "t", ["k"], "l1")


def test_reload_replaces_and_history_grows(spark, books, folder):
    at = dt.datetime(2024, 1, 1)
    twice = books.unionByName(books)
    loads.replace_load(twice, folder, "books", ["key"], "l1", ["title"], at)
    stored = loads.replace_load(books.where("key <> 'b4'"), folder, "books", ["key"], "l2", ["title"], at)
    assert stored["books"].count() == 3 and stored["books__author"].count() == 2
    history = loads.load_history(spark, folder)
    version = nested.schema_version(books)
    told = history.select("_load_id", "table_name", "status", "schema_version", "loaded_at", "turn")
    assert rows(told) == [("l1", "books", 0, version, at, 0), ("l2", "books", 0, version, at, 1)]
    counts = {r["_load_id"]: r["row_counts"] for r in history.collect()}
    assert counts["l1"]["books"] == 4 and counts["l2"] == {name: frame.count() for name, frame in stored.items()}


def test_a_load_is_switched_as_a_whole(spark, books, folder):
    """Lists that go away take their tables with them, a lost load leaves the last one, a run again takes its place."""
    first = loads.replace_load(books, folder, "books", ["key"], "l1")
    reading = first["books__author"]
    slim = loads.replace_load(books.drop("author").where("key = 'b1'"), folder, "books", ["key"], "l2")
    assert set(first) - set(slim) == {"books__author"} and reading.count() == 3
    broken = books.withColumn("title", F.when(F.col("key") == "b3", F.raise_error(F.lit("lost"))).otherwise(F.col("title")))
    with pytest.raises(Exception, match="lost"):
        loads.replace_load(broken, folder, "books", ["key"], "l3")
    stored = loads.stored_tables(spark, folder, "books")
    assert {r[0] for frame in stored.values() for r in frame.select("_load_id").distinct().collect()} == {"l2"}
    assert set(stored) == set(slim) and rows(stored["books"].select("key")) == [("b1",)]
    again = loads.replace_load(books, folder, "books", ["key"], "l2")
    assert again["books"].count() == 4 and again["books__author"].columns == reading.columns
    with pytest.raises(Exception, match="(?s)FILE_NOT_EXIST|does not exist"):
        reading.count()
    empty = loads.replace_load(books.limit(0), folder, "books", ["key"], "l5")
    assert set(empty) == set(again) and all(frame.isEmpty() for frame in empty.values())
    with pytest.raises(FileNotFoundError):
        loads.stored_tables(spark, folder, "other")


def test_increments_add_each_row_once(spark, folder):
    source = spark.createDataFrame([(i, dt.datetime(2024, 1, i)) for i in range(1, 7)], "id int, ts timestamp_ntz")
    loads.load_increment(source.where("id <= 2"), folder, "t", "ts", "l1")
    loads.load_increment(source.where("id <= 4"), folder, "t", "ts", "l2")
    again = loads.load_increment(source, folder, "t", "ts", "l2")
    assert rows(again.select("id", "_load_id")) == [(1, "l1"), (2, "l1"), (3, "l2"), (4, "l2")]
    nothing = loads.load_increment(source.where("id <= 4"), folder, "t", "ts", "l3")
    assert nothing.count() == 4
    done = loads.load_increment(source, folder, "t", "ts", "l4")
    assert done.count() == 6
    assert rows(loads.load_state(spark, folder, "t")) == [("t", "l4", dt.datetime(2024, 1, 6))]


def test_increment_refuses_rows_without_a_cursor(spark, folder):
    source = spark.createDataFrame([(1, 10), (2, None)], "id int, seq int")
    loads.load_increment(source.where("id = 1"), folder, "t", "seq", "l1")
    with pytest.raises(Exception, match="row without seq"):
        loads.load_increment(source, folder, "t", "seq", "l2")
    assert loads.load_increment(source.where("id = 1"), folder, "t", "seq", "l3").count() == 1


def test_increment_lost_before_its_state_is_taken_over(spark, folder):
    source = spark.createDataFrame([(1, 10), (2, 20)], "id int, seq int")
    from meterline.sinks.files import write_parquet

    write_parquet(source.where("id = 1"), f"{folder}/t/_load_id=007")
    got = loads.load_increment(source, folder, "t", "seq", "007")
    assert rows(got) == [(1, 10, "007"), (2, 20, "007")]
