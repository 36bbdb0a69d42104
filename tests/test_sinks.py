import datetime as dt
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators.filters import half_open
from meterline.session import shared_root
from meterline.sinks import loads
from meterline.sinks import strategies as act
from meterline.sinks.files import write_parquet
from meterline.sinks.tables import append_rows, ctas_interleaved, ctas_partitioned, keyed_table, load_table, replace_table, table_options
from meterline.spec import Column, TableSpec
from tests.conftest import rows

PAIR = "k int, v string"


def frame(spark, data, columns=PAIR):
    return spark.createDataFrame(data, columns)


def table(spark, base, data, columns=PAIR, by=()):
    name = f"{base}.t"
    replace_table(frame(spark, data, columns), name, by)
    return name


def session_like(master, checkpoint_dir):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: checkpoint_dir), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert shared_root(session_like("yarn", "hdfs://store/shared/")) == "hdfs://store/shared"
    with pytest.raises(RuntimeError):
        shared_root(session_like("yarn", None))
    assert os.path.isdir(shared_root(session_like("local[2]", None)))


def test_default_write_refuses_to_replace(spark, folder):
    write_parquet(spark.range(3), folder)
    with pytest.raises(AnalysisException):
        write_parquet(spark.range(9), folder)
    assert spark.read.parquet(folder).count() == 3


def test_number_of_files(spark, folder):
    write_parquet(spark.range(1000), folder, files=4)
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) == 4


def test_rows_tied_with_the_last_cursor_are_loaded_once(spark, folder):
    def source(*pairs):
        return spark.createDataFrame(list(pairs), "id long, at long")

    loads.load_increment(source((1, 5), (2, 5)), folder, "t", "at", "a")
    got = loads.load_increment(source((1, 5), (2, 5), (3, 5), (4, 6)), folder, "t", "at", "b")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]
    loads.load_increment(source((4, 6)), folder, "t", "at", "c")
    assert rows(loads.load_state(spark, folder, "t")) == [("t", "c", 6)]


def test_empty_first_window_leaves_a_usable_table(spark, base):
    empty = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS at, 1 AS n")
    act.time_interval(spark, f"{base}.w", empty, "at", "2024-01-01", "2024-01-01")
    act.time_interval(spark, f"{base}.w", empty, "at", "2024-01-01", "2024-01-02")
    assert spark.table(f"{base}.w").count() == 1


def test_bounded_files_on_load(spark, base):
    load_table(spark.range(250).coalesce(1), f"{base}.t", batch_rows=100)
    per_file = spark.table(f"{base}.t").groupBy("_metadata.file_path").count()
    assert rows(per_file.select("count")) == [(100,), (100,), (50,)]


def test_append_matches_names_and_keeps_rows(spark, base):
    name = table(spark, base, [(1, "a")])
    append_rows(frame(spark, [("b", 2)], "v string, k int"), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_one_hot_day_is_spread_over_files_in_cluster_order(spark, base):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        events = spark.range(60_000).select(
            F.timestamp_add("SECOND", F.pmod("id", F.lit(86_400)).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
            .alias("ts"), F.pmod("id", F.lit(5)).alias("vendor"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        stored = ctas_partitioned(events.repartition(8), f"{base}.t", "ts", ["vendor"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(stored.inputFiles()) > 1 and stored.count() == 60_000
    numbered = stored.select("vendor", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    both = numbered.alias("a").join(numbered.alias("b"), F.expr("a.f = b.f AND a.i + 1 = b.i"))
    assert both.where("a.vendor > b.vendor").isEmpty()


def test_merge_updates_inserts_and_never_matches_null(spark, base):
    name = table(spark, base, [(1, "a"), (2, "b"), (2, "bb"), (None, "n")])
    act.merge(spark, name, frame(spark, [(2, "B"), (3, "c"), (None, "N"), (None, "NN")]), ["k"])
    assert rows(spark.table(name)) == rows(
        frame(spark, [(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N"), (None, "NN")])
    )
    assert [t.name for t in spark.catalog.listTables(base) if not t.isTemporary] == ["t"]


def test_merge_refuses_repeated_keys(spark, base):
    name = table(spark, base, [(1, "a")])
    with pytest.raises(ValueError):
        act.merge(spark, name, frame(spark, [(1, "b"), (1, "c")]), ["k"])
    assert rows(spark.table(name)) == [(1, "a")]


def test_swap_lost_halfway_is_undone(spark, base):
    name = table(spark, base, [(1, "a")])
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__previous")
    act.merge(spark, name, frame(spark, [(2, "b")]), ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_merge_may_read_its_target(spark, base):
    name = table(spark, base, [(1, "a"), (2, "b")])
    act.merge(spark, name, spark.table(name).where("k = 2").withColumn("v", F.upper("v")), ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "B")]


def test_delete_insert_keeps_all_source_rows(spark, base):
    name = table(spark, base, [(1, "a"), (2, "b"), (2, "bb")])
    act.delete_insert(spark, name, frame(spark, [(2, "x"), (2, "y"), (4, "z")]), ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "x"), (2, "y"), (4, "z")]


def test_merge_by_partition_key_leaves_other_partitions_alone(spark, base):
    columns = "id int, v string, day string"
    data = [(1, "a", "mon"), (2, "b", "tue"), (3, "n", None)]
    name = table(spark, base, data, columns, ["day"])
    before = {f for f in spark.table(name).inputFiles() if "day=mon" in f}
    source = frame(spark, [(2, "B", "tue"), (4, "d", "wed"), (5, "N", None)], columns)
    act.merge(spark, name, source, ["day", "id"])
    assert rows(spark.table(name)) == rows(
        frame(spark, [(1, "a", "mon"), (2, "B", "tue"), (4, "d", "wed"), (3, "n", None), (5, "N", None)], columns)
    )
    assert before == {f for f in spark.table(name).inputFiles() if "day=mon" in f}


DAYS = [(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2)), (3, "c", dt.date(2024, 1, 3)), (4, "n", None)]


@pytest.mark.parametrize("strategy", [act.merge, act.delete_insert])
def test_rows_move_between_partitions_and_others_keep_their_files(spark, base, strategy):
    columns = "id int, v string, day date"
    name = table(spark, base, DAYS, columns, ["day"])
    before = {f for f in spark.table(name).inputFiles() if "day=2024-01-03" in f}
    strategy(spark, name, frame(spark, [(2, "B", dt.date(2024, 1, 1)), (4, "N", dt.date(2024, 1, 1))], columns), ["id"])
    expected = [(1, "a", DAYS[0][2]), (2, "B", DAYS[0][2]), (4, "N", DAYS[0][2]), (3, "c", DAYS[2][2])]
    assert rows(spark.table(name)) == rows(frame(spark, expected, columns))
    assert before == {f for f in spark.table(name).inputFiles() if "day=2024-01-03" in f}


@pytest.mark.parametrize("strategy", ["merge", "delete_insert"])
def test_declared_upsert_touches_only_its_days(spark, base, strategy):
    name = f"{base}.t"
    columns = [Column("ts", "timestamp_ntz", primary_key=True), Column("v", "string")]
    spec = TableSpec(name, columns, strategy, incremental_key="ts", granularity="timestamp")
    act.materialise(spark, spec, frame(spark, [(dt.datetime(2024, 1, d, 5), "a") for d in (1, 2, 3)], NTZ))
    before = {f for f in spark.table(name).inputFiles() if "_day=2024-01-02" not in f}
    act.materialise(spark, spec, frame(spark, [(dt.datetime(2024, 1, 2, h), "B") for h in (5, 6)], NTZ))
    assert sorted(r.v for r in spark.table(name).collect()) == ["B", "B", "a", "a"]
    assert before == {f for f in spark.table(name).inputFiles() if "_day=2024-01-02" not in f}


@pytest.mark.parametrize("strategy", [act.merge, act.delete_insert])
def test_upsert_of_a_keyed_table_touches_only_its_slots(spark, base, strategy):
    name = f"{base}.keyed"
    keyed_table(frame(spark, [(k, "a") for k in range(200)] + [(None, f"n{k}") for k in range(40)]), name, ["k"], 16)
    before = set(spark.table(name).inputFiles())
    assert len(before) >= 16 and spark.table(name).where("k IS NULL").select("_slot").distinct().count() > 5
    strategy(spark, name, frame(spark, [(7, "B"), (1000, "c"), (None, "N")]), ["k"])
    expected = [(k, "B" if k == 7 else "a") for k in range(200)] + [(None, f"n{k}") for k in range(40)] + [(1000, "c"), (None, "N")]
    assert rows(spark.table(name).drop("_slot")) == rows(frame(spark, expected))
    assert len(before - set(spark.table(name).inputFiles())) <= 3
    append_rows(frame(spark, [(3000, "d")]), name)
    strategy(spark, name, frame(spark, [(3000, "D"), (5, "E")]), ["k"])
    assert rows(spark.table(name).where("k IN (5, 3000)").select("v")) == [("D",), ("E",)]


def test_upsert_of_a_keyed_table_by_another_key(spark, base):
    name = f"{base}.keyed"
    keyed_table(frame(spark, [(k, f"v{k % 50}") for k in range(100)]), name, ["k"], 8)
    act.delete_insert(spark, name, frame(spark, [(500, "v3"), (501, "v3")]), ["v"])
    got = spark.table(name)
    assert got.count() == 100 and rows(got.where("v = 'v3'").select("k")) == [(500,), (501,)]


@pytest.mark.parametrize("listed", [act.LISTED, 1])
def test_upsert_of_a_table_with_two_partition_columns(spark, base, listed, monkeypatch):
    monkeypatch.setattr(act, "LISTED", listed)
    columns = "id int, v string, y int, m string"
    data = [(1, "a", 2024, "o'x"), (2, "b", 2024, "2"), (3, "c", 2025, "1"), (4, "d", None, "2"), (5, "e", 2025, None)]
    name = table(spark, base, data, columns, ["y", "m"])
    before = {f for f in spark.table(name).inputFiles() if "y=2025/m=1" in f}
    act.merge(spark, name, frame(spark, [(1, "A", 2024, "2"), (4, "D", 2024, "2"), (6, "f", None, "2")], columns), ["id"])
    expected = [(1, "A", 2024, "2"), (2, "b", 2024, "2"), (3, "c", 2025, "1"), (4, "D", 2024, "2"), (5, "e", 2025, None), (6, "f", None, "2")]
    assert rows(spark.table(name)) == rows(frame(spark, expected, columns))
    assert before and before == {f for f in spark.table(name).inputFiles() if "y=2025/m=1" in f}
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert not any("o" in p.split("m=")[1] and "x" in p for p in parts)


def test_declared_upsert_with_slots(spark, base):
    spec = TableSpec(f"{base}.t", [Column("k", "int", primary_key=True), Column("v", "string")], "merge", slots=8)
    act.materialise(spark, spec, frame(spark, [(k, "a") for k in range(50)]))
    before = set(spark.table(spec.name).inputFiles())
    got = act.materialise(spark, spec, frame(spark, [(3, "B"), (90, "C")]))
    assert got.count() == 51 and len(before - set(got.inputFiles())) <= 2


def test_merge_keeps_table_options(spark, base):
    name = f"{base}.limited"
    replace_table(frame(spark, [(k, "a") for k in range(9)]), name, maxRecordsPerFile=3)
    act.merge(spark, name, frame(spark, [(1, "b")]), ["k"])
    assert table_options(spark, name)["maxRecordsPerFile"] == "3" and spark.table(name).count() == 9


NTZ = "ts timestamp_ntz, v string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def interval_table(spark, base):
    name = f"{base}.t"
    data = [(at(1, 1), "a"), (at(1, 13), "b"), (at(2, 5), "c"), (at(3, 5), "d"), (at(3, 20), "e"), (at(9), "z")]
    act.time_interval(spark, name, frame(spark, data, NTZ), "ts", "2024-01-01", "2024-02-01")
    spark.sql(f"INSERT INTO {name} VALUES (NULL, 'null', NULL)")
    return name


def values(spark, name):
    return sorted(r.v for r in spark.table(name).collect())


def test_window_off_midnight_keeps_the_rest_of_its_days(spark, base):
    name = interval_table(spark, base)
    source = frame(spark, [(at(1, 14), "B"), (at(3, 4), "D")], NTZ)
    got = act.time_interval(spark, name, source, "ts", "2024-01-01 12:00:00", "2024-01-03 12:00:00")
    assert values(spark, name) == ["B", "D", "a", "e", "null", "z"]
    days = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert "_day=2024-01-02" not in days and "_day=2024-01-09" in days
    assert act.window_rows(got, "ts", "2024-01-01", "2024-01-02").count() == 2


def test_window_run_twice_gives_the_same(spark, base):
    name = interval_table(spark, base)
    source = frame(spark, [(at(2, 1), "C")], NTZ)
    for _ in range(2):
        act.time_interval(spark, name, source, "ts", "2024-01-02", "2024-01-03")
    assert values(spark, name) == ["C", "a", "b", "d", "e", "null", "z"]


def test_window_without_new_rows_empties_its_days(spark, base):
    name = interval_table(spark, base)
    act.time_interval(spark, name, frame(spark, [], NTZ), "ts", "2024-01-01", "2024-01-04")
    assert values(spark, name) == ["null", "z"]
    act.time_interval(spark, name, frame(spark, [], NTZ), "ts", "2024-01-08", "2024-01-08")
    assert values(spark, name) == ["null", "z"]


def test_partial_day_left_without_rows_is_dropped(spark, base):
    name = interval_table(spark, base)
    act.time_interval(spark, name, frame(spark, [], NTZ), "ts", "2024-01-02 04:00:00", "2024-01-02 06:00:00")
    assert values(spark, name) == ["a", "b", "d", "e", "null", "z"]


@pytest.mark.parametrize("stray", [at(5), None])
def test_source_outside_the_window_fails_before_anything_changes(spark, base, stray):
    name = interval_table(spark, base)
    with pytest.raises(Exception, match="outside the window"):
        act.time_interval(spark, name, frame(spark, [(at(2), "x"), (stray, "y")], NTZ), "ts", "2024-01-02", "2024-01-03")
    assert values(spark, name) == ["a", "b", "c", "d", "e", "null", "z"]
    assert spark.conf.get(act.OVERWRITE_MODE).lower() == "static"


def test_source_may_read_the_table(spark, base):
    name = interval_table(spark, base)
    source = half_open(spark.table(name).drop(act.DAY), "ts", "2024-01-03", "2024-01-04").withColumn("v", F.upper("v"))
    act.time_interval(spark, name, source, "ts", "2024-01-03", "2024-01-04")
    assert values(spark, name) == ["D", "E", "a", "b", "c", "null", "z"]


def test_table_without_day_partitions_is_refused(spark, base):
    name = table(spark, base, [(at(1), "a")], NTZ)
    with pytest.raises(ValueError, match="not partitioned"):
        act.time_interval(spark, name, frame(spark, [], NTZ), "ts", "2024-01-01", "2024-01-02")
    assert spark.table(name).count() == 1


def test_date_windows(spark, base):
    name, columns = f"{base}.t", "day date, n int"
    days = frame(spark, [(dt.date(2024, 1, d), d) for d in (1, 2, 3)], columns)
    act.time_interval(spark, name, days, "day", "2024-01-01", "2024-01-04", "date")
    new = frame(spark, [(dt.date(2024, 1, 2), 22)], columns)
    act.time_interval(spark, name, new, "day", "2024-01-02", "2024-01-04", "date")
    assert sorted(r.n for r in spark.table(name).collect()) == [1, 22]
    with pytest.raises(ValueError):
        act.time_interval(spark, name, new, "day", "2024-01-02 06:00:00", "2024-01-04", "date")


@pytest.mark.parametrize(
    "strategy,second",
    [
        ("table", [(2, "B"), (3, "c")]),
        ("append", [(1, "a"), (2, "B"), (2, "b"), (3, "c")]),
        ("merge", [(1, "a"), (2, "B"), (3, "c")]),
        ("delete_insert", [(1, "a"), (2, "B"), (3, "c")]),
        ("view", [(2, "B"), (3, "c")]),
    ],
)
def test_declared_strategies(spark, base, strategy, second):
    name = f"v_{base}" if strategy == "view" else f"{base}.t"
    spec = TableSpec(name, [Column("k", "int", primary_key=True), Column("v", "string")], strategy)
    act.materialise(spark, spec, frame(spark, [("a", "1"), ("b", "2")], "v string, k string"))
    act.materialise(spark, spec, frame(spark, [(2, "B"), (3, "c")]))
    assert rows(spark.table(name)) == second
    act.materialise(spark, spec, frame(spark, [(9, "z")]), full_refresh=True)
    assert rows(spark.table(name)) == [(9, "z")]


@pytest.mark.parametrize("column,wanted", [("a", "a = 17"), ("b", "b = 'b050'")])
def test_interleaved_files_are_skipped_by_either_column(spark, base, column, wanted):
    events = spark.range(40_000).selectExpr(
        "TIMESTAMP_NTZ '2024-01-05 01:00:00' AS ts", "cast(pmod(hash(id), 100) AS int) AS a",
        "concat('b', lpad(pmod(xxhash64(id), 100), 3, '0')) AS b", "id",
    )
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = ctas_interleaved(events, f"{base}.t", "ts", ["a", "b"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(stored.select("id", "a", "b")) == rows(events.select("id", "a", "b"))
    value = wanted.split(" = ")[1]
    by_file = stored.groupBy("_metadata.file_path").agg(F.expr(f"min({column}) <= {value} AND max({column}) >= {value}").alias("may"))
    n, may = by_file.count(), by_file.where("may").count()
    assert n >= 24 and may <= n / 2, (n, may)


def test_interleaving_one_value_nulls_and_no_rows(spark, base):
    odd = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05' AS ts, CAST(NULL AS INT) AS a, 'x' AS b UNION ALL SELECT NULL, NULL, NULL")
    assert rows(ctas_interleaved(odd, f"{base}.t", "ts", ["a", "b"]).select("b")) == [("x",), (None,)]
    assert ctas_interleaved(odd.limit(0), f"{base}.u", "ts", ["a", "b"]).isEmpty()


def test_months_of_states_are_replaced_day_by_day(spark, base):
    def source(days, value):
        return frame(spark, [(day, value) for day in days], "day date, v int")

    name, day = f"{base}.t", lambda m, d: dt.date(2024, m, d)
    window = (day(1, 5), day(3, 10))
    act.time_interval(spark, name, source([day(1, 5), day(2, 1), day(2, 9), day(3, 1), day(3, 9)], 1), "day", *window, "date", by="month")
    before = {f for f in spark.table(name).inputFiles() if "_month=2024-01" in f}
    got = act.time_interval(spark, name, source([day(2, 9), day(2, 20)], 2), "day", day(2, 5), day(3, 5), "date", by="month")
    assert rows(got.select("day", "v")) == rows(
        frame(spark, [(day(1, 5), 1), (day(2, 1), 1), (day(2, 9), 2), (day(2, 20), 2), (day(3, 9), 1)], "day date, v int")
    )
    assert before == {f for f in got.inputFiles() if "_month=2024-01" in f}
    assert act.time_interval(spark, name, source([], 2), "day", day(1, 1), day(2, 1), "date", by="month").count() == 4


def test_views_of_a_database(spark, base):
    table(spark, base, [(1, "a"), (2, "a")])
    spec = TableSpec(f"{base}.counts", [Column("v", "string"), Column("n", "int")], "view", query=f"SELECT v, count(*) AS n FROM {base}.t GROUP BY v")
    assert rows(act.materialise(spark, spec)) == [("a", 2)]
    append_rows(frame(spark, [(3, "a")]), f"{base}.t")
    assert rows(spark.newSession().table(f"{base}.counts")) == [("a", 3)]
    act.as_catalog_view(spark, f"{base}.counts", "SELECT 1 AS one")
    assert rows(spark.table(f"{base}.counts")) == [(1,)]
    with pytest.raises(ValueError, match="as_catalog_view"):
        act.as_view(frame(spark, [(1, "a")]), "reports.x")
    with pytest.raises(ValueError):
        TableSpec("t", [Column("v", "string")], "table", query="SELECT 1 AS v")
    with pytest.raises(ValueError, match="needs a frame"):
        act.materialise(spark, TableSpec("t", [Column("v", "string")]))


def test_ties_are_compared_with_the_state_alone(spark, folder):
    """Kept rows are not read again: with their files gone, a tied load still adds just what is new."""
    columns = "id long, note string, at long"

    def source(*data):
        return spark.createDataFrame(list(data), columns)

    loads.load_increment(source((1, "a", 4), (2, None, 5), (2, None, 5), (3, "c", 5)), folder, "t", "at", "l1")
    write_parquet(source(), f"{folder}/t/_load_id=l1", "overwrite")
    more = source((2, None, 5), (2, None, 5), (2, None, 5), (3, "c", 5), (None, "2", 5), (1, "a", 4))
    got = loads.load_increment(more, folder, "t", "at", "l2")
    assert rows(got.select("id", "note")) == [(2, None), (None, "2")]
    assert loads.load_increment(more, folder, "t", "at", "l3").count() == 2
    newer = loads.load_increment(source((9, "z", 6)), folder, "t", "at", "l4")
    assert newer.count() == 3
    assert loads.load_increment(source((9, "z", 6), (9, "z", 6)), folder, "t", "at", "l5").count() == 4
    assert rows(loads.load_state(spark, folder, "t")) == [("t", "l5", 6)]


def test_repartitioned_write_keeps_files_below_the_row_limit(spark, monkeypatch):
    from querybook import sinks as book

    lines = spark.range(23).withColumnRenamed("id", "l_orderkey")
    t = type("Tables", (), {"spark": spark, "__call__": lambda self, name: lines})()
    monkeypatch.setattr(book, "ROWS_PER_FILE", 5)
    assert rows(book.write_repartitioned(t)) == [(23, 5)]
    monkeypatch.setattr(book, "ROWS_PER_FILE", 100)
    assert rows(book.write_repartitioned(t)) == [(23, 4)]
