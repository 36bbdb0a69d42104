import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from meterline.operators.checks import ChecksFailed
from meterline.sinks.files import jdbc_options, write_parquet
from meterline.sources import files, schemas
from meterline.sources.landing import TRIP_SCHEMA, ingest_months, month_spine, refused_cells
from meterline.sources.records import REFUSED, good, pages_until_empty, refused, select_records, split_records, write_split
from meterline.sources.seeds import PAYMENT_LOOKUP, load_seed
from meterline.types import struct_of
from tests.conftest import plan_of, rows


def put(folder, name, text, compressed=False):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with (gzip.open if compressed else open)(path, "wt") as out:
        out.write(text)
    return path


def test_bad_cell_is_null_and_gzip_is_read(spark, folder):
    path = put(folder, "t.csv.gz", "id,when,x\n1,2024-01-01 10:00:00,2.5\ntwo,never,3.5\n", compressed=True)
    got = files.read_csv(spark, path, struct_of("id int, when timestamp_ntz, x double"))
    assert rows(got) == [(1, dt.datetime(2024, 1, 1, 10), 2.5), (None, None, 3.5)]


def test_raw_csv_is_text(spark, folder):
    path = put(folder, "t.csv", "id,x\n1,2.5\n")
    assert rows(files.read_csv_raw(spark, path)) == [("1", "2.5")]


def test_schema_is_inferred_from_all_lines(spark, folder):
    late = "".join(f"{i},{i}.5,{i}\n" for i in range(1500)) + "7,8,X1500\n"
    path = put(folder, "t.csv", "id,x,s\n" + late)
    got = files.infer_csv_schema(spark, path)
    assert [f.dataType.simpleString() for f in got.fields] == ["int", "double", "string"]
    assert files.read_csv(spark, path, got).where("s IS NULL").isEmpty()


def test_tree_has_the_columns_of_all_files(spark, folder):
    write_parquet(spark.range(1).selectExpr("id AS a"), f"{folder}/2020")
    write_parquet(spark.range(1).selectExpr("id AS a", "1.5D AS fee"), f"{folder}/2025")
    assert rows(files.read_parquet_tree(spark, folder)) == [(0, 1.5), (0, None)]
    write_parquet(spark.range(1).selectExpr("id AS a", "2.5D AS fee"), f"{folder}/2020", "append")
    wanted = struct_of("a bigint, fee double")
    assert rows(files.read_parquet_as(spark, wanted, f"{folder}/2020")) == [(0, 2.5), (0, None)]


def test_declared_schema_over_files_of_other_types(spark, folder):
    write_parquet(spark.range(2).selectExpr("id", "cast(id AS int) AS n"), f"{folder}/a")
    write_parquet(spark.range(2, 3).selectExpr("id", "id AS n", "'x' AS extra"), f"{folder}/b")
    wanted = struct_of("id int, n double, missing string")
    got = files.read_parquet_as(spark, wanted, f"{folder}/a", f"{folder}/b")
    assert rows(got) == [(0, 0.0, None), (1, 1.0, None), (2, 2.0, None)] and got.schema.names == wanted.names


def test_tree_whose_types_changed_twice(spark, folder, monkeypatch):
    """One column widens and narrows again, another turns to text, a third comes late; directories nest and files mix."""
    for month in range(12):
        n = "id AS n" if month < 4 else "id + 0.5D AS n" if month < 8 else "cast(id AS int) AS n"
        code = "cast(id AS smallint) AS code" if month < 6 else "concat('c', id) AS code"
        late = ["named_struct('a', cast(id AS int)) AS s"] if month == 10 else ["named_struct('a', id, 'b', 'x') AS s"] if month == 11 else []
        write_parquet(spark.range(2).selectExpr(f"{month} AS month", n, code, *late), f"{folder}/y={month // 6}/m={month}", files=1)
    spark.range(2).selectExpr("3 AS month", "'t' AS n", "cast(id AS tinyint) AS code").write.mode("append").parquet(f"{folder}/y=0/m=3")
    put(folder, "notes.txt", "no Parquet")
    got = files.read_parquet_tree(spark, folder)
    assert got.dtypes == [("month", "int"), ("n", "string"), ("code", "string"), ("s", "struct<a:bigint,b:string>")]
    assert got.count() == 26 and got.select("s").distinct().count() == 5
    seen = {r.month: sorted(r.n) for r in got.groupBy("month").agg(F.collect_list("n").alias("n")).collect()}
    assert seen[3] == ["0", "1", "t", "t"] and seen[5] == ["0.5", "1.5"] and seen[9] == ["0", "1"]
    plan = plan_of(got.where("month = 7").select("n"))
    assert "EqualTo(month,7)" in plan and "code:" not in plan


def test_few_jobs_find_a_change_among_many_files(spark, folder):
    for month in range(40):
        write_parquet(spark.range(1).selectExpr("id" if month < 23 else "id + 0.5D AS id"), f"{folder}/{month:02d}", files=1)
    looks = []

    class Spy:
        def __getattr__(self, name):
            looks.append(1) if name == "read" else None
            return getattr(spark, name)

    paths = [f"{folder}/{month:02d}" for month in range(40)]
    groups, unreadable = schemas.schema_groups(Spy(), [*paths, f"{folder}/none"], schemas.members_of(spark))
    assert [len(g) for g, _ in groups] == [23, 17] and unreadable == [f"{folder}/none"] and len(looks) <= 30


@pytest.mark.parametrize("a,b,both", [
    ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "float", "double"),
    ("smallint", "float", "float"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,10)", "bigint", "decimal(38,10)"),
    ("decimal(38,30)", "bigint", "double"), ("decimal(4,1)", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", "timestamp"), ("timestamp", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"),
    ("boolean", "int", "string"), ("void", "date", "date"), ("array<int>", "array<double>", "array<double>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("struct<A:int>", "struct<a:bigint,b:date>", "struct<A:bigint,b:date>"),
])
def test_common_types(spark, a, b, both):
    one, other = (spark.createDataFrame([], f"x {kind}").schema["x"].dataType for kind in (a, b))
    assert schemas.common_type(one, other).simpleString() == both
    assert schemas.common_type(other, one).simpleString().lower() == both.lower()


def test_nested_beside_flat_has_no_common_type(spark, folder):
    write_parquet(spark.range(1).selectExpr("id AS x"), f"{folder}/a")
    write_parquet(spark.range(1).selectExpr("array(id) AS x"), f"{folder}/b")
    with pytest.raises(schemas.NoCommonType, match="column x"):
        files.read_parquet_tree(spark, folder)


def test_what_is_found_below_a_root(spark, folder):
    for name in ("a b/x=1.parquet", "a b/y-1.csv", "deep/1/2"):
        write_parquet(spark.range(1), f"{folder}/{name}")
    names = ["a b/x=1.parquet", "a b/x=2.parquet", "a b/y-1.csv", "deep/1", "deep/1/2", "none"]
    found = schemas.found_below(spark, folder, names)
    assert {r.name for r in found.collect()} == {"a b/x=1.parquet", "a b/y-1.csv", "deep/1", "deep/1/2"}
    with pytest.raises(ValueError):
        schemas.found_below(spark, folder, ["a*"])
    assert all(schemas.found_below(spark, folder, none).isEmpty() for none in (["none"], []))


def test_month_whose_files_differ_in_type(spark, folder):
    month = f"{folder}/yellow_tripdata_2024-01.parquet"
    old = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:00:00' AS tpep_pickup_datetime, 4 AS fare_amount, 1 AS passenger_count")
    write_parquet(old, month)
    old.selectExpr("tpep_pickup_datetime", "4.5D AS fare_amount", "1.5D AS passenger_count").write.mode("append").parquet(month)
    got = ingest_months(spark, folder, ["yellow"], dt.date(2024, 1, 1), dt.date(2024, 1, 1), STAMP)
    assert rows(got.select("fare_amount", "passenger_count")) == [(4.0, 1.0), (4.5, 1.5)]


def test_declared_schema_needs_every_path(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.read_parquet_as(spark, struct_of("id int"), f"{folder}/nowhere")


def test_truncated_file_is_skipped_and_reported(spark, folder):
    write_parquet(spark.range(100), folder, files=2)
    good = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(f"{folder}/{good[0]}", "rb") as whole:
        content = whole.read()
    with open(f"{folder}/a.parquet", "wb") as first:
        first.write(b"never was one")
    with open(f"{folder}/cut.parquet", "wb") as cut:
        cut.write(content[: len(content) // 2])
    got, report = files.read_tolerant(spark, folder, struct_of("id bigint"))
    assert got.count() == 100
    own_types, _ = files.read_tolerant(spark, folder)
    assert own_types.schema == got.schema and own_types.count() == 100
    read = {r.path.rsplit("/", 1)[1]: r.rows_read for r in report.collect()}
    assert read["cut.parquet"] == 0 and sorted(read) == sorted([*good, "a.parquet", "cut.parquet"]) and sum(read.values()) == 100


def test_file_of_a_narrower_type_shows_in_the_report(spark, folder):
    """Asked for int, a bigint file gives no rows; the report is what tells."""
    write_parquet(spark.range(5), folder, files=1)
    got, report = files.read_tolerant(spark, folder, struct_of("id int"))
    assert got.count() in (0, 5) and [r.rows_read for r in report.collect()] == [0]


def test_tree_leaves_other_names_and_directory_columns_out(spark, folder):
    write_parquet(spark.range(3).withColumn("yyyy", F.lit(2024)), f"{folder}/green", partition_by=["yyyy"])
    put(f"{folder}/green", "readme.txt", "x")
    assert files.read_parquet_tree(spark, folder).columns == ["id"]


def test_month_spine_crosses_years(spark):
    got = month_spine(spark, dt.date(2023, 11, 30), dt.date(2024, 2, 1))
    assert rows(got) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert rows(month_spine(spark, dt.date(2024, 2, 29), dt.date(2024, 2, 1))) == [(2024, 2)]
    assert month_spine(spark, dt.date(2024, 2, 1), dt.date(2024, 1, 1)).isEmpty()


STAMP = dt.datetime(2024, 5, 1, 12)


def land(spark, folder):
    """Yellow: January and, with other types, February as Parquet. Green: January as CSV only."""
    january = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-02 03:00:00' AS tpep_pickup_datetime, TIMESTAMP_NTZ '2024-01-02 04:00:00' AS "
        "tpep_dropoff_datetime, 10 AS PULocationID, 20 AS DOLocationID, 5.5D AS fare_amount, 7D AS total_amount, "
        "1 AS payment_type"
    )
    write_parquet(january, f"{folder}/yellow_tripdata_2024-01.parquet")
    february = january.withColumn("PULocationID", F.lit(11).cast("bigint")).drop("fare_amount")
    write_parquet(february, f"{folder}/yellow_tripdata_2024-02.parquet")
    put(folder, "green_tripdata_2024-01.csv",
        "lpep_pickup_datetime,lpep_dropoff_datetime,PULocationID,DOLocationID,fare_amount,payment_type\n"
        "2024-01-05 00:00:00,bad,30,40,9.25,2\n")


def test_months_are_ingested_from_what_has_landed(spark, folder, caplog):
    land(spark, folder)
    got = ingest_months(spark, folder, ["yellow", "green"], dt.date(2024, 1, 31), dt.date(2024, 2, 1), STAMP)
    pickup, dropoff = dt.datetime(2024, 1, 2, 3), dt.datetime(2024, 1, 2, 4)
    assert rows(got) == sorted([
        (pickup, dropoff, 10, 20, 5.5, 1, "yellow", 7.0, [], STAMP),
        (pickup, dropoff, 11, 20, 7.0, 1, "yellow", None, [], STAMP),
        (dt.datetime(2024, 1, 5), None, 30, 40, 9.25, 2, "green", None, ["dropoff_datetime"], STAMP),
    ], key=repr)
    assert rows(refused_cells(got)) == [("dropoff_datetime", 1)]
    assert "green_tripdata_2024-02" in caplog.text and "total_amount stands in" in caplog.text


def test_unreadable_parquet_falls_back_to_csv(spark, folder):
    put(folder, "green_tripdata_2024-01.parquet", "this is no parquet file at all")
    put(folder, "green_tripdata_2024-01.csv", "lpep_pickup_datetime,fare\n2024-01-05 00:00:00,9.25\n")
    got = ingest_months(spark, folder, ["green"], dt.date(2024, 1, 1), dt.date(2024, 1, 1), STAMP)
    assert [(r.pickup_datetime, r.fare_amount) for r in got.collect()] == [(dt.datetime(2024, 1, 5), 9.25)]


def test_nothing_landed_gives_the_declared_columns(spark, folder):
    got = ingest_months(spark, folder, ["yellow"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), STAMP)
    assert got.isEmpty() and got.columns == [*TRIP_SCHEMA.names, "taxi_type", "refused", "extracted_at"]


def test_month_with_files_of_different_columns_keeps_them_all(spark, folder):
    month = f"{folder}/yellow_tripdata_2024-01.parquet"
    old = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:00:00' AS tpep_pickup_datetime, 4.0D AS fare_amount")
    write_parquet(old, month)
    new = old.withColumns({"payment_type": F.lit(2), "Airport_fee": F.lit(1.25), "trip_distance": F.lit(3)})
    new.write.mode("append").parquet(month)
    put(folder, "yellow_tripdata_2024-02.csv",
        "tpep_pickup_datetime,fare_amount,PULocationID,payment_type,passenger_count,trip_distance,airport_fee\n"
        "2024-02-02 00:00:00,5,7.0,1.0,2.0,2.0,1.75\n2024-02-03 00:00:00,6,7.5,,,x,\n")
    got = ingest_months(spark, folder, ["yellow"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), STAMP)
    seen = got.select("fare_amount", "pickup_location_id", "payment_type", "trip_distance", "Airport_fee", "passenger_count", "refused")
    assert rows(seen) == sorted([
        (4.0, None, None, None, None, None, []),
        (4.0, None, 2, 3, 1.25, None, []),
        (5.0, 7, 1, 2, 1.75, "2.0", []),
        (6.0, None, None, None, None, None, ["pickup_location_id", "trip_distance"]),
    ], key=repr)


def test_seed_is_checked(spark, folder):
    good = put(folder, "good.csv", "payment_type_id,payment_type_name\n0,flexible\n1,card\n")
    assert rows(load_seed(spark, good, PAYMENT_LOOKUP)) == [(0, "flexible"), (1, "card")]
    twice = put(folder, "twice.csv", "payment_type_id,payment_type_name\n1,card\n1,cash\n")
    with pytest.raises(ChecksFailed, match="unique"):
        load_seed(spark, twice, PAYMENT_LOOKUP)
    unnamed = put(folder, "unnamed.csv", "payment_type_id,payment_type_name\n1,\n")
    with pytest.raises(ChecksFailed, match="payment_type_name: not_null"):
        load_seed(spark, unnamed, PAYMENT_LOOKUP)


RECORD = struct_of("id int, name string")


def test_records_of_both_page_shapes(spark):
    pages = spark.createDataFrame(
        [(1, '[{"id": 1, "name": "a"}, {"id": 2}]', '{"docs": [{"id": 7}], "numFound": 1}'), (2, "[]", "{}")],
        "page int, body string, wrapped string",
    )
    assert rows(select_records(pages, "$", RECORD)) == [(1, 0, 1, "a"), (1, 1, 2, None)]
    assert rows(select_records(pages, "docs", RECORD, body="wrapped")) == [(1, 0, 7, None)]


def test_broken_page_fails(spark):
    pages = spark.createDataFrame([(1, '[{"id": 1}]'), (2, '[{"id": '), (3, '[{"id": 3}]')], "page int, body string")
    for read in (lambda: select_records(pages, "$", RECORD), lambda: pages_until_empty(pages, "$")):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            read().collect()


def test_good_and_refused_records_from_one_pass(spark, folder):
    pages = spark.createDataFrame(
        [
            (1, '[{"id": 1, "name": "a"}, {"id": 2}]'), (2, '[{"id": "x", "name": "b"}, {"id": 1.50, "name": "c"}, {"id": 4}, null]'),
            (3, '[{"id": 3'), (4, '{"id": 5}'), (5, None), (6, "[]"), (7, '[7, "{\\"id\\": 8}", {"id": 9, "more": {"q": [1]}}]'), (8, ""),
            (9, '[null, {"id": 10}]'),
        ],
        "page int, body string",
    )
    got = split_records(pages, "$", RECORD)
    assert got.columns == ["page", "position", "id", "name", REFUSED]
    assert rows(good(got)) == rows(spark.createDataFrame(
        [(1, 0, 1, "a"), (1, 1, 2, None), (2, 2, 4, None), (2, 3, None, None), (7, 1, 8, None), (7, 2, 9, None), (9, 0, None, None), (9, 1, 10, None)],
        "a int, b int, c int, d string",
    ))
    bad = {(r.page, r.position): (r.name, r[REFUSED]) for r in refused(got).collect()}
    assert bad == {
        (2, 0): ("b", '{"id":"x","name":"b"}'), (2, 1): ("c", '{"id":1.5,"name":"c"}'), (3, None): (None, '[{"id": 3'),
        (4, None): (None, '{"id": 5}'), (7, 0): (None, "7"), (8, None): (None, ""),
    }
    assert write_split(got, folder) == {"rows": 14, "refused": 6}
    assert spark.read.parquet(folder).where("kind = 'refused'").count() == 6
    wrapped = pages.select("page", F.concat(F.lit('{"n": 1, "docs": '), "body", F.lit("}")).alias("body"))
    assert rows(good(split_records(wrapped, "docs", RECORD))) == rows(good(got))
    assert split_records(pages.limit(0), "$", RECORD).isEmpty()
    assert [r.page for r in pages_until_empty(pages, "$", tolerant=True).orderBy("page").collect()] == [1, 2, 3, 4]


def test_refused_lines_of_csv(spark, folder):
    path = put(folder, "t.csv", "id,x\n1,2.5\ntwo,3.5\n3\n4,5.5,6\n5,\n")
    got = files.read_csv(spark, path, struct_of("id int, x double"), refused=REFUSED)
    assert rows(good(got)) == [(1, 2.5), (5, None)]
    assert rows(refused(got).select("id", REFUSED)) == rows(
        spark.createDataFrame([(None, "two,3.5"), (3, "3"), (4, "4,5.5,6")], "id int, t string")
    )
    assert refused(got).select("x").count() == 3


def test_pages_stop_at_the_first_empty_one(spark):
    bodies = {3: '[{"id": 3}]', 1: '[{"id": 1}]', 2: "[]", 4: None}
    pages = spark.createDataFrame(list(bodies.items()), "page int, body string")
    assert [r.page for r in pages_until_empty(pages, "$").collect()] == [1]
    assert pages_until_empty(pages.where("page in (1, 3)"), "$").count() == 2


def test_relational_target_options():
    got = jdbc_options("jdbc:x", "t", "overwrite", connections=4, driver="d")
    assert got == {"url": "jdbc:x", "dbtable": "t", "batchsize": "100000", "numPartitions": "4", "truncate": "true",
                   "driver": "d"}
