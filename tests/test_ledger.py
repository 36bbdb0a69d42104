"""Windows built again: only days that differ are written, and a ledger is never trusted blindly."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.plans import staging
from meterline.sinks import ledger
from meterline.sinks import strategies as act
from meterline.sinks.files import write_parquet
from meterline.sinks.tables import append_rows, fit_table, replace_table
from meterline.spec import Column, TableSpec
from tests.conftest import rows
from tests.test_trip_tables import FEB, JAN, MAR, build, landed  # noqa: F401

LO, HI = dt.date(2024, 1, 1), dt.date(2024, 1, 11)


def hours(spark, n=240, value="id"):
    at = F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("at")
    return spark.range(n).select(at, F.expr(f"cast({value} as bigint)").alias("v"))


def run(spark, base, source, lo=LO, hi=HI):
    return act.time_interval(spark, f"{base}.t", source, "at", lo, hi, only_changes=True)


def files(spark, base):
    return ledger.day_files(spark, f"{base}.t", act.DAY, LO, HI)


def changed(before, after):
    return sorted(str(d) for d in before.keys() | after.keys() if before.get(d) != after.get(d))


def test_only_days_that_differ_are_written(spark, base):
    run(spark, base, hours(spark))
    first = files(spark, base)
    assert len(first) == 10
    run(spark, base, hours(spark).orderBy(F.desc("v")))
    assert changed(first, files(spark, base)) == []
    edited = run(spark, base, hours(spark, value="if(id = 30, -1, id)").where("v NOT BETWEEN 72 AND 95"))
    second = files(spark, base)
    assert changed(first, second) == ["2024-01-02", "2024-01-04"] and edited.count() == 216
    run(spark, base, hours(spark, value="if(id = 30, -1, id)").where("v NOT BETWEEN 72 AND 95"))
    assert changed(second, files(spark, base)) == []


def test_new_days_join_and_windows_off_midnight_keep_their_neighbours(spark, base):
    run(spark, base, hours(spark, 100), hi=dt.date(2024, 1, 6))
    first = files(spark, base)
    run(spark, base, hours(spark).where("v >= 60 AND v < 130"), "2024-01-03 12:00:00", "2024-01-06 10:00:00")
    assert changed(first, files(spark, base)) == ["2024-01-05", "2024-01-06"]
    assert rows(spark.table(f"{base}.t").select("v")) == rows(spark.range(130))


def test_days_written_by_others_are_not_trusted(spark, base):
    run(spark, base, hours(spark))
    append_rows(hours(spark, 1).withColumn(act.DAY, F.to_date("at")), f"{base}.t")
    assert spark.table(f"{base}.t").count() == 241
    got = run(spark, base, hours(spark))
    assert rows(got.select("v")) == rows(spark.range(240))
    spark.sql(f"DROP TABLE {base}.t{ledger.LEDGER}")
    before = files(spark, base)
    assert run(spark, base, hours(spark)).count() == 240 and len(changed(before, files(spark, base))) == 10


def test_all_days_may_go(spark, base):
    run(spark, base, hours(spark))
    assert run(spark, base, hours(spark).limit(0)).isEmpty() and ledger.stored_days(spark, f"{base}.t", act.DAY) == []
    assert ledger.known(spark, f"{base}.t") == {}


def test_digests_tell_nulls_order_and_repeats(spark):
    def digest(*data):
        return spark.createDataFrame(data, "a int, b int").agg(*ledger.content_digest(spark.createDataFrame([], "a int, b int"))).first()[1]

    assert digest((1, 2), (3, 4)) == digest((3, 4), (1, 2))
    different = [digest((1, None)), digest((None, 1)), digest((1, None), (1, None)), digest((1, None), (None, 1)), digest()]
    assert len(set(different)) == 5


def test_a_run_over_the_same_files_writes_nothing(spark, landed):  # noqa: F811
    def state():
        return [ledger.day_files(spark, n, d, JAN, MAR) for n, d in (("staging.trips", act.DAY), ("reports.trips_report", "trip_date"))]

    build(spark, landed, (JAN, MAR), skip_ingested=True)
    first, report = state(), rows(spark.table("reports.trips_report"))
    assert spark.table("ingestion.trips").count() == 160
    again = build(spark, landed, (JAN, MAR), skip_ingested=True)
    assert rows(again) == report and state() == first and spark.table("ingestion.trips").count() == 160

    late = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-02-10 05:30:00' AS tpep_pickup_datetime, TIMESTAMP_NTZ '2024-02-20' AS tpep_dropoff_datetime, "
        "1 AS PULocationID, 2 AS DOLocationID, 9.5D AS fare_amount, 1 AS payment_type, 7 AS passenger_count"
    )
    late.write.mode("append").parquet(f"{landed}/yellow_tripdata_2024-02.parquet")
    got = build(spark, landed, (JAN, MAR), skip_ingested=True)
    assert [changed(a, b) for a, b in zip(first, state(), strict=True)] == [["2024-02-10"], ["2024-02-10"]]
    assert got.agg(F.sum("trip_count")).first()[0] == 81 and spark.table("ingestion.trips").count() == 160 + 81
    assert rows(spark.table("ingestion.trips").where("passenger_count = 7").select("fare_amount")) == [(9.5,)]
    assert build(spark, landed, (JAN, FEB), skip_ingested=True, full_refresh=True).agg(F.sum("trip_count")).first()[0] == 40


def test_ingested_trips_keep_columns_that_come_later(spark, base, folder):
    spec = TableSpec(f"{base}.t", [Column("at", "timestamp_ntz"), Column("n", "int")], "append", "at", more=True)
    at = F.lit("2024-01-05 03:00:00").cast("timestamp_ntz").alias("at")
    act.materialise(spark, spec, spark.range(1).select(at, F.lit("1").alias("n"), F.lit(1).cast("bigint").alias("fee")))
    act.materialise(spark, spec, spark.range(1).select(at, F.lit(2).alias("n"), F.lit(2).alias("Fee"), F.lit("x").alias("note")))
    got = act.materialise(spark, spec, spark.range(1).select(at, F.lit(3).alias("n")))
    assert rows(got.select("n", "fee", "note")) == [(1, 1, None), (2, 2, "x"), (3, None, None)]
    with pytest.raises(ValueError, match="fee: double"):
        act.materialise(spark, spec, spark.range(1).select(at, F.lit(3).alias("n"), F.lit(0.5).alias("fee")))
    replace_table(spark.range(1).withColumn("p", F.lit(1)), f"{base}.u", ["p"])
    assert fit_table(spark.range(1).withColumn("p", F.lit(2)), f"{base}.u").columns == ["id", "p"]


@pytest.mark.parametrize("odd", [{"strategy": "append", "only_changes": True}, {"strategy": "time_interval", "incremental_key": "at", "more": True}])
def test_declarations_that_do_not_fit(odd):
    with pytest.raises(ValueError):
        TableSpec("t", [Column("at", "timestamp_ntz")], **odd)
