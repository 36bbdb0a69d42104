import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions import (
    base_id,
    base_id_udf,
    fixed_avg,
    fixed_sum,
    hour_start,
    hours_between,
    join_text,
    month_start,
)


def at(*parts):
    return dt.datetime(*parts)


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_ignore_clock_changes(spark, new_york):
    """02:30 does not exist on that day in New York, but it does on a zone-less clock."""
    times = [at(2024, 3, 10, 2, 30), at(2024, 11, 3, 1, 45, 1, 5), at(1969, 12, 31, 23, 59)]
    df = spark.createDataFrame([(x,) for x in times], "ts timestamp_ntz")
    got = df.select("ts", hour_start(F.col("ts")), month_start(F.col("ts"))).collect()
    for ts, hour, month in got:
        assert hour == ts.replace(minute=0, second=0, microsecond=0)
        assert month == dt.datetime(ts.year, ts.month, 1)


def test_duration_ignores_clock_changes_and_fractions(spark, new_york):
    span = (at(2024, 3, 10, 1), at(2024, 3, 10, 4, 30, 0, 999))
    df = spark.createDataFrame([span], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 3.5


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=60), st.integers(1, 5))
def test_fixed_sum_does_not_depend_on_row_order(spark, cents, parts):
    amounts = [c / 100 for c in cents]
    random.shuffle(amounts)
    df = spark.createDataFrame([(x,) for x in amounts], "x double").repartition(parts)
    total, mean = df.agg(fixed_sum(F.col("x")), fixed_avg(F.col("x"))).first()
    assert total == sum(cents) / 100
    assert mean == total / len(cents)


def test_sums_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert tuple(df.agg(fixed_sum(F.col("x")), fixed_avg(F.col("x"))).first()) == (None, None)


def test_text_reads_null_as_empty(spark):
    df = spark.createDataFrame([(None, "b")], "x string, y string")
    assert df.select(join_text(F.col("x"), " / ", F.col("y"))).first()[0] == " / b"


def test_base_labels(spark):
    cases = {"B02884": "s/b44", "B00007": "s/007", "B00003": "a/003", "B00001": "e/001", "B99999": "a/1869f"}
    df = spark.createDataFrame([(k,) for k in [*cases, "Bx", None]], "licence string")
    got = df.select("licence", base_id(F.col("licence")), base_id_udf()(F.col("licence"))).collect()
    for licence, native, python in got:
        assert native == python == cases.get(licence)


def test_both_base_labels_take_digits_only(spark):
    from meterline.functions.base_ids import base_id, base_id_udf

    odd = spark.createDataFrame([("B-7",), ("B+9",), ("B 12",), ("B",), ("",), (None,), ("B" + "9" * 30,), ("B14",)], "b string")
    got = odd.select(base_id(F.col("b")).alias("x"), base_id_udf()(F.col("b")).alias("y")).collect()
    assert [r.x for r in got] == [r.y for r in got] == [None] * 7 + ["s/00e"]


def test_fixed_sum_refuses_what_it_cannot_hold(spark):
    from meterline.functions.measures import fixed_sum

    for amount, n in ((0.004, 10), (1e15, 10)):
        with pytest.raises(Exception, match="decimals|too large"):
            spark.range(n).select(fixed_sum(F.lit(amount))).collect()
