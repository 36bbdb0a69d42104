import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators import filters, joins, ordering, sets, shape
from meterline.operators.aggregates import group_measures, merge_measures, partial_measures
from meterline.plans.revenue import outer_join_hourly, revenue_by_zone
from meterline.plans.rankings import least_busy_zones, top_zone_by_total
from meterline.types import struct_of
from tests.conftest import rows


def test_first_spelling_wins_and_is_reported(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "total double, fare double, pickup int")
    out, chosen = shape.rename_first_present(df, {"fare_amount": ("fare_amount", "fare", "total"), "zone": ("Zone",)})
    assert out.columns == ["total", "fare_amount", "pickup"] and chosen == {"fare_amount": "fare"}


def test_chosen_spelling_replaces_a_column_of_the_target_name(spark):
    df = spark.createDataFrame([(1, 2)], "PULocationID int, pickup_location_id int")
    out, _ = shape.rename_first_present(df, {"pickup_location_id": ("PULocationID", "pickup_location_id")})
    assert rows(out) == [(1,)] and out.columns == ["pickup_location_id"]


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("7", "x"), ("n/a", "y")], "a string, b string")
    assert rows(shape.conform(df, struct_of("a int, c double"))) == [(7, None), (None, None)]


def test_common_columns_keep_the_first_order(spark):
    assert shape.common_columns(["c", "a", "b"], ["b", "x", "c"]) == ["c", "b"]


def test_unreadable_timestamps_become_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,)], "t string")
    got = [r[0] for r in shape.coerce_timestamps(df, ["t"]).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


MOMENTS = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0, 1)]


@pytest.fixture(scope="module")
def moments(spark):
    return spark.createDataFrame([(m, m.date()) for m in MOMENTS] + [(None, None)], "ts timestamp_ntz, day date")


def test_half_open_and_closed_bounds(moments):
    assert filters.half_open(moments, "ts", "2024-01-01", "2024-01-02", "day").count() == 2
    assert filters.closed_range(moments, "ts", "2024-01-01", "2024-01-02", "day").count() == 3
    assert filters.half_open(moments, "day", lo="2024-01-02").count() == 2
    assert filters.half_open(moments, "ts", hi="2024-01-01 12:00:00").count() == 1


def test_day_and_month_day(moments):
    assert filters.on_date(moments, "ts", "2024-01-02").count() == 2
    assert filters.on_month_day(moments, "ts", 1, 1).count() == 2


def test_valid_pairs(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (1, 1), (None, 1), (1, None)], "a int, b int")
    assert rows(filters.valid_pair(df, "a", "b")) == [(1, 1), (1, 2)]


def test_unknown_comparison_is_refused(moments):
    with pytest.raises(ValueError):
        filters.compare(moments, "ts", "like", "x")


def test_left_lookup_keeps_unmatched_and_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "code int, x string")
    dim = spark.createDataFrame([(1, "one"), (None, "none")], "id int, name string")
    assert rows(joins.lookup(facts, dim, {"code": "id"}, "left")) == [
        (1, "a", 1, "one"), (9, "b", None, None), (None, "c", None, None)
    ]


def test_roles_of_one_dimension(spark):
    facts = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    got = joins.lookup_roles(facts, dim, "id", {"from": "a", "to": "b"}, ["name"])
    assert rows(got) == [(1, 2, "x", "y")]


def test_hourly_outer_join_and_zone_names(spark):
    hour = dt.datetime(2024, 1, 1)
    columns = "hour_ts timestamp_ntz, zone int, amount double, number_records bigint"
    green = spark.createDataFrame([(hour, 1, 1.0, 1), (hour, None, 2.0, 1)], columns)
    yellow = spark.createDataFrame([(hour, 1, 5.0, 2), (hour, 2, 6.0, 3), (hour, None, 7.0, 1)], columns)
    joined = outer_join_hourly(green, yellow)
    assert rows(joined.drop("hour_ts")) == rows(spark.createDataFrame(
        [(1, 1.0, 1, 5.0, 2), (2, None, None, 6.0, 3), (None, 2.0, 1, None, None), (None, None, None, 7.0, 1)],
        "a int, b double, c bigint, d double, e bigint",
    ))
    zones = spark.createDataFrame([(1, "North"), (2, "South")], "LocationID int, Zone string")
    named = revenue_by_zone(joined, zones)
    assert "Zone" in named.columns and "zone_id" not in named.columns and named.count() == 2


def test_dedup_treats_null_keys_as_equal_and_follows_the_order(spark):
    df = spark.createDataFrame([(None, 1, "b"), (None, 1, "a"), (1, 1, "z"), (1, None, "y")], "k int, l int, v string")
    assert rows(ordering.dedup(df, ["k", "l"])) == [(1, 1, "z"), (1, None, "y"), (None, 1, "a")]
    last = ordering.dedup(df, ["k", "l"], [F.col("v").desc()])
    assert rows(last) == [(1, 1, "z"), (1, None, "y"), (None, 1, "b")]


def test_dedup_of_one_frequent_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    got = ordering.dedup(df.repartition(8), ["k"])
    assert got.count() == 20_001 and got.where("k = -1").first()["id"] == 0


def test_ties_and_nulls_in_top_k(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (0, "d")], "n int, v string")
    assert [r.v for r in ordering.top_k(df, "n", 2, ["v"]).collect()] == ["a", "b"]
    assert [r.v for r in ordering.top_k(df, "n", 1, ["v"], nulls="first").collect()] == ["c"]
    assert [r.v for r in ordering.bottom_k(df, "n", 2, ["v"]).collect()] == ["d", "a"]


def test_union_by_name_and_position(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n bigint")
    assert rows(sets.unite([a, b])) == [(1, "x"), (2, "y")]
    with pytest.raises(Exception):
        sets.unite([a, b.drop("s")])
    assert rows(sets.unite([a, b.drop("s")], allow_missing=True)) == [(1, "x"), (2, None)]


def test_zones_sharing_a_name_merge(spark):
    day = dt.datetime(2024, 1, 1, 5)
    trips = spark.createDataFrame([(day, 1, 1.0), (day, 2, 1.0), (day, 3, 1.5), (day, 9, 50.0)],
                                  "pickup_datetime timestamp_ntz, PULocationID int, total_amount double")
    zones = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "LocationID int, Zone string")
    assert rows(top_zone_by_total(trips, zones, "2024-01-01")) == [("A", 2.0)]
    assert [tuple(r) for r in least_busy_zones(trips, zones).collect()] == [("B", 1), ("A", 2)]


def test_plain_measures(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.25), (2, None)], "k int, x double")
    got = group_measures(df, ["k"], {"s": "x"}, {"a": "x"}, {"m": "x"}, "n")
    assert rows(got) == [(1, 0.35, 0.175, 0.25, 2), (2, None, None, None, 1)]


def test_merged_states_are_the_measures_of_all_rows(spark):
    df = spark.createDataFrame([(1, 1, 0.1, None), (1, 2, 0.2, 3), (2, 1, None, None), (1, 1, 0.3, 4)], "k int, day int, x double, n int")
    parts = partial_measures(df, ["k", "day"], ["x", "n"], scale=1)
    got = merge_measures(parts, ["k"], {"total": "x"}, {"mean": "n", "mean_x": "x"}, scale=1)
    want = group_measures(df, ["k"], {"total": "x"}, {"mean": "n", "mean_x": "x"}, scale=1)
    assert rows(got) == rows(want) == [(1, 0.6, 3.5, 0.6 / 3), (2, None, None, None)]
    plain = merge_measures(partial_measures(df, ["k", "day"], ["n"]), ["k"], {"total": "n"}, {"mean": "n"})
    assert rows(plain) == [(1, 7, 3.5), (2, None, None)]
    with pytest.raises(Exception, match="more than 0 decimals"):
        partial_measures(df, ["k"], ["x"], scale=0).collect()
