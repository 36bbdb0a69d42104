"""A third of the rows under one key: the work on it has to be split, and no row lost."""

import contextlib

import pytest
from pyspark.sql import functions as F

from meterline.operators.joins import lookup
from meterline.session import workspace
from meterline.sinks.files import write_parquet
from meterline.sinks.strategies import without_keys
from tests.conftest import plan_of

ROWS = 240_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stored(df, label):
    path = workspace(df.sparkSession, label)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    df = spark.range(0, ROWS, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    return stored(df, "facts")


def final_plan(df):
    """The plan as it ran, after the runtime changed it."""
    return plan_of(df)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_a_hot_key_is_split(spark, facts, how):
    dim = stored(spark.range(ROWS).select(F.col("id").alias("d"), F.lit("n").alias("name")), "dim")
    with settings(spark, SETTINGS):
        got = lookup(facts, dim, {"k": "d"}, how)
        assert len(got.collect()) == ROWS
        assert "skewed" in final_plan(got)


def test_removing_keys_splits_a_hot_one(spark, facts):
    known = stored(spark.range(1, ROWS, 2).select(F.col("id").alias("k")).where("k <> 7").distinct(), "known")
    with settings(spark, SETTINGS):
        got = without_keys(facts, known, ["k"])
        left = len(got.collect())
        assert "skewed" in final_plan(got)
    assert left == facts.where("k % 2 = 0 OR k = 7").count()
