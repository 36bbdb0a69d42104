"""Every registered query against its SQL, and the answers that have to agree with each other."""

import pytest

import __spark_entry__ as entry
from querybook import ORACLES, QUERIES
from tests.conftest import SMALL, rows
from tests.oracle import database, differences



@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


def test_entry_registers_them_all():
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLES.keys()


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


PAIRS = [
    ("count_by_service", "count_by_service_sql"),
    ("count_by_date_parts", "count_on_date"),
    ("trip_zone_names", "trip_zone_names_comma"),
    ("distinct_vendor_pruned", "distinct_vendor_unpruned"),
    ("count_rows", "external_table_count"),
    ("base_id_native", "base_id_udf"),
]


@pytest.mark.parametrize("one,other", PAIRS)
def test_same_answer_two_ways(spark, one, other):
    assert rows(QUERIES[one](spark, SMALL)) == rows(QUERIES[other](spark, SMALL))
