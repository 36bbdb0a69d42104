import pytest

from meterline.operators.checks import ChecksFailed, check_table, enforce, query_check, run_checks
from meterline.spec import Check, Column, QueryCheck, TableSpec
from tests.conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    data = [(1, "a", 1.0), (1, "b", 0.0), (None, "c", -1.0), (None, "c", None)]
    return spark.createDataFrame(data, "k int, name string, x double")


def failed(df):
    return {(r.column_name, r.check_name): (r.failed_rows, r.passed) for r in df.collect()}


def test_rowwise_checks_count_the_breaking_rows(frame):
    checks = [
        Check("not_null", "k"), Check("positive", "x"), Check("non_negative", "x"),
        Check("accepted_values", "name", ("a", "b")), Check("row_count"),
    ]
    assert failed(run_checks(frame, "t", checks)) == {
        ("k", "not_null"): (2, False),
        ("x", "positive"): (2, False),
        ("x", "non_negative"): (1, False),
        ("name", "accepted_values"): (2, False),
        (None, "row_count"): (0, True),
    }


def test_unique_skips_null_and_primary_key_counts_it(frame):
    checks = [Check("unique", "k"), Check("unique", "x"), Check("primary_key", values=("k", "name"))]
    assert failed(run_checks(frame, "t", checks)) == {
        ("k", "unique"): (1, False),
        ("x", "unique"): (0, True),
        ("k,name", "primary_key"): (1, False),
    }


def test_empty_table(frame):
    checks = [Check("row_count"), Check("not_null", "k"), Check("unique", "k")]
    got = failed(run_checks(frame.limit(0), "t", checks))
    assert got == {(None, "row_count"): (1, False), ("k", "not_null"): (0, True), ("k", "unique"): (0, True)}


@pytest.mark.parametrize(
    "query,value,passes",
    [
        ("SELECT count(*) > 1 FROM {table}", 1, True),
        ("SELECT count(*) > 9 FROM {table}", 1, False),
        ("SELECT count(*) FROM {table}", 4, True),
        ("SELECT max(x) FROM {table} WHERE k = 9", 0, False),
        ("SELECT k FROM {table}", 1, False),
        ("SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM {table}", 1, True),
    ],
)
def test_query_checks(frame, query, value, passes):
    result = run_checks(frame, "t", [], [QueryCheck("q", query, value)])
    assert rows(result) == [("t", None, "q", 0 if passes else 1, passes)]


def test_enforce_names_what_failed(spark, frame):
    enforce(query_check(spark.sql("SELECT true"), "t", "holds"))
    with pytest.raises(ChecksFailed, match="t.k: not_null"):
        enforce(run_checks(frame, "t", [Check("not_null", "k")]))


def test_spec_lists_its_checks(frame):
    spec = TableSpec("t", [Column("k", "int", primary_key=True, checks=("not_null",)), Column("name", "string")])
    assert spec.primary_key == ["k"] and spec.schema.names == ["k", "name"]
    assert [r[2] for r in rows(check_table(spec, frame))] == ["not_null", "primary_key"]


@pytest.mark.parametrize("wrong", [{"strategy": "magic"}, {"strategy": "merge"}, {"strategy": "time_interval"},
                                   {"strategy": "table", "granularity": "week"}])
def test_wrong_specs_are_refused(wrong):
    with pytest.raises(ValueError):
        TableSpec("t", [Column("a", "int")], **wrong)
