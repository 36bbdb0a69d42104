import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterline.session import build_session, scratch_database, workspace  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return workspace(spark, "test")


@pytest.fixture
def base(spark):
    return scratch_database(spark, "test")


@pytest.fixture(scope="session")
def small(spark):
    from querybook.feeds import Tables

    return Tables(spark, SMALL)


def plan_of(df) -> str:
    """Text of the physical plan."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df) -> list[tuple]:
    """Rows in a repeatable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
