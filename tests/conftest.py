import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ratestrata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """`frame("a int, b string", row, ...)`"""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def settled_plan(df):
    """The plan after it ran, with the joins that run-time sizes led to."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)
