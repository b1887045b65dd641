import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom.session import build_session  # noqa: E402

UNKNOWN = "TO BE DETERMINATED"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**entries):
        for name, value in entries.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def values(df):
    return [tuple(row) for row in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def final_plan_of(df):
    """The plan after adaptive execution has run it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
