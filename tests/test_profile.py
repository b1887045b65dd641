import math
import random

import numpy as np
import pytest

from starloom.operators.checks import row_count_check
from starloom.operators.profile import (
    column_catalogue,
    null_profile,
    numeric_summary,
    table_shape,
    table_shapes,
)
from tests.conftest import values


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "a", 1), (None, "a", 2), (3, None, 3)], "x int, y string, z int")


def test_profiles(small):
    assert sorted(values(null_profile(small))) == [("x", 1), ("y", 1)]
    assert sorted(values(column_catalogue(small))) == [("x", 0, "int", 2), ("y", 1, "string", 2), ("z", 2, "int", 3)]
    assert values(table_shape(small)) == [(3, 3)]
    assert sorted(values(table_shapes({"a": small, "b": small.where("x > 9").select("x")}))) == [("a", 3, 3), ("b", 0, 1)]


def test_summary_of_small_columns(spark, small):
    assert sorted(values(numeric_summary(small))) == [
        ("x", 2, 2.0, math.sqrt(2), 1.0, 1.5, 2.0, 2.5, 3.0),
        ("z", 3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0),
    ]
    empty = spark.createDataFrame([(float("nan"), None), (None, None)], "w double, v int")
    assert sorted(values(numeric_summary(empty))) == [("v", 0) + (None,) * 7, ("w", 0) + (None,) * 7]
    one = spark.createDataFrame([(5.0, None)], "w double, v int")
    assert sorted(values(numeric_summary(one)))[1][:2] == ("w", 1)
    assert sorted(values(numeric_summary(one)))[1][4:] == (5.0,) * 5


@pytest.mark.parametrize("accuracy", [10, 60, 10_000])
def test_quartiles_are_exact(spark, accuracy):
    """However coarse the sketch that narrows the search."""
    draw = random.Random(accuracy)
    rows = [(draw.gauss(0, 1e6), draw.choice([1, 1, 1, 2, 9]), draw.randrange(10**6)) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a double, b int, c long").repartition(5)
    for name, *measures in values(numeric_summary(df, accuracy=accuracy)):
        column = np.array([row["abc".index(name)] for row in rows], dtype=float)
        expected = [
            len(column),
            column.mean(),
            column.std(ddof=1),
            column.min(),
            *np.percentile(column, [25, 50, 75]),
            column.max(),
        ]
        assert measures == pytest.approx(expected, rel=1e-9)


def test_row_count_check(small):
    none = small.where("z > 9")
    checked = row_count_check({"full": (small, 0), "empty": (none, 0), "exact": (small, 3)})
    assert sorted(values(checked)) == [("empty", 0, 0, "failed"), ("exact", 3, 3, "failed"), ("full", 3, 0, "ok")]
