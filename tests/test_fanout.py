import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.aggregates import fanout_count, fanout_topk
from tests.conftest import values


def test_small_example(spark):
    fact = spark.createDataFrame([("CA",)] * 3 + [("NY",), (None,)], "addr string")
    cities = spark.createDataFrame(
        [("CA", "LA", "WHITE"), ("CA", "LA", "ASIAN"), ("NY", "NYC", "WHITE"), (None, "X", "WHITE")],
        "state_code string, city string, race string",
    )
    found = fanout_topk(fact, cities, "addr", "state_code", ("city", "race"), counted="race")
    assert values(found) == [("LA", "ASIAN", 3), ("LA", "WHITE", 3), ("NYC", "WHITE", 1)]
    assert values(fanout_topk(fact, cities, "addr", "state_code", ("city", "race"), "race", k=1)) == [("LA", "ASIAN", 3)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_join_of_all_pairs(spark, seed):
    draw = random.Random(seed)
    keys = ["hot"] * 5 + list("abcde") + [None]
    fact = spark.createDataFrame([(draw.choice(keys),) for _ in range(300)], "k string")
    groups = [None, "x", "y"]
    dimension = spark.createDataFrame(
        [(draw.choice(keys), draw.choice(groups), draw.choice(groups)) for _ in range(80)], "d string, g string, h string"
    )
    pairs = (
        fact.join(dimension, F.col("k") == F.col("d")).groupBy("g", "h").agg(F.count("h").alias("n")).orderBy("g", "h")
    )
    found = fanout_count(fact, dimension, "k", "d", ("g", "h"), counted="h").orderBy("g", "h")
    assert values(found) == values(pairs)
