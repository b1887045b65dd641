import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import Link, append_missing, missing_members, star_join, without_match
from tests.conftest import UNKNOWN, values


def test_without_match(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, n int")
    held = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(values(without_match(new, held, "k")), key=str) == [("b", 2), ("b", 3), (None, 4)]
    renamed = held.withColumnRenamed("k", "other")
    assert without_match(new, renamed, "k", "other").count() == 3


def test_matched_and_unmatched_make_the_whole(spark):
    new = spark.range(1000).select((F.col("id") % 90).alias("k"), "id")
    held = spark.range(0, 60, 3).select(F.col("id").alias("k"))
    matched = new.join(held, "k", "left_semi")
    assert sorted(values(matched.unionByName(without_match(new, held, "k")))) == sorted(values(new))


def test_append_ports_to_airports(spark):
    airports = spark.createDataFrame(
        [("A1", 7, 1.5, "LOS ANGELES", "CA", "LAX")],
        "ident string, elevation_ft int, latitude double, municipality string, state string, local_code string",
    )
    ports = spark.createDataFrame(
        [("LAX", "LOS ANGELES", "CA"), ("ALC", "ALCAN", "AK"), ("ALC", "ALCAN", "AK"), (None, "X", "Y")],
        "local_code string, municipality string, state string",
    )
    added = missing_members(airports, ports, "local_code")
    assert sorted(values(added), key=str) == [
        (UNKNOWN, -1, -1.0, "ALCAN", "AK", "ALC"),
        (UNKNOWN, -1, -1.0, "ALCAN", "AK", "ALC"),
        (UNKNOWN, -1, -1.0, "X", "Y", None),
    ]
    whole = append_missing(airports, ports, "local_code", null_key="drop", dedupe=["local_code"])
    assert whole.count() == 2
    assert whole.schema == airports.schema
    with pytest.raises(ValueError):
        missing_members(airports, ports, "local_code", null_key="?")


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame(
        [(1.0, "LAX", 10), (2.0, "LAX", 11), (1.0, "SEA", 12), (-1.0, "LAX", 13), (1.5, "LAX", 14), (None, "LAX", 15)],
        "mode double, port string, id int",
    )
    modes = spark.createDataFrame([(1, "AIR"), (2, "SEA")], "code long, mode string")
    ports = spark.createDataFrame([("LAX", 1), ("LAX", 2)], "local_code string, n int")
    return fact, modes, ports


def test_star_join_keeps_matches_and_repeats(star):
    fact, modes, ports = star
    links = [Link(modes, "mode", "code", "md"), Link(ports, "port", "local_code", "prt")]
    joined = star_join(fact, links, {"md": "md", "prt": "prt", "no": "id", "twice": F.col("id") * 2})
    assert sorted(values(joined)) == [(1, "LAX", 10, 20)] * 2 + [(2, "LAX", 11, 22)] * 2
    assert joined.schema["md"].dataType == T.LongType()


def test_star_join_with_unique_dimensions(star):
    fact, modes, ports = star
    links = [Link(modes, "mode", "code", "md"), Link(ports, "port", "local_code", "prt")]
    joined = star_join(fact, links, {"md": "md", "prt": "prt", "no": "id"}, unique_dimensions=True)
    assert sorted(values(joined)) == [(1, "LAX", 10), (2, "LAX", 11)]
    assert joined.schema["md"].dataType == T.LongType()
    one = star_join(fact, [Link(modes, "mode", "code", "md"), Link(ports, "port", "local_code", "prt", unique=True)])
    assert one.columns == ["mode", "port", "id", "md", "prt"]
    assert one.count() == 2


def test_star_join_with_attributes_and_clashing_names(star):
    fact, modes, _ = star
    joined = star_join(
        fact, [Link(modes, "mode", "code", "code", {"label": "mode"})], {"id": "id", "mode": "mode", "label": "label"}
    )
    assert sorted(values(joined)) == [(10, 1.0, "AIR"), (11, 2.0, "SEA"), (12, 1.0, "AIR")]


def test_star_join_of_numbers_with_text(spark):
    fact = spark.createDataFrame([("7", 1), ("x", 2)], "k string, id int")
    held = spark.createDataFrame([(7,)], "k int")
    assert values(star_join(fact, [Link(held, "k", "k", "key")], {"key": "key", "id": "id"})) == [(7, 1)]


def test_same_table_twice(spark):
    people = spark.createDataFrame([(1, 2), (2, 1), (3, 9)], "id int, boss int")
    joined = star_join(people, [Link(people, "boss", "id", "held")], {"id": "id", "boss": "held"})
    assert sorted(values(joined)) == [(1, 2), (2, 1)]
