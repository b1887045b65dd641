import pytest
from pyspark.sql import functions as F

from starloom.operators.aggregates import fanout_count
from starloom.operators.joins import Link, star_join, without_match
from starloom.sources import read_label_list, read_parquet, write_table
from starloom.sources.readers import rejected_labels
from tests.conftest import UNKNOWN, values

PAIRS = [
    ("582.0D", "'582'", 1),
    ("'007'", "7", 1),
    ("'x'", "7", 0),
    ("DATE '2020-01-01'", "TIMESTAMP '2020-01-01 00:00:00'", 1),
    ("9007199254740993L", "CAST(9007199254740992 AS DECIMAL(20,0))", 0),
    ("CAST('9007199254740567.01' AS DECIMAL(20,2))", "CAST('9007199254740567.0' AS DECIMAL(20,1))", 0),
]


@pytest.mark.parametrize(("one", "other", "matches"), PAIRS)
def test_keys_of_unlike_types(spark, one, other, matches):
    fact = spark.range(1).select(F.expr(one).alias("k"))
    held = spark.range(1).select(F.expr(other).alias("d"), F.lit("g").alias("g"))
    for unique in (False, True):
        joined = star_join(fact, [Link(held, "k", "d", "key")], {"key": "key"}, unique)
        assert joined.schema["key"].dataType == held.schema["d"].dataType
        assert values(joined) == (values(held.select("d")) if matches else [])
    assert without_match(fact, held, "k", "d").count() == 1 - matches
    assert len(values(fanout_count(fact, held, "k", "d", ["g"], "g"))) == matches


def test_keys_that_do_not_compare(spark):
    dates, numbers = spark.sql("SELECT current_date() AS k"), spark.sql("SELECT 1 AS k")
    with pytest.raises(TypeError):
        without_match(dates, numbers, "k")


def test_labels_keep_what_follows_the_first_separator(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Code = Label\n 1 = 'A=B C'\n x = 'D'\n 2 =\n 3\n")
    path = str(tmp_path / "t.csv")
    found = read_label_list(spark, path, {"Code": "long"})
    assert values(found) == [(1, "'A=B C'"), (None, "'D'"), (2, None), (3, None)]
    assert values(rejected_labels(spark, path, {"Code": "long"})) == [("x", "'D'")]


def test_empty_partition_values(spark, tmp_path):
    table = spark.createDataFrame([("", 1), (None, 2), ("a", 3)], "code string, n int")
    write_table(table, str(tmp_path / "t"), ["code"])
    found = read_parquet(spark, str(tmp_path / "t"), table.schema)
    assert sorted(values(found), key=str) == [(UNKNOWN, 1), ("a", 3), (None, 2)]
