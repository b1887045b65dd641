import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from starloom.operators import aggregates, columns, duplicates, filters
from tests.conftest import UNKNOWN, values


def test_filters(spark):
    df = spark.createDataFrame([("us", "a", 1), ("US", None, 2), ("CA", "b", 3), (None, "c", 4)], "c string, k string, n int")
    assert values(filters.keep_equal_ignoring_case(df, "c", "Us").select("n")) == [(1,), (2,)]
    assert values(filters.keep_not_null(df, "c", "k").select("n")) == [(1,), (3,)]
    assert values(filters.drop_incomplete(df).select("n")) == [(1,), (3,)]
    assert values(filters.drop_incomplete(df, ["k"]).select("n")) == [(1,), (3,), (4,)]
    assert filters.drop_incomplete(df, []).count() == 4


def test_sentinels(spark):
    df = spark.createDataFrame(
        [(1.0, None, "a"), (float("nan"), 2, None), (None, 3, "c")], "x double, n int, t string"
    )
    filled = filters.fill_unknown_numbers(filters.fill_unknown_text(df))
    assert values(filled) == [(1.0, -1, "a"), (-1.0, 2, UNKNOWN), (-1.0, 3, "c")]
    assert filled.schema["n"].dataType == T.IntegerType()
    assert values(filters.fill_unknown_text(df, "?", ["t"]).select("t")) == [("a",), ("?",), ("c",)]


def test_projections(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, t string, `x.y` double")
    assert columns.project(df, {"b": "x.y", "c": F.col("i") + 1, "a": "t"}).collect()[0].asDict() == {
        "b": 2.0,
        "c": 2,
        "a": "a",
    }
    assert columns.rename_all(df, ["p", "q", "r"]).columns == ["p", "q", "r"]
    assert columns.reorder_like(df, spark.createDataFrame([], "t string, i int")).columns == ["t", "i"]
    with pytest.raises(AnalysisException):
        columns.project(df, {"b": "absent"}).collect()


def test_conform_adds_typed_defaults(spark):
    target = T.StructType(
        [
            T.StructField("d", T.DateType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("x", T.DoubleType()),
            T.StructField("t", T.StringType()),
            T.StructField("k", T.ShortType()),
        ]
    )
    df = spark.createDataFrame([(5, "extra")], "k long, other string")
    shaped = columns.conform(df, target)
    assert values(shaped) == [(None, -1, -1.0, UNKNOWN, 5)]
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in target]


CITIES = [("CA", "WHITE", "LA", 10), ("CA", "WHITE", "LA", 20), ("CA", "ASIAN", "LA", 5), ("CA", "WHITE", "LA", 30)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_one_row_per_key(spark, partitions):
    df = spark.createDataFrame(CITIES, "state_code string, race string, city string, n int").repartition(partitions)
    kept = duplicates.one_row_per_key(df, ["state_code", "race", "city"])
    assert sorted(values(kept)) == [("CA", "ASIAN", "LA", 5), ("CA", "WHITE", "LA", 10)]
    assert kept.columns == df.columns


def test_one_row_per_key_order_and_nulls(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, None), (1, None, "z"), (1, 0, "y")], "k int, a int, b string")
    assert sorted(values(duplicates.one_row_per_key(df, ["k"])), key=str) == [(1, None, "z"), (None, 1, None)]
    by_b = duplicates.one_row_per_key(df, ["k"], order=["b"])
    assert sorted(values(by_b), key=str) == [(1, 0, "y"), (None, 1, None)]
    assert duplicates.one_row_per_key(df.select("k"), ["k"]).count() == 2


def test_one_row_per_key_has_one_row_for_each(spark):
    df = spark.range(5000).select((F.col("id") % 37).alias("k"), (F.hash("id") % 11).alias("a"), F.col("id").alias("b"))
    kept = duplicates.one_row_per_key(df, ["k"])
    lowest = df.groupBy("k").agg(F.min(F.struct("a", "b")).alias("m")).select("k", "m.a", "m.b")
    assert kept.count() == 37
    assert sorted(values(kept)) == sorted(values(lowest))
    assert sorted(values(kept)) == sorted(values(duplicates.one_row_per_key(df.repartition(5, "a"), ["k"])))


def test_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 2)], "t string, n int")
    assert duplicates.distinct_rows(df).count() == 3
    assert sorted(values(duplicates.distinct_values(df, "t")), key=str) == [("a",), (None,)]


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "t string, n int")
    assert values(aggregates.row_count(df)) == [(3,)]
    assert sorted(values(aggregates.group_count(df, ["t"])), key=str) == [("a", 2), (None, 1)]
    assert sorted(values(aggregates.group_count(df, ["t"], "n", "k")), key=str) == [("a", 1), (None, 1)]
    counted = aggregates.table_counts({"full": df, "empty": df.where("n > 5")})
    assert sorted(values(counted)) == [("empty", 0), ("full", 3)]


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "t string, n int")
    assert values(aggregates.top_k(df, "n", 3, ["t"])) == [("c", 3), ("a", 2), ("b", 2)]
    assert values(aggregates.first_n(df, 2, ["t"])) == [("a", 2), ("b", 2)]
    assert aggregates.first_n(df, 2).count() == 2
