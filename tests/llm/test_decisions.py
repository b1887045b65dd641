"""Decisions applied to rows by number."""

import collections

import pytest
from pyspark.sql import functions as F

from starloom.llm.decisions import applied, numbered


@pytest.mark.parametrize("most_rows", [1 << 20, 30])
def test_rows_as_often_as_decided(spark, most_rows):
    docs = spark.range(100).select("id", F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("copies")).repartition(7)
    rows = numbered(spark, docs)
    some = rows.where("id < 80").select("_row", (F.col("id") % 4).cast("int").alias("copies"))
    found = applied(spark, rows, some, most_rows)
    assert found.columns == docs.columns
    got = collections.Counter(tuple(row) for row in found.collect())
    assert got == {(k, f"text {k}", 1): k % 4 for k in range(80) if k % 4}
    plan = found._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan


def test_no_rows_and_no_decisions(spark):
    rows = numbered(spark, spark.range(5))
    none = rows.select("_row", F.lit(1).alias("copies")).limit(0)
    assert applied(spark, rows, none).count() == 0
    empty = numbered(spark, spark.range(0))
    assert applied(spark, empty, none).count() == 0
