"""Projections, filters, null handling, duplicates, counts and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.aggregates import first_n as take_first
from starloom.operators.aggregates import group_count as count_groups
from starloom.operators.aggregates import row_count as count_rows
from starloom.operators.aggregates import top_k
from starloom.operators.columns import project, reorder_like
from starloom.operators.duplicates import distinct_rows as take_distinct
from starloom.operators.duplicates import distinct_values as values_of
from starloom.operators.duplicates import one_row_per_key
from starloom.operators.filters import (
    drop_incomplete,
    fill_unknown_numbers,
    fill_unknown_text,
    keep_equal_ignoring_case,
    keep_not_null,
)
from starloom.queries.registry import query, table
from starloom.sources.readers import run_sql


def null_where(column: str, value: object) -> Column:
    """The test tables hold no NULLs, so one value of a column stands for it."""
    return F.nullif(F.col(column), F.lit(value))


@query("SELECT o_totalprice AS amount, o_orderkey AS ordr, o_custkey AS cstmr, o_orderpriority AS prrty FROM orders")
def renaming_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderstatus")
    renamed = project(
        orders, {"ordr": "o_orderkey", "cstmr": "o_custkey", "prrty": "o_orderpriority", "amount": "o_totalprice"}
    )
    target = spark.createDataFrame([], "amount double, ordr long, cstmr long, prrty string")
    return reorder_like(renamed, target)


@query("SELECT c_custkey, c_name FROM customer WHERE upper(c_mktsegment) = 'BUILDING'")
def filter_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return keep_equal_ignoring_case(customers, "c_mktsegment", "Building").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("priority", null_where("o_orderpriority", "5-LOW"))
    return keep_not_null(orders, "priority").select("o_orderkey", "o_custkey")


@query(
    """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END, -1) AS o_totalprice,
           coalesce(nullif(o_orderstatus, 'P'), 'TO BE DETERMINATED') AS o_orderstatus,
           coalesce(nullif(o_custkey, 7), -1) AS o_custkey
    FROM orders
    """
)
def fill_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        # NaN counts as unknown like NULL.
        F.when(F.col("o_orderstatus") == "F", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        null_where("o_orderstatus", "P").alias("o_orderstatus"),
        null_where("o_custkey", 7).alias("o_custkey"),
    )
    return fill_unknown_numbers(fill_unknown_text(orders))


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", null_where("o_orderstatus", "P").alias("o_orderstatus"), "o_orderpriority"
    )
    return drop_incomplete(orders)


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return take_distinct(table(spark, sf_dir, "part").select("p_brand", "p_type"))


@query("SELECT DISTINCT nullif(o_orderstatus, 'P') AS status FROM orders")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(null_where("o_orderstatus", "P").alias("status"))
    return values_of(orders, "status")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                          l_linestatus, l_shipdate) AS place
          FROM lineitem)
    WHERE place = 1
    """
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    dated = lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))
    return one_row_per_key(dated, ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "lineitem"))


@query(
    """
    SELECT o_orderstatus, o_orderpriority, count(nullif(o_custkey, 7)) AS n
    FROM orders GROUP BY o_orderstatus, o_orderpriority
    """
)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("customer", null_where("o_custkey", 7))
    return count_groups(orders, ["o_orderstatus", "o_orderpriority"], counted="customer")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(count_groups(table(spark, sf_dir, "orders"), ["o_custkey"]), "n", 10, ["o_custkey"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 7")
def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return take_first(orders, 7, ["o_totalprice", "o_orderkey"])


SQL_REPORT = """
    SELECT c_mktsegment, o_orderstatus, count(o_orderkey) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment <> {segment}
    GROUP BY c_mktsegment, o_orderstatus
"""


@query(SQL_REPORT.format(segment="'HOUSEHOLD'"))
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    return run_sql(spark, SQL_REPORT.format(segment=":segment"), views, segment="HOUSEHOLD")
