"""Profiles and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.checks import row_count_check as check_row_counts
from starloom.operators.joins import without_match
from starloom.operators.profile import column_catalogue as catalogue
from starloom.operators.profile import null_profile as nulls_of
from starloom.operators.profile import numeric_summary as summary_of
from starloom.operators.profile import table_shapes
from starloom.queries.registry import TABLES, query, table
from starloom.queries.rows import null_where


@query(
    """
    SELECT * FROM (
        SELECT 'o_custkey' AS column_name, count_if(nullif(o_custkey, 7) IS NULL) AS nulls FROM orders
        UNION ALL SELECT 'o_orderstatus', count_if(nullif(o_orderstatus, 'P') IS NULL) FROM orders
        UNION ALL SELECT 'o_orderpriority', count_if(nullif(o_orderpriority, '5-LOW') IS NULL) FROM orders
        UNION ALL SELECT 'o_totalprice', count_if(o_totalprice IS NULL) FROM orders)
    WHERE nulls > 0
    """
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nulls_of(
        table(spark, sf_dir, "orders").select(
            null_where("o_custkey", 7).alias("o_custkey"),
            null_where("o_orderstatus", "P").alias("o_orderstatus"),
            null_where("o_orderpriority", "5-LOW").alias("o_orderpriority"),
            "o_totalprice",
        )
    )


@query(
    """
    SELECT 'o_orderkey' AS column_name, 0 AS position, 'bigint' AS data_type, count(o_orderkey) AS non_nulls FROM orders
    UNION ALL SELECT 'o_orderstatus', 1, 'string', count(nullif(o_orderstatus, 'P')) FROM orders
    UNION ALL SELECT 'o_totalprice', 2, 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 3, 'timestamp_ntz', count(o_orderdate) FROM orders
    """
)
def column_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", null_where("o_orderstatus", "P").alias("o_orderstatus"), "o_totalprice", "o_orderdate"
        )
    )


SUMMARISED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, count({name}) AS n, round(avg({name}), 6) AS mean,
               round(stddev_samp({name}), 6) AS std, min({name}) AS min, round(quantile_cont({name}, 0.25), 6) AS p25,
               round(quantile_cont({name}, 0.5), 6) AS p50, round(quantile_cont({name}, 0.75), 6) AS p75,
               max({name}) AS max
        FROM lineitem
        """
        for name in SUMMARISED
    )
)
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summary_of(table(spark, sf_dir, "lineitem"), SUMMARISED)
    rounded = ("mean", "std", "p25", "p50", "p75")
    return summary.select(
        *(F.round(name, 6).alias(name) if name in rounded else F.col(name) for name in summary.columns)
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS n_rows,"
        f" (SELECT count(*) FROM pragma_table_info('{name}')) AS n_columns"
        for name in TABLES
    )
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_shapes({name: table(spark, sf_dir, name) for name in TABLES})


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS n_rows, CAST(0 AS BIGINT) AS metric, 'ok' AS status"
        for name in TABLES
    )
    + """
    UNION ALL SELECT 'orders_without_customer', count(*), 0, CASE count(*) WHEN 0 THEN 'failed' ELSE 'ok' END
    FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
    """
)
def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    orphans = without_match(tables["orders"], tables["customer"], "o_custkey", "c_custkey")
    checked = {name: (df, 0) for name, df in tables.items()}
    return check_row_counts(checked | {"orders_without_customer": (orphans, 0)})
