"""Scans and sinks. Each writes to a new folder of the shared scratch location and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import LABEL_TEXT
from starloom.operators.columns import standardise_strings
from starloom.queries.registry import query, sql_label_text, table
from starloom.session import scratch_path
from starloom.sources import (
    append_table,
    read_delimited,
    read_delimited_inferred,
    read_format,
    read_label_list,
    read_parquet,
    write_table,
)


def write_delimited(df: DataFrame, path: str, separator: str = ",", **options: object) -> str:
    df.write.option("sep", separator).option("header", True).options(**options).csv(path)
    return path


def write_label_list(df: DataFrame, path: str, code_header: str, label_header: str) -> str:
    """Write ``code, label`` as padded lines under a padded header, like the lists to be read."""
    lines = df.select(
        F.concat(F.lit("   "), F.col("code").cast("string"), F.lit("\t")).alias(f"   {code_header} "),
        F.concat(F.lit("\t'"), F.col("label"), F.lit("' ")).alias(f" '{label_header}'"),
    )
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return write_delimited(lines, path, "=", **kept)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_format(spark, f"{sf_dir}/events.parquet", "parquet", {"mergeSchema": "false"})
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name, CASE WHEN c_nationkey % 5 > 0 THEN c_acctbal END AS c_acctbal FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_nationkey") % 5 > 0, F.col("c_acctbal").cast("string")).otherwise("not a number")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", balance.alias("balance"))
    path = write_delimited(customers, scratch_path(spark, "delimited"), ";")
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    return read_delimited(spark, path, schema, ";")


@query("SELECT p_partkey, p_name || ' é' AS place, p_retailprice FROM part")
def inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" é")).alias("place"), "p_retailprice"
    )
    path = write_delimited(parts, scratch_path(spark, "inferred"), "|", encoding="ISO-8859-1")
    scanned = read_delimited_inferred(spark, path, "|")
    return scanned.select(F.col("p_partkey").cast("long"), "place", "p_retailprice")


@query(
    f"""
    SELECT o_orderkey AS code, {sql_label_text("o_orderpriority || ' No. ' || CAST(o_custkey AS VARCHAR)")} AS priority
    FROM orders
    """
)
def label_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("code"),
        F.concat("o_orderpriority", F.lit(" No. "), F.col("o_custkey").cast("string")).alias("label"),
    )
    path = write_label_list(labels, scratch_path(spark, "labels"), "Code", "Priority")
    return standardise_strings(read_label_list(spark, path, {"code": "long"}, lower_headers=True), LABEL_TEXT)


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    path = scratch_path(spark, "overwritten")
    write_table(parts.select("p_partkey"), path)
    write_table(parts.select("p_partkey", "p_brand", "p_retailprice"), path)
    return read_parquet(spark, path)


@query(
    """
    SELECT CAST(year(l_shipdate) AS INT) AS ship_year, l_returnflag, count(*) AS n,
           CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1, 2
    """
)
def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    path = scratch_path(spark, "partitioned")
    write_table(lineitem, path, ["ship_year", "l_returnflag"], sort_by=["l_shipdate"])
    return (
        read_parquet(spark, path, lineitem.schema)
        .groupBy("ship_year", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))
    )


@query(
    """
    SELECT o_orderkey, CAST(o_custkey AS INT) AS customer, lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') AS code
    FROM orders
    """
)
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("customer", T.IntegerType()),
            T.StructField("code", T.StringType()),
        ]
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer"),
        F.lpad((F.col("o_custkey") % 25).cast("string"), 3, "0").alias("code"),
        "o_orderstatus",
    )
    path = scratch_path(spark, "appended")
    finished = F.col("o_orderstatus") == "F"
    append_table(orders.where(finished), path, schema, ["code"])
    # The key is a long here and an int in the table; the codes are digits with leading zeros.
    append_table(orders.where(~finished), path, schema, ["code"])
    return read_parquet(spark, path, schema)
