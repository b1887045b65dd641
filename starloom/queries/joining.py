"""Joins, appends and fan-out counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.aggregates import fanout_topk as top_pairs
from starloom.operators.joins import Link, star_join, without_match
from starloom.operators.joins import append_missing as append_members
from starloom.queries.registry import query, table
from starloom.sources.readers import run_sql


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """
)
def anti_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return without_match(orders, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query(
    """
    SELECT doc_id, quality, toxic FROM labels
    UNION ALL
    SELECT doc_id, -1, -1 FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
    """
)
def append_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return append_members(table(spark, sf_dir, "labels"), documents, "doc_id")


@query(
    """
    SELECT o_orderkey AS ordr, p_partkey AS prt, s_suppkey AS spplr, c_custkey AS cstmr, n_name AS ntn,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordr_dt, l_linenumber AS ln, l_quantity AS qty,
           l_extendedprice AS prc, l_returnflag AS flg
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey
    """
)
def star_join_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Customers and nations hang off the orders: joining them there moves orders, not line items.
    customers = star_join(
        table(spark, sf_dir, "customer"),
        [Link(table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "nation", {"ntn": "n_name"})],
        {"c_custkey": "c_custkey", "ntn": "ntn"},
    )
    orders = star_join(
        table(spark, sf_dir, "orders"),
        [Link(customers, "o_custkey", "c_custkey", "cstmr", {"ntn": "ntn"})],
        {
            "o_orderkey": "o_orderkey",
            "cstmr": "cstmr",
            "ntn": "ntn",
            "ordr_dt": F.col("o_orderdate").cast("date").cast("string"),
        },
    )
    return star_join(
        table(spark, sf_dir, "lineitem"),
        [
            Link(table(spark, sf_dir, "part"), "l_partkey", "p_partkey", "prt"),
            Link(table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", "spplr"),
            Link(
                orders, "l_orderkey", "o_orderkey", "ordr", {"cstmr": "cstmr", "ntn": "ntn", "ordr_dt": "ordr_dt"}
            ),
        ],
        {
            "ordr": "ordr",
            "prt": "prt",
            "spplr": "spplr",
            "cstmr": "cstmr",
            "ntn": "ntn",
            "ordr_dt": "ordr_dt",
            "ln": "l_linenumber",
            "qty": "l_quantity",
            "prc": "l_extendedprice",
            "flg": "l_returnflag",
        },
    )


@query(
    """
    SELECT o_orderkey AS ordr, p_partkey AS prt, l_linenumber AS ln, l_quantity AS qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE p_type = 'ECONOMY'
    """
)
def star_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    economy = table(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")
    return star_join(
        table(spark, sf_dir, "lineitem"),
        # The selective dimension first: what it rules out is not shuffled for the next.
        [
            Link(economy, "l_partkey", "p_partkey", "prt"),
            Link(table(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey", "ordr"),
        ],
        {"ordr": "ordr", "prt": "prt", "ln": "l_linenumber", "qty": "l_quantity"},
        unique_dimensions=True,
    )


# Line items meet every supplier of a nation: a join that fans out, counted per supplier.
FANOUT = """
    SELECT n_name, s_name, count(s_name) AS n
    FROM lineitem JOIN supplier ON l_suppkey % 25 = s_nationkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY n_name, s_name ORDER BY n DESC, n_name, s_name LIMIT 10
"""


@query(FANOUT)
def fanout_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 25).alias("place"))
    suppliers = star_join(
        table(spark, sf_dir, "supplier"),
        [Link(table(spark, sf_dir, "nation"), "s_nationkey", "n_nationkey", "nation", {"n_name": "n_name"})],
        {"nation": "nation", "n_name": "n_name", "s_name": "s_name"},
    )
    return top_pairs(lineitem, suppliers, "place", "nation", ("n_name", "s_name"), counted="s_name", k=10)


@query(FANOUT)
def fanout_topk_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same written as SQL, the line items counted per key before they meet the suppliers."""
    views = {name: table(spark, sf_dir, name) for name in ("lineitem", "supplier", "nation")}
    return run_sql(
        spark,
        """
        WITH items AS (SELECT l_suppkey % 25 AS place, count(*) AS items FROM lineitem GROUP BY l_suppkey % 25),
        places AS (SELECT s_nationkey, s_name, count(s_name) AS names FROM supplier GROUP BY s_nationkey, s_name)
        SELECT n_name, s_name, sum(items * names) AS n
        FROM items JOIN places ON place = s_nationkey JOIN nation ON n_nationkey = s_nationkey
        GROUP BY n_name, s_name ORDER BY n DESC, n_name, s_name LIMIT 10
        """,
        views,
    )
