"""Text, label and date functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import (
    LABEL_TEXT,
    blank_unknowns,
    day_number_to_iso,
    nth_part,
    nth_part_as_double,
    standardise,
)
from starloom.operators.columns import standardise_strings
from starloom.operators.place_labels import split_place_label
from starloom.queries.registry import (
    UNKNOWN,
    query,
    sql_collapsed,
    sql_label_text,
    sql_table_text,
    sql_upper,
    table,
)


@query(
    f"""
    SELECT o_orderkey, {sql_table_text("o_orderstatus")} AS o_orderstatus,
           {sql_table_text("o_orderpriority")} AS o_orderpriority
    FROM orders
    """
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return standardise_strings(orders)


@query(f"SELECT doc_id, {sql_label_text('text')} AS text FROM documents")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", standardise(F.col("text"), LABEL_TEXT).alias("text"))


@query(
    f"""
    SELECT doc_id, {sql_collapsed(sql_upper("prefix || text"))} AS label
    FROM (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN 'Invalid: ' WHEN 1 THEN 'of unknown origin '
                                               WHEN 2 THEN 'no port code, ' ELSE '' END AS prefix
          FROM documents)
    """
)
def collapse_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 4
    prefix = (
        F.when(kind == 0, "Invalid: ").when(kind == 1, "of unknown origin ").when(kind == 2, "no port code, ").otherwise("")
    )
    label = F.upper(F.concat(prefix, F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", blank_unknowns(label).alias("label"))


@query(
    """
    SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[3] AS third_word,
           string_split(p_brand, '#')[2] AS brand_number
    FROM part
    """
)
def split_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        nth_part(F.col("p_name"), " ", 0).alias("first_word"),
        nth_part(F.col("p_name"), " ", 2).alias("third_word"),
        nth_part(F.col("p_brand"), "#", 1).alias("brand_number"),
    )


@query(
    """
    SELECT p_partkey, try_cast(trim(string_split(place, ',')[1]) AS DOUBLE) AS latitude,
           try_cast(trim(string_split(place, ',')[2]) AS DOUBLE) AS longitude,
           try_cast(trim(string_split(place, ',')[3]) AS DOUBLE) AS missing
    FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) || '.25' END
                            || ', -' || CAST(p_partkey AS VARCHAR) || '.5' AS place
          FROM part)
    """
)
def split_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("p_size") % 5 == 0, F.col("p_name")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".25")))
    places = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(first, F.lit(", -"), F.col("p_partkey").cast("string"), F.lit(".5")).alias("place")
    )
    place = F.col("place")
    return places.select(
        "p_partkey",
        nth_part_as_double(place, ",", 0).alias("latitude"),
        nth_part_as_double(place, ",", 1).alias("longitude"),
        nth_part_as_double(place, ",", 2).alias("missing"),
    )


# One label per supplier, in all shapes that the split tells apart.
PLACE_LABELS = """
    SELECT s_suppkey, CASE s_suppkey % 9
        WHEN 0 THEN n_name
        WHEN 1 THEN n_name || ', ' || left(n_name, 2)
        WHEN 2 THEN s_name || ', ' || n_name || ', ' || r_name
        WHEN 3 THEN s_name || ', ' || n_name || ', ' || left(r_name, 2)
        WHEN 4 THEN '  ''' || n_name || '. P''T'', ' || left(n_name, 2) || ' (BPS)  '
        WHEN 5 THEN 'Collapsed into ' || n_name || ', ' || left(n_name, 2)
        WHEN 6 THEN n_name || ', ' || left(n_name, 2) || ', ' || r_name
        WHEN 7 THEN n_name || ', '
        END AS label
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query(
    f"""
    WITH cleaned AS (SELECT s_suppkey, {sql_label_text("replace(label, ',', '|')")} AS label FROM ({PLACE_LABELS})),
    parts AS (SELECT s_suppkey, coalesce(trim(string_split(label, '|')[1]), {UNKNOWN}) AS c,
                     coalesce(trim(string_split(label, '|')[2]), {UNKNOWN}) AS s,
                     coalesce(trim(string_split(label, '|')[3]), {UNKNOWN}) AS o FROM cleaned),
    flagged AS (SELECT *, length(s) > 2 AND NOT contains(s, '(') AND s <> {UNKNOWN} AS in2 FROM parts)
    SELECT s_suppkey,
           CASE WHEN in2 AND o <> {UNKNOWN} AND length(o) > 2 THEN c || ' ' || s || ' ' || o
                WHEN in2 THEN c || ' ' || s ELSE c END AS city,
           CASE WHEN in2 AND o <> {UNKNOWN} AND length(o) > 2 THEN {UNKNOWN} WHEN in2 THEN o ELSE s END AS state
    FROM flagged
    """
)
def place_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, code = F.col("n_name"), F.left(F.col("n_name"), F.lit(2))
    shape = F.col("s_suppkey") % 9
    comma = F.lit(", ")
    label = (
        F.when(shape == 0, name)
        .when(shape == 1, F.concat(name, comma, code))
        .when(shape == 2, F.concat("s_name", comma, name, comma, "r_name"))
        .when(shape == 3, F.concat("s_name", comma, name, comma, F.left(F.col("r_name"), F.lit(2))))
        .when(shape == 4, F.concat(F.lit("  '"), name, F.lit(". P'T', "), code, F.lit(" (BPS)  ")))
        .when(shape == 5, F.concat(F.lit("Collapsed into "), name, comma, code))
        .when(shape == 6, F.concat(name, comma, code, comma, "r_name"))
        .when(shape == 7, F.concat(name, comma))
    )
    labelled = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", label.alias("label"))
    )
    return split_place_label(labelled, "label")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           strftime(date '1960-01-01' + CAST(floor(coalesce(x, 0)) AS INT), '%Y-%m-%d') AS shipped
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN
              CAST(date_diff('day', date '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) + l_discount END AS x
          FROM lineitem)
    """
)
def day_number_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01").cast("date")) + F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        day_number_to_iso(F.when(F.col("l_returnflag") != "R", days)).alias("shipped"),
    )
