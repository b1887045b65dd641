"""Whole dimensions, facts and the star schema."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import nth_part
from starloom.operators.joins import Link
from starloom.plans import immigration
from starloom.plans.dimensions import build_dimension as dimension_of
from starloom.plans.dimensions import build_lookup as lookup_of
from starloom.plans.facts import build_fact as fact_of
from starloom.plans.runs import Step, run_steps
from starloom.queries.registry import UNKNOWN, query, sql_label_text, sql_table_text, table
from starloom.queries.storage import write_delimited, write_label_list
from starloom.session import scratch_path
from starloom.sources import read_label_list, write_table


@query(
    f"""
    SELECT p_brand, p_type, word, p_size, p_retailprice
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY word, p_size, p_retailprice) AS place
          FROM (SELECT DISTINCT {sql_table_text("p_brand")} AS p_brand, {sql_table_text("p_type")} AS p_type,
                       {sql_table_text("string_split(p_name, ' ')[2]")} AS word, p_size, p_retailprice
                FROM part WHERE p_size > 5 AND string_split(p_name, ' ')[2] <> 'gear'))
    WHERE place = 1
    """
)
def build_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = nth_part(F.col("p_name"), " ", 1)
    return dimension_of(
        table(spark, sf_dir, "part"),
        where=F.col("p_size") > 5,
        derive={"word": F.nullif(word, F.lit("gear"))},
        columns=["p_brand", "p_type", "word", "p_size", "p_retailprice"],
        required=["word"],
        key=["p_brand", "p_type"],
    )


@query(
    f"""
    SELECT DISTINCT o_custkey AS "Code", {sql_label_text("o_orderpriority")} AS "Priority"
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def build_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "orders").select(
        # A code that is no number is unknown, and its row incomplete.
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).otherwise("P").alias("code"),
        F.col("o_orderpriority").alias("label"),
    )
    path = write_label_list(labels, scratch_path(spark, "lookup"), "Code", "Priority")
    return lookup_of(read_label_list(spark, path, {"Code": "long"}), complete_only=True, distinct=True)


@query(
    f"""
    WITH source AS (
        SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS DOUBLE) AS spplr, lower(p_brand) || ' ' AS brand,
               nullif(l_returnflag, 'N') AS flag, CASE WHEN l_linestatus = 'O' THEN l_tax END AS tax,
               date_diff('day', date '1960-01-01', CAST(l_shipdate AS DATE)) AS shipped
        FROM lineitem JOIN part ON l_partkey = p_partkey),
    brands AS (SELECT DISTINCT {sql_table_text("p_brand")} AS brand FROM part WHERE p_size > 5)
    SELECT o_orderkey AS ordr, l_linenumber AS ln, s_suppkey AS spplr, brands.brand AS brnd,
           {sql_table_text("flag")} AS flg, coalesce(tax, -1) AS tx,
           strftime(date '1960-01-01' + CAST(shipped AS INT), '%Y-%m-%d') AS shppd
    FROM source JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
         JOIN supplier ON spplr = s_suppkey
         JOIN brands ON {sql_table_text("source.brand")} = brands.brand
    """
)
def build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, lineitem = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    source = lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").cast("double").alias("supplier"),
        F.concat(F.lower("p_brand"), F.lit(" ")).alias("brand"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax")).alias("tax"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double").alias("shipped"),
    )
    brands = dimension_of(parts, where=F.col("p_size") > 5, columns=["p_brand"], key=["p_brand"])
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return fact_of(
        source,
        [
            Link(orders, "l_orderkey", "o_orderkey", "ordr", unique=True),
            Link(table(spark, sf_dir, "supplier"), "supplier", "s_suppkey", "spplr"),
            Link(brands, "brand", "p_brand", "brnd"),
        ],
        {
            "ordr": "ordr",
            "ln": "l_linenumber",
            "spplr": "spplr",
            "brnd": "brnd",
            "flg": "flag",
            "tx": "tax",
            "shppd": "shipped",
        },
        day_number_columns=["shipped"],
    )


def immigration_inputs(spark: SparkSession, sf_dir: str) -> immigration.Inputs:
    """The inputs of the immigration star schema, made from the test tables.

    Suppliers stand for airports and ports, customers for cities, countries and states, line
    items for arrivals.
    """
    root = scratch_path(spark, "immigration-inputs")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lineitem = table(spark, sf_dir, "lineitem")
    key, place = F.col("s_suppkey"), F.col("s_nationkey")
    text = F.col("s_suppkey").cast("string")

    airports = supplier.select(
        F.concat(F.lit("S"), text).alias("ident"),
        F.lit("small_airport").alias("type"),
        F.concat("s_name", F.lit("'s Intl.")).alias("name"),
        (key % 1000).alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(place >= 20, "CA").when(place % 2 == 0, "US").otherwise("us").alias("iso_country"),
        F.concat(F.lit("US-"), F.left("n_name", F.lit(2))).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.concat(F.lit("G"), text).alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        F.when(key % 10 != 3, F.concat(F.lit("L"), text)).alias("local_code"),
        F.concat((key % 90).cast("string"), F.lit(".5, -7.25")).alias("coordinates"),
    )
    number = (F.col("c_custkey") % 1000).cast("int")
    cities = customer.select(
        F.concat("n_name", F.lit(" "), (F.col("c_custkey") % 40).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.lit(35.5).alias("median_age"),
        number.alias("male_population"),
        number.alias("female_population"),
        (number * 2).alias("total_population"),
        F.lit(None).cast("int").alias("number_of_veterans"),
        number.alias("foreign_born"),
        F.lit(2.5).alias("average_household_size"),
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("state_code"),
        F.col("c_mktsegment").alias("race"),
        number.alias("count"),
    )
    lists = {
        "countries": customer.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("label")),
        "ports": supplier.select(
            F.concat(F.lit("'L"), text, F.lit("'")).alias("code"),
            F.concat("s_name", F.lit(", "), F.left("n_name", F.lit(2))).alias("label"),
        ),
        "modes": lineitem.select(
            F.col("l_linenumber").alias("code"), F.concat(F.lit("Mode "), F.col("l_linenumber").cast("string")).alias("label")
        ).distinct(),
        "states": customer.select(
            F.concat(F.lit("'N"), F.col("c_nationkey").cast("string"), F.lit("'")).alias("code"),
            F.col("n_name").alias("label"),
        ).distinct(),
        "visas": lineitem.select(F.round(F.col("l_tax") * 100).cast("int").alias("code"))
        .distinct()
        .select("code", F.concat(F.lit("Visa "), F.col("code").cast("string")).alias("label")),
    }
    headers = {
        "countries": ("Code", "Country"),
        "ports": ("PORT", "CITY"),
        "modes": ("Code", "Mode"),
        "states": ("Code", "City"),
        "visas": ("Code", "Visa"),
    }
    residents = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "c_nationkey", "o_orderpriority")
    )
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double")
    arrivals = lineitem.join(residents, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.year("l_shipdate").cast("double").alias("i94yr"),
        F.quarter("l_shipdate").cast("double").alias("i94mon"),
        F.col("o_custkey").cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        F.concat(F.lit("l"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("i94port"),
        days.alias("arrdate"),
        F.when(F.col("l_returnflag") != "R", days + 10.5).alias("depdate"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("i94mode"),
        F.when(F.col("c_nationkey") % 6 != 5, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("i94addr"),
        F.col("l_quantity").alias("i94bir"),
        F.round(F.col("l_tax") * 100).alias("i94visa"),
        F.lit(1.0).alias("count"),
        *(F.col("l_linestatus").alias(name) for name in ("dtadfile", "visapost", "entdepa", "entdepd")),
        *(F.lit(None).cast("string").alias(name) for name in ("occup", "entdepu", "insnum")),
        F.col("l_returnflag").alias("matflag"),
        (F.year("l_shipdate") - F.col("l_quantity")).alias("biryear"),
        F.col("l_shipdate").cast("date").cast("string").alias("dtaddto"),
        F.col("o_orderpriority").alias("gender"),
        F.col("o_orderpriority").alias("airline"),
        F.col("l_orderkey").cast("double").alias("admnum"),
        F.col("l_suppkey").cast("string").alias("fltno"),
        F.col("l_returnflag").alias("visatype"),
    )
    # Every airport is written twice, so that the dimension has copies to drop.
    writes = {
        "airports": Step(lambda _: write_delimited(airports.union(airports), f"{root}/airports")),
        "cities": Step(lambda _: write_delimited(cities, f"{root}/cities", ";")),
        "arrivals": Step(lambda _: write_table(arrivals, f"{root}/arrivals")),
    }
    for name, labels in lists.items():
        write = partial(write_label_list, labels, f"{root}/{name}", *headers[name])
        writes[name] = Step(lambda _, write=write: write())
    run_steps(spark, writes)
    return immigration.Inputs(
        f"{root}/airports", f"{root}/cities", arrivals=f"{root}/arrivals", **{name: f"{root}/{name}" for name in lists}
    )


@query(
    f"""
    WITH counts AS (
        SELECT 'dim_countries' AS table_name, (SELECT count(*) FROM customer) AS n_rows
        UNION ALL SELECT 'dim_visa', (SELECT count(DISTINCT round(l_tax * 100)) FROM lineitem)
        UNION ALL SELECT 'dim_modes', (SELECT count(DISTINCT l_linenumber) FROM lineitem)
        UNION ALL SELECT 'dim_airports', (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'dim_cities',
            (SELECT count(DISTINCT (least(c_nationkey, 20), c_mktsegment, n_name, c_custkey % 40))
             FROM customer JOIN nation ON c_nationkey = n_nationkey)
            + (SELECT count(DISTINCT c_nationkey) FROM customer WHERE c_nationkey >= 20)
        UNION ALL SELECT 'fact_immigration',
            (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7))
    SELECT table_name, n_rows, CAST(0 AS BIGINT) AS metric, 'ok' AS status FROM counts
    """
)
def star_schema_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = immigration.run_star_schema(
        spark, immigration_inputs(spark, sf_dir), scratch_path(spark, "immigration")
    )
    return outcome.checks


def _fact_text(column: str) -> str:
    return f"{sql_table_text(column)} AS"


@query(
    f"""
    SELECT CAST(year(l_shipdate) AS DOUBLE) AS yr, CAST(quarter(l_shipdate) AS DOUBLE) AS mnth, o_custkey AS cty_cntry,
           CAST(c_nationkey AS DOUBLE) AS resdnc_cntry, 'L' || l_suppkey AS prt,
           strftime(l_shipdate, '%Y-%m-%d') AS arrvl_dt, CAST(l_linenumber AS BIGINT) AS arrvl_md,
           CASE WHEN c_nationkey % 6 <> 5 THEN 'N' || c_nationkey ELSE {UNKNOWN} END AS us_stt,
           CASE WHEN l_returnflag <> 'R' THEN strftime(CAST(l_shipdate AS DATE) + 10, '%Y-%m-%d') ELSE '1960-01-01' END AS dprtr_dt,
           CAST(l_quantity AS DOUBLE) AS rpndnt_age, CAST(round(l_tax * 100) AS BIGINT) AS vs_typ_id, CAST(1 AS DOUBLE) AS cnt,
           {_fact_text("l_linestatus")} dt_fl, {_fact_text("l_linestatus")} vs_issd_stt, {UNKNOWN} AS occptn,
           {_fact_text("l_linestatus")} arrvl_flg, {_fact_text("l_linestatus")} dprtr_flg, {UNKNOWN} AS updt_flg,
           {_fact_text("l_returnflag")} arrvl_dprtr_flg, CAST(year(l_shipdate) - l_quantity AS DOUBLE) AS brth_yr,
           strftime(l_shipdate, '%Y%m%d') AS allwd_dt, {_fact_text("o_orderpriority")} gndr, {UNKNOWN} AS ins_nmbr,
           {_fact_text("o_orderpriority")} arln, CAST(l_orderkey AS DOUBLE) AS admssn_nmbr, CAST(l_suppkey AS VARCHAR) AS flght_nmbr,
           {_fact_text("l_returnflag")} vs_typ
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE l_linenumber <> 7
    """
)
def star_schema_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table of the whole run, all columns of it."""
    root = scratch_path(spark, "immigration")
    inputs = immigration_inputs(spark, sf_dir)
    immigration.run_dimensions(spark, inputs, root)
    immigration.run_fact(spark, inputs, root)
    return immigration.read_table(spark, root, "fact_immigration")
