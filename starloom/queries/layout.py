"""How tables are laid out, and what the writing of them tells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.checks import written_count_check
from starloom.operators.duplicates import one_row_per_key
from starloom.operators.joins import Link, star_join, without_match
from starloom.operators.kept_profile import keep_profile
from starloom.operators.kept_profile import kept_profile as profile_of
from starloom.plans.runs import Step, run_steps
from starloom.queries.registry import query, table
from starloom.queries.storage import write_delimited
from starloom.session import scratch_path
from starloom.sources import (
    append_table,
    bucket_count,
    file_ranges,
    land_delimited,
    read_parquet,
    rows_written,
    write_bucketed,
    write_ordered,
    write_table,
)


@query(
    """
    SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS metric, 'ok' AS status FROM orders
    UNION ALL SELECT 'lineitem', count(*), 0, 'ok' FROM lineitem
    UNION ALL SELECT 'nothing', 0, 0, 'failed'
    """
)
def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-count check by the counts of the writes, three of them at the same time, one an append."""
    root = scratch_path(spark, "counted")
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    finished = F.col("o_orderstatus") == "F"
    lines = lineitem.withColumn("ship_year", F.year("l_shipdate"))
    steps = {
        "finished": Step(lambda _: write_table(orders.where(finished), f"{root}/orders", measures=rows_written())),
        "open": Step(
            lambda _: append_table(orders.where(~finished), f"{root}/orders", orders.schema, measures=rows_written()),
            ["finished"],
        ),
        "lineitem": Step(lambda _: write_table(lines, f"{root}/lineitem", ["ship_year"], measures=rows_written())),
        "nothing": Step(lambda _: write_table(orders.where("o_orderkey < 0"), f"{root}/nothing", measures=rows_written())),
    }
    counted = {name: measured["n_rows"] for name, measured in run_steps(spark, steps).items()}
    counted["orders"] = counted["finished"] + counted["open"]
    return written_count_check(spark, counted, dict.fromkeys(["orders", "lineitem", "nothing"], 0))


@query(
    """
    SELECT c_custkey, CASE WHEN c_nationkey % 5 > 0 THEN c_acctbal END AS c_acctbal,
           CASE WHEN c_nationkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) || ';none;' || c_mktsegment
                WHEN c_nationkey % 5 = 1 THEN CAST(c_custkey AS VARCHAR) || ';' || CAST(CAST(c_acctbal AS DECIMAL(20, 2)) AS VARCHAR) || ';' || c_mktsegment || ';more'
           END AS rejected_line,
           (SELECT count(*) FROM customer WHERE c_nationkey % 5 > 1) AS n_rows,
           (SELECT count(*) FROM customer WHERE c_nationkey % 5 <= 1) AS n_rejects
    FROM customer
    """
)
def landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines, some with a bad number and some with a field too many, landed in one scan."""
    kind = F.col("c_nationkey") % 5
    key = F.col("c_custkey").cast("string")
    balance = F.when(kind == 0, "none").otherwise(F.col("c_acctbal").cast("decimal(20,2)").cast("string"))
    line = F.concat_ws(";", key, balance, "c_mktsegment", F.when(kind == 1, "more"))
    path = scratch_path(spark, "lines")
    lines = table(spark, sf_dir, "customer").select(line.alias("c_custkey;c_acctbal;c_mktsegment"))
    # Written with a separator that does not occur, so that each line goes out as it is.
    write_delimited(lines, path, "\x01", quote="")
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    landed = land_delimited(spark, path, scratch_path(spark, "landed"), schema, ";")
    rejects = landed.rejects.select("c_custkey", "c_acctbal", F.col("_rejected_line").alias("rejected_line"))
    both = landed.rows.select("c_custkey", "c_acctbal", F.lit(None).cast("string").alias("rejected_line")).unionByName(rejects)
    return both.withColumns({"n_rows": F.lit(landed.n_rows).cast("long"), "n_rejects": F.lit(landed.n_rejects).cast("long")})


@query(
    """
    WITH firsts AS (
        SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) = 1)
    SELECT l_orderkey, l_partkey, l_quantity, o_custkey AS customer, o_orderstatus <> 'F' AS is_new
    FROM firsts JOIN orders ON l_orderkey = o_orderkey
    """
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe, star join and anti join on one key of two bucketed tables: shuffled when written, not after."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    buckets = bucket_count(lines, orders)
    lines = write_bucketed(lines, scratch_path(spark, "lines-by-order"), ["l_orderkey"], buckets)
    orders = write_bucketed(orders, scratch_path(spark, "orders-by-key"), ["o_orderkey"], buckets)
    firsts = one_row_per_key(lines, ["l_orderkey"])
    joined = star_join(firsts, [Link(orders, "l_orderkey", "o_orderkey", "ordr", {"customer": "o_custkey"}, unique=True)])
    known = orders.where("o_orderstatus = 'F'")
    old, new = joined.join(known, joined.l_orderkey == known.o_orderkey, "left_semi"), without_match(joined, known, "l_orderkey", "o_orderkey")
    return old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True))).drop("ordr")


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS ship_year, l_returnflag AS flag
    FROM lineitem WHERE l_returnflag = 'R' AND year(l_shipdate) % 3 = 0
    """
)
def pruned_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned fact joined to filtered dimensions of its partition columns: only those partitions are read."""
    lineitem = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    path = scratch_path(spark, "facts-by-year")
    write_table(lineitem, path, ["ship_year", "l_returnflag"])
    fact = read_parquet(spark, path, lineitem.schema)
    years = lineitem.select(F.col("ship_year").alias("year")).distinct().select("year", (F.col("year") % 3).alias("rest"))
    flags = lineitem.select(F.col("l_returnflag").alias("letter")).distinct()
    root = scratch_path(spark, "dimensions")
    run_steps(
        spark,
        {
            "years": Step(lambda _: write_table(years, f"{root}/years")),
            "flags": Step(lambda _: write_table(flags, f"{root}/flags")),
        },
    )
    links = [
        Link(read_parquet(spark, f"{root}/years", years.schema).where("rest = 0"), "ship_year", "year", "ship_year"),
        Link(read_parquet(spark, f"{root}/flags", flags.schema).where("letter = 'R'"), "l_returnflag", "letter", "flag"),
    ]
    names = ("l_orderkey", "l_linenumber", "ship_year", "flag")
    return star_join(fact, links, {name: name for name in names})


@query(
    """
    SELECT ship_year, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity
    FROM (SELECT CAST(year(l_shipdate) AS INT) AS ship_year,
                 CASE WHEN year(l_shipdate) % 2 = 0 THEN -l_quantity ELSE l_quantity END AS quantity
          FROM lineitem WHERE year(l_shipdate) % 2 = 1 OR l_returnflag = 'N')
    GROUP BY 1
    """
)
def refreshed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other year is replaced by other rows, the years between stay as they are."""
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_quantity")
    path = scratch_path(spark, "refreshed")
    write_table(lines, path, ["ship_year"])
    other = lines.where("ship_year % 2 = 0 AND l_returnflag = 'N'").withColumn("l_quantity", -F.col("l_quantity"))
    write_table(other, path, ["ship_year"], refresh_partitions=True)
    held = read_parquet(spark, path, lines.schema)
    return held.groupBy("ship_year").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(
    """
    SELECT count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high, CAST(0 AS BIGINT) AS overlaps,
           (SELECT count(*) FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000) AS n_some
    FROM orders
    """
)
def ordered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by price over all files; ranges of files that overlap are counted."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "ordered")
    write_ordered(orders, path, ["o_totalprice"], 8)
    held = read_parquet(spark, path, orders.schema)
    # One row for each file.
    ranges = file_ranges(held, "o_totalprice")
    other = ranges.select(F.col("file").alias("other"), F.col("low").alias("from"), F.col("high").alias("to"))
    overlapping = ranges.join(F.broadcast(other), (F.col("file") < F.col("other")) & (F.col("low") < F.col("to")) & (F.col("from") < F.col("high")))
    some = held.where(F.col("o_totalprice").between(1000, 50000)).agg(F.count(F.lit(1)).alias("n_some"))
    about = ranges.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return about.withColumns(
        {"overlaps": overlapping.agg(F.count(F.lit(1))).scalar(), "n_some": some.scalar()}
    )


@query(
    """
    SELECT 'o_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(o_orderkey) AS nulls,
           CAST(min(o_orderkey) AS DOUBLE) AS low_number, CAST(max(o_orderkey) AS DOUBLE) AS high_number,
           CAST(NULL AS VARCHAR) AS low, CAST(NULL AS VARCHAR) AS high, TRUE AS distinct_close, TRUE AS quartiles_close FROM orders
    UNION ALL
    SELECT 'o_totalprice', count(*), count(*) FILTER (o_totalprice <= 1000), min(o_totalprice) FILTER (o_totalprice > 1000),
           max(o_totalprice), NULL, NULL, TRUE, TRUE FROM orders
    UNION ALL
    SELECT 'o_orderpriority', count(*), 0, NULL, NULL, min(o_orderpriority), max(o_orderpriority), TRUE, NULL FROM orders
    """
)
def kept_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile after three loads, none of which was read twice, held against the whole table."""
    price = F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("o_totalprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", price, "o_orderpriority", "o_orderstatus")
    path = scratch_path(spark, "profile")
    for status in ("F", "O", "P"):
        keep_profile(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), path, status)
    kept = profile_of(spark, path)
    # What a fresh pass finds: distinct values, and the rows up to each quartile of the sketches.
    numbers = ["o_orderkey", "o_totalprice"]
    quartiles = kept.where(F.col("p50").isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", F.array("p25", "p50", "p75")))).alias("found")
    )
    found = quartiles.scalar()
    fresh = []
    for name in ("o_orderkey", "o_totalprice", "o_orderpriority"):
        value = F.col(name)
        parts = [F.count_distinct(value).alias("exact"), F.count(value).alias("known")]
        if name in numbers:
            limits = F.element_at(found, F.lit(name))
            parts += [F.count_if(value <= F.get(limits, F.lit(k))).alias(f"upto{k}") for k in range(3)]
        else:
            parts += [F.lit(None).cast("long").alias(f"upto{k}") for k in range(3)]
        fresh.append(orders.agg(*parts).withColumn("column_name", F.lit(name)))
    held = reduce(DataFrame.unionByName, fresh)
    off = [F.abs(F.col(f"upto{k}") / F.col("known") - 0.25 * (k + 1)) for k in range(3)]
    return kept.join(held, "column_name").select(
        "column_name",
        "n_rows",
        "nulls",
        "low_number",
        "high_number",
        "low",
        "high",
        (F.abs(F.col("distinct") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_close"),
        (F.greatest(*off) <= 0.03).alias("quartiles_close"),
    )
