"""Counts, ordering and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.columns import quoted
from starloom.operators.keys import as_key, common_key_type


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def table_counts(tables: Mapping[str, DataFrame], name: str = "n_rows") -> DataFrame:
    """Rows per table, empty tables included: ``table_name, n_rows``.

    All tables are counted in one job with one small shuffle; of each only row numbers are read.
    """
    spark = next(iter(tables.values())).sparkSession
    rows = [df.select(F.lit(table).alias("table_name"), F.lit(1).cast("long").alias("rows")) for table, df in tables.items()]
    # A row of 0 per table keeps the empty ones in.
    named = F.inline(
        F.array(*(F.struct(F.lit(table).alias("table_name"), F.lit(0).cast("long").alias("rows")) for table in tables))
    )
    return reduce(DataFrame.unionAll, [spark.range(1).select(named), *rows]).groupBy("table_name").agg(
        F.sum("rows").alias(name)
    )


def group_count(df: DataFrame, by: Sequence[str], counted: str | None = None, name: str = "n") -> DataFrame:
    """Rows per group, or the non-null values of ``counted`` per group."""
    what = F.lit(1) if counted is None else quoted(counted)
    return df.groupBy(*(quoted(key) for key in by)).agg(F.count(what).alias(name))


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the highest ``by``, equal ones in the order of ``ties``."""
    return df.orderBy(quoted(by).desc(), *(quoted(name) for name in ties)).limit(k)


def first_n(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: the first of an order, or any."""
    return df.orderBy(*(quoted(name) for name in order)).limit(n) if order else df.limit(n)


def fanout_count(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    by: Sequence[str],
    counted: str,
    name: str = "n",
) -> DataFrame:
    """Count the pairs of a many-to-many join per group of dimension columns, without the pairs.

    Equal to joining on the key, grouping by ``by`` and counting the non-null values of
    ``counted``. Both sides are counted per key first; a key with f fact rows and d dimension
    rows of a group then adds f * d. What is shuffled and joined grows with the number of
    distinct keys and groups, whatever share of the rows one key holds.
    """
    fact_type, held_type = fact.schema[fact_key].dataType, dimension.schema[dimension_key].dataType
    common = common_key_type(fact_type, held_type)
    facts = (
        fact.where(quoted(fact_key).isNotNull())
        # Grouped as a struct, so that the join shuffles by the plain key on both sides and
        # adaptive execution may split a key with many groups.
        .groupBy(F.struct(as_key(quoted(fact_key), fact_type, common).alias("key")).alias("__fact"))
        .agg(F.count(F.lit(1)).alias("__facts"))
        .select(F.col("__fact.key").alias("__key"), "__facts")
    )
    groups = {name: f"__by_{place}" for place, name in enumerate(by)}
    members = (
        dimension.where(quoted(dimension_key).isNotNull())
        .groupBy(
            as_key(quoted(dimension_key), held_type, common).alias("__held"),
            *(quoted(column).alias(alias) for column, alias in groups.items()),
        )
        .agg(F.count(quoted(counted)).alias("__members"))
    )
    return (
        facts.join(members, F.col("__key") == F.col("__held"))
        .groupBy(*(F.col(alias).alias(column) for column, alias in groups.items()))
        .agg(F.sum(F.col("__facts") * F.col("__members")).alias(name))
    )


def fanout_topk(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    by: Sequence[str],
    counted: str,
    k: int = 10,
    name: str = "n",
) -> DataFrame:
    """The ``k`` groups with the most pairs, ties in the order of ``by``."""
    return top_k(fanout_count(fact, dimension, fact_key, dimension_key, by, counted, name), name, k, by)
