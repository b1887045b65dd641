"""Duplicates and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.columns import quoted


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, NULL among them."""
    return df.select(quoted(column)).distinct()


def distinct_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """The distinct values of a key as the build side of a join.

    They are found as structs and taken out again. Were they found as plain values, the join
    would take over their distribution over tasks, and adaptive execution, which only splits a
    hot key of the other side where both sides are shuffled for the join itself, would have to
    leave that key in one task.
    """
    return df.select(F.struct(quoted(key).alias("key")).alias("held")).distinct().select(F.col("held.key").alias(name))


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the lowest in the order of ``order``, NULL first.

    The order defaults to all other columns as they stand, and columns not named in ``order``
    follow it, so the winner never depends on how rows are distributed. It is the minimum of a
    struct, which each task takes over its own rows before anything is shuffled: a key with a
    third of all rows sends one row per task.
    """
    keys = list(keys)
    others = [name for name in (order or ()) if name not in keys]
    others += [name for name in df.columns if name not in keys and name not in others]
    if not others:
        return df.distinct()
    lowest = F.min(F.struct(*(quoted(name).alias(f"v{i}") for i, name in enumerate(others))))
    place = {name: i for i, name in enumerate(others)}
    winners = df.groupBy(*(quoted(name) for name in keys)).agg(lowest.alias("__winner"))
    return winners.select(
        *(
            F.col(f"__winner.v{place[name]}").alias(name) if name in place else quoted(name)
            for name in df.columns
        )
    )
