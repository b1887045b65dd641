"""Profiles of tables, as tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.aggregates import table_counts
from starloom.operators.columns import quoted


def _one_row_per_column(df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Aggregates over all columns in a single pass, then turned into a row per column."""
    cells = [
        measure(quoted(column)).alias(f"c{place}_{name}")
        for place, column in enumerate(columns)
        for name, measure in measures.items()
    ]
    entries = F.array(
        *(
            F.struct(
                F.lit(column).alias("column_name"),
                *(F.col(f"c{place}_{name}").alias(name) for name in measures),
            )
            for place, column in enumerate(columns)
        )
    )
    return df.agg(*cells).select(F.inline(entries))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column, for the columns that have any: ``column_name, nulls``."""
    return _one_row_per_column(df, df.columns, {"nulls": lambda c: F.count_if(c.isNull())}).where("nulls > 0")


def column_catalogue(df: DataFrame) -> DataFrame:
    """Every column: ``column_name, position, data_type, non_nulls``."""
    about = F.create_map(
        *(
            F.lit(item)
            for place, field in enumerate(df.schema)
            for item in (field.name, f"{place:06d}{field.dataType.simpleString()}")
        )
    )
    counted = _one_row_per_column(df, df.columns, {"non_nulls": F.count})
    described = F.element_at(about, F.col("column_name"))
    return counted.select(
        "column_name",
        F.substring(described, 1, 6).cast("int").alias("position"),
        F.substr(described, F.lit(7)).alias("data_type"),
        "non_nulls",
    )


def table_shape(df: DataFrame) -> DataFrame:
    """Rows and columns: ``n_rows, n_columns``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The shape of every table: ``table_name, n_rows, n_columns``."""
    widths = F.create_map(*(F.lit(item) for name, df in tables.items() for item in (name, len(df.columns))))
    return table_counts(tables).withColumn("n_columns", F.element_at(widths, F.col("table_name")).cast("long"))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _known(field: T.StructField) -> Column:
    """The value as a double, NULL for NaN."""
    value = quoted(field.name).cast("double")
    fractional = isinstance(field.dataType, (T.FloatType, T.DoubleType))
    return F.nanvl(value, F.lit(None).cast("double")) if fractional else value


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Per numeric column ``column_name, n, mean, std, min, p25, p50, p75, max``, NULL and NaN left out.

    Quartiles are exact and interpolated, yet no task ever holds all values of a column. The
    first passes take the plain measures and, from a sketch of bounded size, two values around
    each quartile. Another counts the rows below them, which proves that the quartile lies
    between (if it ever does not, the minimum and maximum of the column take their place). Each
    of these passes brings one row to the driver. Where the two values are equal the quartile is
    found; for the others the returned table orders only the distinct values in between,
    16 / ``accuracy`` of the rows or less per quartile.
    """
    if columns is None:
        columns = [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]
    plain = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    values = {name: _known(df.schema[name]) for name in columns}
    first = df.agg(
        *(measure(values[name]).alias(f"{name}|{key}") for name in columns for key, measure in plain.items())
    ).first()
    brackets = _brackets(df, values, first, accuracy)
    found = {(b.column, b.quartile): b.low for b in brackets if b.low == b.high}
    measures = df.sparkSession.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(first[f"{name}|n"]).cast("long").alias("n"),
                        *(
                            F.lit(first[f"{name}|{key}"]).cast("double").alias(key)
                            for key in ("mean", "std", "min", "max")
                        ),
                        *(F.lit(found.get((name, key))).cast("double").alias(key) for key in QUARTILES),
                    )
                    for name in columns
                )
            )
        )
    )
    order = ["column_name", "n", "mean", "std", "min", *QUARTILES, "max"]
    brackets = [b for b in brackets if b.low != b.high]
    if not brackets:
        return measures.select(*order)
    # Bounded by the number of columns.
    searched = F.broadcast(_quartiles(df, values, brackets)).select(
        F.col("column_name"), *(F.col(key).alias(f"searched_{key}") for key in QUARTILES)
    )
    return (
        measures.join(searched, "column_name", "left")
        .withColumns({key: F.coalesce(key, f"searched_{key}") for key in QUARTILES})
        .select(*order)
    )


@dataclass
class _Bracket:
    """Two values with a quartile between them: it lies between the ranks ``below`` and
    ``above``, counted from 0, and ``offset`` rows are under ``low``."""

    column: str
    quartile: str
    low: float
    high: float
    below: int
    above: int
    fraction: float
    offset: int = 0


def _brackets(df: DataFrame, values: Mapping[str, Column], first: Row, accuracy: int) -> list[_Bracket]:
    """A bracket for each quartile of each column that has values."""
    margin = 4.0 / accuracy
    shares = [min(max(share + side * margin, 0.0), 1.0) for share in QUARTILES.values() for side in (-1, 1)]
    filled = [name for name in values if first[f"{name}|n"]]
    if not filled:
        return []
    # On its own: next to the sketch, Spark would take the plain measures out of generated code.
    sketch = df.agg(*(F.percentile_approx(values[name], shares, accuracy).alias(name) for name in filled)).first()
    brackets = []
    for name in filled:
        for place, (quartile, share) in enumerate(QUARTILES.items()):
            target = share * (first[f"{name}|n"] - 1)
            low, high = sketch[name][2 * place : 2 * place + 2]
            brackets.append(_Bracket(name, quartile, low, high, int(target), math.ceil(target), target % 1))
    counted = df.agg(
        *(F.count_if(values[b.column] < b.low).alias(f"under{place}") for place, b in enumerate(brackets)),
        *(F.count_if(values[b.column] <= b.high).alias(f"upto{place}") for place, b in enumerate(brackets)),
    ).first()
    for place, b in enumerate(brackets):
        if counted[f"under{place}"] <= b.below and counted[f"upto{place}"] > b.above:
            b.offset = counted[f"under{place}"]
        else:
            b.low, b.high = first[f"{b.column}|min"], first[f"{b.column}|max"]
    return brackets


def _quartiles(df: DataFrame, values: Mapping[str, Column], brackets: Sequence[_Bracket]) -> DataFrame:
    """A row per column with its interpolated quartiles, from the values inside the brackets."""
    inside = [values[b.column].between(b.low, b.high) for b in brackets]
    about = ["column_name", "quartile", "below", "above", "fraction", "offset"]
    entries = [
        F.struct(
            F.lit(b.column).alias("column_name"),
            F.lit(b.quartile).alias("quartile"),
            *(F.lit(rank).cast("long").alias(name) for name, rank in (("below", b.below), ("above", b.above))),
            F.lit(b.fraction).alias("fraction"),
            F.lit(b.offset).cast("long").alias("offset"),
            F.when(is_inside, values[b.column]).alias("value"),
        )
        for b, is_inside in zip(brackets, inside, strict=True)
    ]
    running = (
        Window.partitionBy("column_name", "quartile")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        df.where(reduce(or_, inside))
        .select(F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .groupBy(*about, "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("upto", F.col("offset") + F.sum("copies").over(running))
    )

    def value_at(rank: str) -> Column:
        """The value whose copies span a rank counted from 0."""
        return F.min(F.when(F.col("upto") > F.col(rank), F.col("value")))

    between = value_at("below") + (value_at("above") - value_at("below")) * F.max("fraction")
    found = placed.groupBy("column_name", "quartile").agg(between.alias("value"))
    return found.groupBy("column_name").agg(
        *(F.max(F.when(F.col("quartile") == name, F.col("value"))).alias(name) for name in QUARTILES)
    )
