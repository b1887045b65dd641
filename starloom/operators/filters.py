"""Row filters and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.columns import quoted, string_columns
from starloom.values import UNKNOWN_NUMBER, UNKNOWN_TEXT


def keep_equal_ignoring_case(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.upper(quoted(column)) == F.lit(value.upper()))


def keep_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(quoted(column).isNotNull())
    return df


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which any of the columns is NULL (or NaN)."""
    return df.dropna(how="any", subset=list(columns) if columns is not None else None)


def fill_unknown_text(df: DataFrame, value: str = UNKNOWN_TEXT, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL in string columns."""
    return df.na.fill(value, subset=string_columns(df) if columns is None else list(columns))


def fill_unknown_numbers(df: DataFrame, value: int = UNKNOWN_NUMBER) -> DataFrame:
    """Replace NULL and NaN in all numeric columns; strings are left alone."""
    return df.na.fill(value)
