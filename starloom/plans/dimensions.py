"""Dimensions from wide tables and from label lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from starloom.functions.text import LABEL_TEXT, TABLE_TEXT, TextStandard
from starloom.operators.columns import project, standardise_strings, string_columns
from starloom.operators.duplicates import one_row_per_key
from starloom.operators.filters import drop_incomplete, keep_not_null


def build_dimension(
    df: DataFrame,
    derive: Mapping[str, Column] | None = None,
    where: Column | None = None,
    columns: Sequence[str] | Mapping[str, str | Column] | None = None,
    required: Sequence[str] = (),
    distinct: bool = True,
    standard: TextStandard = TABLE_TEXT,
    key: Sequence[str] = (),
    null_key: str = "keep",
) -> DataFrame:
    """A dimension from a wide table.

    Rows are filtered by ``where`` and taken once, columns derived, the projection ``columns``
    applied, rows without a ``required`` value left out, all strings standardised and, given a
    ``key``, one row kept per key. Standardising fills NULL, so a NULL key survives as the
    unknown text unless ``null_key`` is "drop", which leaves such rows out beforehand.
    """
    if null_key not in ("keep", "drop"):
        raise ValueError(f"null_key is 'keep' or 'drop', not {null_key!r}")
    if where is not None:
        df = df.where(where)
    if distinct and not key:  # one row per key leaves no copies
        df = df.distinct()
    if derive:
        df = df.withColumns(dict(derive))
    if columns is not None:
        df = project(df, columns if isinstance(columns, Mapping) else {name: name for name in columns})
    df = keep_not_null(df, *required)
    if null_key == "drop":
        df = keep_not_null(df, *key)
    df = standardise_strings(df, standard)
    return one_row_per_key(df, key) if key else df


def build_lookup(
    df: DataFrame, complete_only: bool = False, distinct: bool = False, standard: TextStandard = LABEL_TEXT
) -> DataFrame:
    """A lookup dimension from a label list: texts standardised, optionally without incomplete
    and repeated rows."""
    if complete_only:
        # Before the texts are standardised, which would otherwise be done once to test them and
        # once more to keep them. Standardising adds no NULL, but may fill it.
        filled = set(string_columns(df)) if standard.fill_null else set()
        df = drop_incomplete(df, [name for name in df.columns if name not in filled])
    df = standardise_strings(df, standard)
    return df.distinct() if distinct else df
