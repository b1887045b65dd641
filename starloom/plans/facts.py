"""Fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from starloom.functions.dates import day_number_to_iso
from starloom.functions.text import TABLE_TEXT, TextStandard
from starloom.operators.columns import quoted, standardise_strings, string_columns
from starloom.operators.filters import fill_unknown_numbers
from starloom.operators.joins import Link, star_join


def clean_fact_source(
    source: DataFrame,
    day_number_columns: Sequence[str] = (),
    standard: TextStandard = TABLE_TEXT,
    all_wanted: bool = False,
) -> DataFrame:
    """Day numbers to ISO dates, strings standardised, unknown numbers filled.

    Only columns that are strings in the source are standardised: the dates keep their hyphens.
    ``all_wanted`` is for a result of which every column is read, as in ``standardise_strings``.
    """
    strings = string_columns(source)
    dated = source.select(
        *(
            day_number_to_iso(quoted(name)).alias(name) if name in day_number_columns else quoted(name)
            for name in source.columns
        )
    )
    cleaned = standardise_strings(
        dated, standard, [name for name in strings if name not in day_number_columns], all_wanted
    )
    return fill_unknown_numbers(cleaned)


def build_fact(
    source: DataFrame,
    links: Sequence[Link],
    projection: Mapping[str, str | Column],
    day_number_columns: Sequence[str] = (),
    unique_dimensions: bool = False,
) -> DataFrame:
    """Clean a fact source, join it to its dimensions and rename its columns."""
    if all(isinstance(wanted, str) for wanted in projection.values()):
        wanted = {link.fact_key for link in links} | set(projection.values())
        source = source.select(*(quoted(name) for name in source.columns if name in wanted))
    cleaned = clean_fact_source(source, day_number_columns, all_wanted=True)
    return star_join(cleaned, links, projection, unique_dimensions)
