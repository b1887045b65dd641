"""Joins: anti join against a dimension, star join, append of missing members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.columns import conform, project, quoted
from starloom.operators.duplicates import distinct_keys, one_row_per_key
from starloom.operators.filters import keep_not_null
from starloom.operators.keys import as_key, common_key_type


def without_match(candidates: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Candidates whose key the dimension does not hold; a NULL key is never held.

    The dimension is reduced to its distinct keys before the shuffle, so its width and its
    repetitions do not travel.
    """
    held_key = dimension_key or key
    held = distinct_keys(dimension, held_key, "__held")
    common = common_key_type(candidates.schema[key].dataType, dimension.schema[held_key].dataType)
    same = as_key(quoted(key), candidates.schema[key].dataType, common) == as_key(
        F.col("__held"), dimension.schema[held_key].dataType, common
    )
    return candidates.join(held, same, "left_anti")


def missing_members(
    dimension: DataFrame,
    candidates: DataFrame,
    key: str,
    schema: T.StructType | None = None,
    null_key: str = "keep",
    dedupe: Sequence[str] = (),
) -> DataFrame:
    """The candidates that a dimension lacks, shaped like the dimension.

    ``null_key`` "drop" leaves candidates without a key out; ``dedupe`` names the columns of
    which each combination is taken once.
    """
    if null_key not in ("keep", "drop"):
        raise ValueError(f"null_key is 'keep' or 'drop', not {null_key!r}")
    if null_key == "drop":
        candidates = keep_not_null(candidates, key)
    new = conform(without_match(candidates, dimension, key), schema or dimension.schema)
    return one_row_per_key(new, dedupe) if dedupe else new


def append_missing(dimension: DataFrame, candidates: DataFrame, key: str, **options: object) -> DataFrame:
    """The dimension together with the candidates it lacked; options as in ``missing_members``."""
    return dimension.unionByName(missing_members(dimension, candidates, key, **options))


@dataclass(frozen=True)
class Link:
    """A dimension that a fact row must have a member of.

    ``output`` names the joined key, in the type it has in the dimension. ``attributes`` maps
    further output names to dimension columns. ``unique`` states that the key occurs once in
    the dimension; a link without attributes then only tests for existence (unless its text
    stands for a number of the fact), and one with attributes is joined as it stands.
    """

    dimension: DataFrame
    fact_key: str
    dimension_key: str
    output: str
    attributes: Mapping[str, str] = field(default_factory=dict)
    unique: bool = False


def star_join(
    fact: DataFrame,
    links: Sequence[Link],
    projection: Mapping[str, str | Column] | None = None,
    unique_dimensions: bool = False,
) -> DataFrame:
    """Inner join of a fact table with its dimensions, then a renaming projection.

    Fact rows without a member in every dimension drop out; a key that a dimension holds twice
    doubles its fact rows unless the link, or ``unique_dimensions``, says keys are unique.
    Dimensions are cut to the columns that are used, and how each is joined is left to Spark,
    which broadcasts those whose size is below its threshold and splits hot keys of the rest.
    """
    columns: dict[str, Column] = {name: quoted(name) for name in fact.columns}
    joined = fact
    for number, link in enumerate(links):
        fact_type = fact.schema[link.fact_key].dataType
        held_type = link.dimension.schema[link.dimension_key].dataType
        common = common_key_type(fact_type, held_type)
        fact_key = as_key(quoted(link.fact_key), fact_type, common)
        held_key = as_key(quoted(link.dimension_key), held_type, common)
        same_text = fact_type == held_type or not isinstance(held_type, T.StringType)
        probe = f"__key_{number}"
        if (link.unique or unique_dimensions) and not link.attributes and same_text:
            held = link.dimension.select(held_key.alias(probe))
            joined = joined.join(held, fact_key == F.col(probe), "left_semi")
            columns[link.output] = as_key(quoted(link.fact_key), fact_type, held_type)
            continue
        carried = {f"__out_{number}_0": link.dimension_key}
        columns[link.output] = F.col(f"__out_{number}_0")
        for place, (name, source) in enumerate(link.attributes.items(), start=1):
            carried[f"__out_{number}_{place}"] = source
            columns[name] = F.col(f"__out_{number}_{place}")
        held = link.dimension.select(
            held_key.alias(probe), *(quoted(source).alias(name) for name, source in carried.items())
        )
        joined = joined.join(held, fact_key == F.col(probe), "inner")
    if projection is None:
        return joined.select(*(column.alias(name) for name, column in columns.items()))
    return project(
        joined,
        {name: columns.get(source, source) if isinstance(source, str) else source for name, source in projection.items()},
    )
