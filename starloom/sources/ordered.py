"""Tables in one order over all their files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.columns import quoted
from starloom.sources.writers import write_table


def write_ordered(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    files: int,
    ties: Sequence[str] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Write parquet as about ``files`` files, each with a range of ``order`` of its own and sorted inside.

    Ranges are cut by a sample so that files are alike in size. Rows equal in ``order`` go on in the
    order of ``ties`` (by default a hash of all columns), which lets a key with much of the table
    fill several files. Ranges do not overlap; a key that stands on a border is in both files. A reader that filters on ``order``
    skips the files, and inside them the row groups, whose range it does not meet. ``measures`` are
    taken as in ``write_table``.
    """
    keys = [quoted(name) for name in order]
    if ties is None:
        further = [F.xxhash64(*(quoted(name) for name in df.columns))]
    else:
        further = [quoted(name) for name in ties]
    ranged = df.repartitionByRange(files, *keys, *further).sortWithinPartitions(*keys, *further)
    return write_table(ranged, path, measures=measures)


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """Each file of a table with the range of a column in it: ``file``, ``low``, ``high``, ``n``."""
    named = df.select(F.col("_metadata.file_name").alias("file"), quoted(column).alias("value"))
    return named.groupBy("file").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))
