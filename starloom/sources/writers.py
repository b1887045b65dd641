"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.columns import cast_to_schema, quoted, string_columns
from starloom.values import UNKNOWN_TEXT


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    refresh_partitions: bool = False,
    max_records_per_file: int = 0,
    measures: Mapping[str, Column] | None = None,
    rebalance: bool = True,
) -> dict[str, Any]:
    """Write parquet, one directory per distinct value of ``partition_by``.

    Rows are first rebalanced on the partition columns: rows of small partitions meet in one
    task and give one file, while a partition holding much of the table is spread over as many
    tasks as its size asks for. ``sort_by`` orders rows inside files, which lets readers skip
    row groups. An empty text in a partition column, which a directory name cannot hold, becomes
    the unknown text; NULL stays NULL. Without ``rebalance`` each task writes its rows where they are: for
    few partitions, and rows that are not worth a shuffle. With ``refresh_partitions`` only the directories that receive rows are replaced.

    ``measures`` are aggregates over the rows written, such as ``rows_written()``; they are taken by
    the writing job itself, without another pass, and returned by name. Nothing is returned
    without them. They see each row once, as a task that is run again counts once.
    """
    keys = list(partition_by)
    if keys:
        texts = [name for name in string_columns(df) if name in keys]
        df = df.withColumns(
            {name: F.when(quoted(name) == "", F.lit(UNKNOWN_TEXT)).otherwise(quoted(name)) for name in texts}
        )
        if rebalance:
            df = df.hint("rebalance", *keys)
    if sort_by:
        df = df.sortWithinPartitions(*keys, *sort_by)
    taken = None
    if measures:
        # Last before the write: behind every shuffle, in the stage whose tasks commit the files.
        taken = Observation()
        df = df.observe(taken, *(measure.alias(name) for name, measure in measures.items()))
    writer = df.write.mode(mode)
    if keys:
        writer = writer.partitionBy(*keys)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if refresh_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return taken.get if taken else {}


def rows_written(name: str = "n_rows") -> dict[str, Column]:
    """The measure that counts rows."""
    return {name: F.count(F.lit(1))}


def append_table(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Append rows to a parquet table, cast to the schema that the table already has.

    Without the cast a wider type slips into single files, and the table can be counted but no
    longer read. ``measures`` are taken over the appended rows, as in ``write_table``.
    """
    return write_table(cast_to_schema(df, schema), path, partition_by, "append", sort_by, measures=measures)
