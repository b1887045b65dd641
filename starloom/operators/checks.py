"""Row-count check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.aggregates import table_counts


def row_count_check(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Count every table and compare with its metric: ``table_name, n_rows, metric, status``.

    A table fails when it has exactly ``metric`` rows, so a metric of 0 asks for "not empty".
    """
    return _judged(
        table_counts({name: df for name, (df, _) in tables.items()}),
        {name: metric for name, (_, metric) in tables.items()},
    )


def written_count_check(spark: SparkSession, counts: Mapping[str, int], metrics: Mapping[str, int]) -> DataFrame:
    """The same check of counts that are known already, as those that ``write_table`` measures.

    Nothing is read: the table is made of the counts, one row for each entry of ``metrics``. A
    table without a count was not written and counts as empty.
    """
    rows = (
        F.struct(F.lit(name).alias("table_name"), F.lit(counts.get(name, 0)).cast("long").alias("n_rows")) for name in metrics
    )
    return _judged(spark.range(1).select(F.inline(F.array(*rows))), metrics)


def _judged(counted: DataFrame, metrics: Mapping[str, int]) -> DataFrame:
    wanted = F.create_map(*(F.lit(item) for name, metric in metrics.items() for item in (name, metric)))
    metric = F.element_at(wanted, F.col("table_name")).cast("long")
    return counted.select(
        "table_name",
        "n_rows",
        metric.alias("metric"),
        F.when(F.col("n_rows") != metric, "ok").otherwise("failed").alias("status"),
    )
