"""Delimited files taken in with one scan: good rows and rejected lines side by side."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.readers import REJECTED_LINE, SOURCE_FILE, checked_delimited
from starloom.sources.writers import write_table

_IS_REJECT = "_is_reject"


@dataclass(frozen=True)
class Landed:
    """Good rows with their schema, rejected lines with their file, and how many there are of each."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def land_delimited(
    spark: SparkSession, source: str, path: str, schema: T.StructType, separator: str = ",", **options: object
) -> Landed:
    """Write delimited text as parquet, good rows and rejects apart, in one scan of the text.

    Both are partitions of one table at ``path``, so that each is read without the other, and
    both are counted by the job that writes them. ``rejects`` has ``_rejected_line``,
    ``_source_file`` and the columns as far as they could be read, NULL where not; every line of
    the files but headers and blank ones is in exactly one of the two.
    """
    checked = checked_delimited(spark, source, schema, separator, **options)
    marked = checked.withColumn(_IS_REJECT, F.col(REJECTED_LINE).isNotNull())
    bad = F.count_if(F.col(_IS_REJECT))
    # Partitions are filled where the lines are read: no row is moved to meet others of its kind.
    counted = write_table(
        marked, path, [_IS_REJECT], rebalance=False, measures={"n": F.count(F.lit(1)), "bad": bad}
    )
    landed = spark.read.schema(marked.schema).parquet(path)
    return Landed(
        landed.where(~F.col(_IS_REJECT)).select(*schema.fieldNames()),
        landed.where(_IS_REJECT).select(REJECTED_LINE, SOURCE_FILE, *schema.fieldNames()),
        counted["n"] - counted["bad"],
        counted["bad"],
    )
