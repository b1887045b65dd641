"""What several of these operators need: reading, tables between steps, counts and running totals."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

#: A word is what stands between the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application.

    The archive is made where the driver keeps its own files; Spark hands it to the executors.
    """
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(spark.sparkContext.applicationId)


#: The paths that ``saved`` has written to, in turn.
SAVED: list[str] = []


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Removes tables between steps; what was made from them must have been written."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark's setting for removing the shuffle files of a query once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside leave no shuffle files behind, which else stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def saved(spark: SparkSession, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The same rows, written to the shared folder and read back: lost executors can't undo them.

    The shuffles on the way are removed when the table has been written.
    """
    path = scratch_path(spark, name)
    SAVED.append(path)
    with shuffles_removed(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_count(text: Column) -> Column:
    """Length in UTF-8; 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number from [0, 1) that depends on the values alone, so that reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def running_totals(spark: SparkSession, df: DataFrame, order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """Adds ``row_index`` and, for each entry of ``sums``, the total of a column over all earlier rows.

    Rows are dealt out by ranges of ``order`` and written; then each range needs only the totals
    of the ranges before it, of which there are as many as tasks. No task sees more than its
    range. ``order`` should be unique: rows equal in it fall into one range.
    """
    ranged = saved(spark, df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(column).alias(f"_sum_{new}") for new, column in sums.items()]
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_sum_{new}") for new in sums],
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # The offsets are one row per task of the shuffle, whatever the data.
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumns(
            {"row_index": F.col("_rows") + F.row_number().over(inside) - 1}
            | {new: F.col(f"_sum_{new}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)) for new, c in sums.items()}
        )
        .drop("_range", "_rows", *[f"_sum_{new}" for new in sums])
    )
