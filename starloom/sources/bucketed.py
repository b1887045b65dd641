"""Tables kept in buckets of a key, so that work on that key moves no rows.

Rows are dealt to a fixed number of buckets by a hash of the key, one sorted file for each bucket.
Grouping by the key, and joining tables with as many buckets on it, then needs no shuffle of the
bucketed side, however often it is done. Spark learns of buckets from its catalogue only, so each
path is registered there as an external table; the files stay plain parquet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.columns import quoted
from starloom.sources.readers import read_parquet

#: A bucket this many times the mean, and at least so large, holds a hot key.
HOT_FACTOR, HOT_BYTES = 4, 256 << 20

#: Rows that a bucket should hold. A task sorts a whole bucket, so they bound its memory.
BUCKET_ROWS = 500_000

_BUCKET_IN_NAME = r"_(\d+)(?:\.c\d+)?\.[^/]*parquet$"


def bucket_count(*tables: DataFrame, least: int = 8, rows: int = BUCKET_ROWS) -> int:
    """Buckets for tables that are to be joined on their key: the largest fills each with about ``rows``.

    With a fixed number, a bucket and the memory of the task that sorts it grow with the table.
    """
    return max(least, *(-(-table.count() // rows) for table in tables))


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] | None = None
) -> DataFrame:
    """Write parquet in ``buckets`` by ``keys``, sorted by ``sort_by`` (the keys by default), and read it back.

    Rows are shuffled once, by the same hash, so that each task writes one whole bucket instead of
    a piece of every bucket. NULL keys share a bucket. The path must not hold a table yet.
    """
    order = list(keys if sort_by is None else sort_by)
    writer = df.repartition(buckets, *(quoted(key) for key in keys)).write.bucketBy(buckets, *keys)
    if order:
        writer = writer.sortBy(*order)
    writer.format("parquet").option("path", path).saveAsTable(_table_name(path, buckets, keys))
    return read_bucketed(df.sparkSession, path, df.schema, keys, buckets, order)


def read_bucketed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """A table that ``write_bucketed`` has written with the same keys and buckets, here or in another session.

    Buckets cannot be split among tasks. Where one key, or a few that share a bucket, hold so many
    rows that its bucket is ``HOT_FACTOR`` times the mean and over ``hot_bytes``, the files are read
    as a plain table instead: work on the key then shuffles, but adaptive execution can split it.
    """
    if largest_bucket(spark, path, buckets) > hot_bytes:
        return read_parquet(spark, path, schema)
    name = _table_name(path, buckets, keys)
    if not spark.catalog.tableExists(name):
        order = list(keys if sort_by is None else sort_by)
        columns = ", ".join(f"{_sql_name(field.name)} {field.dataType.simpleString()}" for field in schema)
        sorted_by = f"SORTED BY ({', '.join(map(_sql_name, order))})" if order else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(map(_sql_name, keys))}) "
            f"{sorted_by} INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def largest_bucket(spark: SparkSession, path: str, buckets: int) -> int:
    """Bytes of the largest bucket, or 0 if it is no more than ``HOT_FACTOR`` times the mean.

    Only names and lengths of files are listed, and one row comes back.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    bucket = F.regexp_extract("path", _BUCKET_IN_NAME, 1)
    sizes = files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))
    largest, total = sizes.agg(F.max("bytes"), F.sum("bytes")).first()
    return largest if largest and largest * buckets > HOT_FACTOR * total else 0


def forget_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Take a bucketed table out of the catalogue; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path, buckets, keys)}")


def _table_name(path: str, buckets: int, keys: Sequence[str]) -> str:
    # One name for each path and layout, whatever the path looks like.
    named = repr((path.rstrip("/"), buckets, list(keys)))
    return f"bucketed_{hashlib.sha256(named.encode()).hexdigest()[:24]}"


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
