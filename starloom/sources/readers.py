"""Scans. Schemas are declared wherever the caller knows them, so no inference job runs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import WHITESPACE


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Delimited text with a header line and a declared schema.

    Columns are taken by position, whatever the header says; a field that is not of its
    declared type is NULL.
    """
    return spark.read.schema(schema).option("sep", separator).option("header", True).csv(path)


#: What ``checked_delimited`` adds: the line as it stands if it was rejected, and the file it is from.
REJECTED_LINE, SOURCE_FILE = "_rejected_line", "_source_file"


def checked_delimited(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = ",", **options: object
) -> DataFrame:
    """Delimited text as ``read_delimited`` gives it, each row with what is wrong with it.

    A line is rejected if a field is not of its declared type or if it has more or fewer fields than
    the schema; ``_rejected_line`` then holds it as it stands, and is NULL for good lines.
    ``_source_file`` is the path of its file. All fields are parsed whatever columns are asked for,
    as a line is good or bad as a whole. Blank lines are no rows, and header lines are none either.
    """
    taken = {REJECTED_LINE, SOURCE_FILE} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"columns of a checked scan cannot be called {', '.join(sorted(taken))}")
    scan = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECTED_LINE, T.StringType())]))
        .option("sep", separator)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED_LINE)
        .options(**options)
        .csv(path)
    )
    fields = [F.col("`" + name.replace("`", "``") + "`") for name in schema.fieldNames()]
    # Only fields that are asked for are converted, and so found to be wrong. The condition always
    # holds; it asks for all of them.
    line = F.when(F.hash(*fields) >= F.lit(-(2**31)), F.col(REJECTED_LINE))
    return scan.withColumns({REJECTED_LINE: line, SOURCE_FILE: F.col("_metadata.file_path")})


def read_delimited_inferred(
    spark: SparkSession, path: str, separator: str = ",", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Delimited text for a first look: names from the header, types from a pass over the data."""
    return (
        spark.read.option("sep", separator)
        .option("header", True)
        .option("encoding", encoding)
        .option("inferSchema", True)
        .csv(path)
    )


def normalise_headers(df: DataFrame, lower: bool = False) -> DataFrame:
    """Column names without outer blanks and single quotes, optionally in lower case."""
    names = [name.strip(WHITESPACE).replace("'", "") for name in df.columns]
    return df.toDF(*(name.lower() if lower else name for name in names))


def read_label_list(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    lower_headers: bool = False,
    separator: str = "=",
) -> DataFrame:
    """A list of ``code = 'label'`` lines with a header.

    A line is parted at its first separator, so that a label may hold more of them. Padding
    around fields is dropped, single quotes stay data. ``types`` names the columns, by their
    normalised header, that hold something other than text; a text that is none of its type is
    NULL, and ``rejected_labels`` has its row.
    """
    table, types = _label_texts(spark, path, lower_headers, separator), types or {}
    return table.select(
        *(F.col(name).try_cast(types[name]).alias(name) if name in types else F.col(name) for name in table.columns)
    )


def rejected_labels(
    spark: SparkSession, path: str, types: Mapping[str, str], lower_headers: bool = False, separator: str = "="
) -> DataFrame:
    """The rows, as text, of which ``read_label_list`` with the same ``types`` makes some text NULL."""
    failed = [F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull() for name, kind in types.items()]
    return _label_texts(spark, path, lower_headers, separator).where(reduce(or_, failed, F.lit(False)))


# A control character that ends no field: every line is one.
_NO_SEPARATOR = "\x01"


def _label_texts(spark: SparkSession, path: str, lower_headers: bool, separator: str) -> DataFrame:
    """Both sides of the first separator of each line without padding, NULL where empty."""
    lines = spark.read.option("sep", _NO_SEPARATOR).option("quote", "").option("header", True).csv(path)
    header = lines.columns[0]
    line = F.col("`" + header.replace("`", "``") + "`")
    sides = F.split(line, f"\\Q{separator}\\E", 2)
    fields = [F.nullif(F.trim(F.get(sides, F.lit(n)), F.lit(WHITESPACE)), F.lit("")) for n in range(2)]
    return normalise_headers(lines.select(*fields).toDF(*header.split(separator, 1)), lower_headers)


def read_format(
    spark: SparkSession, path: str, format: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """A table in any format registered with Spark, its schema taken from the source."""
    return spark.read.format(format).options(**(options or {})).load(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, with the declared schema if there is one.

    Declaring it keeps partition values as they were written: left to itself Spark reads the
    directory name ``code=060`` back as the number 60.
    """
    if schema is None:
        return spark.read.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    # Partition columns come last, whatever their place in the schema.
    return table if table.columns == schema.fieldNames() else table.select(*schema.fieldNames())


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to SQL text under the given names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, **arguments: object) -> DataFrame:
    """SQL text over named tables; ``:name`` parameters come from ``arguments``."""
    register_views(tables or {})
    try:
        return spark.sql(text, args=arguments or None)
    finally:
        # The text is resolved by now.
        for name in tables or {}:
            spark.catalog.dropTempView(name)
