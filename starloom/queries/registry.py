"""The registry of queries and the SQL texts shared by their oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources.readers import read_parquet
from starloom.values import LINE_MARKERS, TAIL_MARKERS, UNKNOWN_TEXT

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle if SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return read_parquet(spark, path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its files never change, so its schema is looked up in them only once."""
    path = f"{sf_dir}/{name}.parquet"
    return read_parquet(spark, path, _schema(spark, path))


UNKNOWN = f"'{UNKNOWN_TEXT}'"
WHITESPACE = " || ".join(f"chr({point})" for point in range(0x3001) if chr(point).isspace())


def sql_upper(text: str) -> str:
    """DuckDB keeps the sharp s when it raises case, Spark writes it as SS."""
    return f"upper(replace({text}, 'ß', 'SS'))"


MARKED = "|".join([f".*{marker}.*" for marker in LINE_MARKERS] + [f"{marker}.*" for marker in TAIL_MARKERS])


def sql_collapsed(text: str) -> str:
    return f"regexp_replace({text}, '{MARKED}', {UNKNOWN}, 'g')"


def sql_bare(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '''', '', 'g'), ',|-|[.]', '', 'g')"


def sql_table_text(text: str) -> str:
    """The standard for tables."""
    return f"coalesce({sql_collapsed(sql_bare(f'trim({sql_upper(text)})'))}, {UNKNOWN})"


def sql_label_text(text: str) -> str:
    """The standard for label lists."""
    return sql_collapsed(sql_bare(sql_upper(f"trim({text}, {WHITESPACE})")))
