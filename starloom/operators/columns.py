"""Projections and rules applied to columns by type."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import TABLE_TEXT, TextStandard, bare_text, has_markers, known_text
from starloom.values import UNKNOWN_NUMBER, UNKNOWN_TEXT


def string_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


# From this many columns on, generated code that standardises them is longer than the JVM compiles.
MANY_COLUMNS = 7


def standardise_strings(
    df: DataFrame,
    standard: TextStandard = TABLE_TEXT,
    columns: Iterable[str] | None = None,
    all_wanted: bool = False,
) -> DataFrame:
    """Standardise all string columns, or the named ones.

    It takes two projections. The first computes each bare text once, and the second, which
    looks at it several times, only names it.

    ``all_wanted`` says that all columns are going to be read. Many columns are then searched for
    markers as one text, once for a row instead of once for each column, and only in rows that
    hold one are unknowns replaced, as the elements of an array. The price is that Spark can no
    longer leave out those that nobody reads.
    """
    chosen = set(string_columns(df) if columns is None else columns)
    named = [name for name in df.columns if name in chosen]
    if all_wanted and len(named) >= MANY_COLUMNS:
        bare = df.select(
            *(bare_text(quoted(name), standard).alias(name) if name in chosen else quoted(name) for name in df.columns)
        )
        # Texts that together hold a marker over their border only cost a look at each.
        marked = bare.withColumn("__marked", has_markers(F.concat_ws("\n", *map(quoted, named)), standard))
        known = F.transform(F.array(*map(quoted, named)), lambda text: known_text(text, standard))
        searched = marked.withColumn("__known", F.when(F.col("__marked"), known))
        place = {name: place for place, name in enumerate(named)}
        unknown = [F.lit(standard.unknown)] if standard.fill_null else []
        return searched.select(
            *(
                F.coalesce(F.get("__known", F.lit(place[name])), quoted(name), *unknown).alias(name)
                if name in place
                else quoted(name)
                for name in df.columns
            )
        )

    def each(step: Callable[[Column, TextStandard], Column], table: DataFrame) -> DataFrame:
        return table.select(
            *(
                step(quoted(name), standard).alias(name) if name in chosen else quoted(name)
                for name in table.columns
            )
        )

    return each(known_text, each(bare_text, df))


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename: output name to source column, in the order of ``mapping``."""
    return df.select(
        *(
            (quoted(source) if isinstance(source, str) else source).alias(name)
            for name, source in mapping.items()
        )
    )


def reorder_like(df: DataFrame, target: DataFrame | T.StructType) -> DataFrame:
    """The columns of ``target``, in its order."""
    names = target.columns if isinstance(target, DataFrame) else target.fieldNames()
    return df.select(*(quoted(name) for name in names))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names for all columns, by position."""
    return df.toDF(*names)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with exactly its types."""
    return df.select(*(quoted(field.name).cast(field.dataType).alias(field.name) for field in schema))


def conform(
    df: DataFrame,
    schema: T.StructType,
    text_default: str = UNKNOWN_TEXT,
    number_default: int = UNKNOWN_NUMBER,
) -> DataFrame:
    """Shape rows like a target table.

    Columns that ``df`` lacks are added with the default of their type; a type without a
    default is left NULL. The result has the types of ``schema``, not of the literals.
    """
    present = set(df.columns)

    def source(field: T.StructField) -> Column:
        if field.name in present:
            return quoted(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.lit(text_default)
        if isinstance(field.dataType, T.NumericType):
            return F.lit(number_default)
        return F.lit(None)

    return df.select(*(source(field).cast(field.dataType).alias(field.name) for field in schema))
