"""Place labels ``CITY, STATE[, OTHER]`` taken apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import LABEL_TEXT, TextStandard, nth_part, standardise, strip_whitespace
from starloom.operators.columns import quoted
from starloom.values import UNKNOWN_TEXT


def split_place_label(
    df: DataFrame,
    label: str,
    city: str = "city",
    state: str = "state",
    standard: TextStandard = LABEL_TEXT,
    unknown: str = UNKNOWN_TEXT,
) -> DataFrame:
    """Replace a label column by a city and a state column, both standardised.

    What follows the second comma is the third part, commas as blanks. A second part of one or two characters, or one with a bracket, is
    the state. A longer second part belongs to the city; then a short third part is the state,
    and a longer third part belongs to the city as well, which leaves the state unknown.
    """
    kept = [quoted(name) for name in df.columns if name != label]
    # Commas part the label, so they become bars before punctuation is removed.
    cleaned = standardise(F.replace(quoted(label), F.lit(","), F.lit("|")), standard)
    rest = F.regexp_replace(F.get(F.split(F.col("__label"), "[|]", 3), F.lit(2)), r"\s*[|][|\s]*", " ")
    texts = [*(nth_part(F.col("__label"), "[|]", n) for n in range(2)), rest]
    parts = [F.coalesce(strip_whitespace(text), F.lit(unknown)) for text in texts]
    split = df.select(*kept, cleaned.alias("__label")).select(
        *kept, *(part.alias(f"__part{n}") for n, part in enumerate(parts))
    )
    first, second, third = (F.col(f"__part{n}") for n in range(3))
    second_is_place = (F.length(second) > 2) & ~second.contains("(") & (second != unknown)
    third_is_place = second_is_place & (third != unknown) & (F.length(third) > 2)
    return split.select(
        *kept,
        F.when(third_is_place, F.concat_ws(" ", first, second, third))
        .when(second_is_place, F.concat_ws(" ", first, second))
        .otherwise(first)
        .alias(city),
        F.when(third_is_place, F.lit(unknown)).when(second_is_place, third).otherwise(second).alias(state),
    )
