"""Column expressions: no Python runs per row, everything stays inside Spark's generated code."""

from starloom.functions.dates import day_number_to_iso
from starloom.functions.text import (
    LABEL_TEXT,
    TABLE_TEXT,
    TextStandard,
    blank_unknowns,
    nth_part,
    nth_part_as_double,
    standardise,
    strip_whitespace,
)

__all__ = [
    "LABEL_TEXT",
    "TABLE_TEXT",
    "TextStandard",
    "blank_unknowns",
    "day_number_to_iso",
    "nth_part",
    "nth_part_as_double",
    "standardise",
    "strip_whitespace",
]
