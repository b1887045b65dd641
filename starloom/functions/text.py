"""Text standardisation as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.values import LINE_MARKERS, REMOVED_CHARACTERS, TAIL_MARKERS, UNKNOWN_TEXT

# Every character for which str.isspace() holds: ASCII and Unicode blanks, tabs, line ends.
WHITESPACE = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())


@dataclass(frozen=True)
class TextStandard:
    """How a text column is standardised.

    ``strip``         "whitespace" strips all blanks and tabs at both ends, "space" only U+0020.
    ``removed``       characters taken out wherever they stand.
    ``line_markers``  a line containing one is replaced as a whole.
    ``tail_markers``  a line is replaced from the first one on.
    ``unknown``       the replacement.
    ``fill_null``     whether NULL becomes ``unknown`` too.
    ``newline_only``  whether only ``\\n`` ends a line, or also the other Unicode line ends.
    """

    strip: str = "space"
    removed: tuple[str, ...] = REMOVED_CHARACTERS
    line_markers: tuple[str, ...] = LINE_MARKERS
    tail_markers: tuple[str, ...] = TAIL_MARKERS
    unknown: str = UNKNOWN_TEXT
    fill_null: bool = True
    newline_only: bool = False


# Label lists: padded and quoted text, NULL stays NULL.
LABEL_TEXT = TextStandard(strip="whitespace", fill_null=False, newline_only=True)
# Tables: NULL becomes the unknown text.
TABLE_TEXT = TextStandard()


def strip_whitespace(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def blank_unknowns(text: Column, standard: TextStandard = TABLE_TEXT) -> Column:
    """Replace what the markers of ``standard`` declare unknown.

    Written to be linear in the text: a line is searched for line markers once, from its start,
    instead of again from each of its characters, and texts without any marker (nearly all) only
    pay for substring searches and never reach the regular expression. There is a single such
    expression, because generated code that holds several for each of many columns outgrows what
    the JVM compiles.
    """
    branches = []
    if standard.line_markers:
        branches.append(f"^.*(?:{_any_of(standard.line_markers)}).*")
    if standard.tail_markers:
        branches.append(f"(?:{_any_of(standard.tail_markers)}).*")
    if not branches:
        return text
    pattern = ("(?md)" if standard.newline_only else "(?m)") + "|".join(branches)
    unknown = standard.unknown.replace("\\", "\\\\").replace("$", "\\$")
    return F.when(has_markers(text, standard), F.regexp_replace(text, F.lit(pattern), F.lit(unknown))).otherwise(text)


def has_markers(text: Column, standard: TextStandard = TABLE_TEXT) -> Column:
    """Whether any marker of ``standard`` stands in a text."""
    markers = standard.line_markers + standard.tail_markers
    return reduce(or_, [text.contains(F.lit(marker)) for marker in markers], F.lit(False))


def _any_of(markers: tuple[str, ...]) -> str:
    return "|".join(f"\\Q{marker}\\E" for marker in markers)


def bare_text(text: Column, standard: TextStandard = TABLE_TEXT) -> Column:
    """The first half of ``standardise``: strip, upper-case, remove punctuation."""
    if standard.strip == "whitespace":
        bare = F.upper(strip_whitespace(text))
    elif standard.strip == "space":
        bare = F.trim(F.upper(text))
    else:
        raise ValueError(f"unknown strip mode: {standard.strip!r}")
    for character in standard.removed:
        bare = F.replace(bare, F.lit(character), F.lit(""))
    return bare


def known_text(bare: Column, standard: TextStandard = TABLE_TEXT) -> Column:
    """The second half of ``standardise``: replace unknowns and, if asked, fill NULL."""
    clean = blank_unknowns(bare, standard)
    return F.coalesce(clean, F.lit(standard.unknown)) if standard.fill_null else clean


def standardise(text: Column, standard: TextStandard = TABLE_TEXT) -> Column:
    """Strip, upper-case, remove punctuation, replace unknowns and, if asked, fill NULL.

    For many columns of a table at once use ``standardise_strings``, whose generated code is
    smaller.
    """
    return known_text(bare_text(text, standard), standard)


def nth_part(text: Column, separator_pattern: str, n: int) -> Column:
    """Part ``n`` (from 0) of a split text, NULL where there are fewer parts.

    The split stops after the part asked for, so the rest of a long text is not cut up.
    """
    return F.get(F.split(text, separator_pattern, n + 2), F.lit(n))


def nth_part_as_double(text: Column, separator_pattern: str, n: int) -> Column:
    """Part ``n`` as a number, NULL where it is missing or not one."""
    return nth_part(text, separator_pattern, n).try_cast("double")
