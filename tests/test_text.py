import re
import time

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import (
    LABEL_TEXT,
    TABLE_TEXT,
    TextStandard,
    blank_unknowns,
    nth_part,
    nth_part_as_double,
    standardise,
)
from starloom.operators.columns import standardise_strings
from starloom.values import LINE_MARKERS, TAIL_MARKERS
from tests.conftest import UNKNOWN, plan_of, values


def clean(spark, texts, standard):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    return [row[1] for row in sorted(values(df.select("i", standardise(F.col("t"), standard))))]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (
            "'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'",
            "MEXICO AIR SEA AND NOT REPORTED (I94 NO LAND ARRIVALS)",
        ),
        ("'ARGENTINA '", "ARGENTINA "),
        ("'INVALID: STATELESS'", UNKNOWN),
        ("'Collapsed Tanzania (should not show)'", UNKNOWN),
        ("'No Country Code (54)'", UNKNOWN),
        ("'NOT REPORTED/UNKNOWN  '", UNKNOWN),
        ("'No PORT Code (CHN)'", UNKNOWN),
        ("\t'INT''L FALLS| MN      '", "INTL FALLS| MN      "),
        ("'.GA'", "GA"),
        ("'CP '", "CP "),
        (" \t'N. CAROLINA' ", "N CAROLINA"),
        ("Business", "BUSINESS"),
        ("straße", "STRASSE"),
        (None, None),
    ],
)
def test_label_text(spark, text, expected):
    assert clean(spark, [text], LABEL_TEXT) == [expected]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("  O'Hare Intl. ", "OHARE INTL"),
        ("a-b,c.d", "ABCD"),
        ("xx invalid yy", "XX " + UNKNOWN),
        ("a\nunknown b\nc", f"A\n{UNKNOWN}\nC"),
        ("\ta\t", "\tA\t"),
        ("", ""),
        (None, UNKNOWN),
    ],
)
def test_table_text(spark, text, expected):
    assert clean(spark, [text], TABLE_TEXT) == [expected]


def test_other_standards(spark):
    assert clean(spark, ["-a_b "], TextStandard(removed=("_",))) == ["-AB"]
    odd = TextStandard(line_markers=("A.B",), tail_markers=(), unknown=r"$1\x", removed=())
    assert clean(spark, ["x a.b", "axb", None], odd) == [r"$1\x", "AXB", r"$1\x"]
    assert clean(spark, ["unknown"], TextStandard(line_markers=(), tail_markers=())) == ["UNKNOWN"]
    with pytest.raises(ValueError):
        standardise(F.lit("a"), TextStandard(strip="left"))


# Pieces that make markers, line ends and near misses likely.
PIECES = st.lists(
    st.sampled_from(
        ["UNKNOWN", "NO PORT", "INVALID", "COLLAPSED", "NO COUNTRY", "UNKN", "NO ", "\n", "\n\n", " ", "A", "B-"]
    ),
    max_size=8,
).map("".join)


@hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(PIECES, min_size=20, max_size=60))
def test_unknowns_agree_with_the_plain_expression(spark, texts):
    plain = re.compile("|".join([f".*{m}.*" for m in LINE_MARKERS] + [f"{m}.*" for m in TAIL_MARKERS]))
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    for standard in (TABLE_TEXT, LABEL_TEXT):
        found = [row[1] for row in sorted(values(df.select("i", blank_unknowns(F.col("t"), standard))))]
        assert found == [plain.sub(UNKNOWN, text) for text in texts]


def test_line_ends_by_standard(spark):
    # For tables a carriage return ends a line, for label lists only a newline does.
    assert clean(spark, ["a\runknown"], TABLE_TEXT) == ["A\r" + UNKNOWN]
    assert clean(spark, ["a\runknown"], LABEL_TEXT) == [UNKNOWN]


def test_long_lines_take_linear_time(spark):
    text = "word " * 60_000 + "\ninvalid"
    start = time.monotonic()
    (found,) = clean(spark, [text], TABLE_TEXT)
    assert found.endswith("\n" + UNKNOWN)
    assert len(found) == 300_000 + 1 + len(UNKNOWN)
    assert time.monotonic() - start < 20


def test_only_strings_are_standardised(spark):
    df = spark.createDataFrame([(1, " a.b ", " c ", None)], "n int, `dotted.name` string, t string, u string")
    assert values(standardise_strings(df)) == [(1, "AB", "C", UNKNOWN)]
    assert values(standardise_strings(df, columns=["t"])) == [(1, " a.b ", "C", None)]
    assert standardise_strings(df).columns == df.columns


def test_nth_part(spark):
    df = spark.createDataFrame([("US-PA-X",), ("US",), ("US-",), (None,)], "t string")
    assert values(df.select(nth_part(F.col("t"), "-", 1))) == [("PA",), (None,), ("",), (None,)]
    assert values(df.select(nth_part(F.col("t"), "-", 2))) == [("X",), (None,), (None,), (None,)]


def test_nth_part_as_double(spark):
    df = spark.createDataFrame([("40.1, -74.9",), ("x, 1",), ("2",)], "t string")
    parts = [nth_part_as_double(F.col("t"), ",", n) for n in (0, 1)]
    assert values(df.select(*parts)) == [(40.1, -74.9), (None, 1.0), (2.0, None)]


def test_many_columns_at_once(spark):
    row = [" a.b", None, "x\nno port\ny", "it's", "1-2", " c ", "invalid", "ok"]
    df = spark.createDataFrame([(1, *row)], "n int, " + ", ".join(f"`t.{i}` string" for i in range(8)))
    together, one_by_one = standardise_strings(df, all_wanted=True), standardise_strings(df)
    assert "transform" in plan_of(together)
    assert "transform" not in plan_of(one_by_one)
    assert values(together) == values(one_by_one)
    assert values(together) == [(1, "AB", UNKNOWN, f"X\n{UNKNOWN}\nY", "ITS", "12", "C", UNKNOWN, "OK")]
    assert together.columns == df.columns
    kept = standardise_strings(df, LABEL_TEXT, all_wanted=True)
    assert values(kept.select("`t.1`", "n")) == [(None, 1)]


def test_unknowns_are_replaced_in_marked_rows_only(spark):
    rows = [("no", "port", "in", "valid", "no", "x", " port"), ("a", "b", "c", None, "d", "no port", "e.")]
    df = spark.createDataFrame(rows, ", ".join(f"t{i} string" for i in range(7)))
    together = standardise_strings(df, all_wanted=True)
    assert "__marked" in plan_of(together)
    assert values(together) == [("NO", "PORT", "IN", "VALID", "NO", "X", "PORT"), ("A", "B", "C", UNKNOWN, "D", UNKNOWN, "E")]
