import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from starloom.operators.place_labels import split_place_label
from tests.conftest import UNKNOWN, values


def split(spark, labels):
    df = spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "i int, label string")
    return [tuple(row[1:]) for row in sorted(values(split_place_label(df, "label")))]


@pytest.mark.parametrize(
    ("label", "city", "state"),
    [
        ("'PACIFIC, HWY. STATION, CA '", "PACIFIC HWY STATION", "CA"),
        ("'Halifax, NS, Canada   '", "HALIFAX", "NS"),
        ("'CARAVELAS, BA #ARPT, BRAZIL'", "CARAVELAS BA #ARPT BRAZIL", UNKNOWN),
        ("'CANCUN, MEXICO'", "CANCUN MEXICO", UNKNOWN),
        ("'ASPEN, CO #ARPT'", "ASPEN CO #ARPT", UNKNOWN),
        ("'SALINAS, CA (BPS)'", "SALINAS", "CA (BPS)"),
        ("'MARIPOSA AZ           '", "MARIPOSA AZ", UNKNOWN),
        ("'INVALID - IWAKUNI, JAPAN'", UNKNOWN, UNKNOWN),
        ("'Collapsed into INT, MN'", UNKNOWN, UNKNOWN),
        ("'UNIDENTIFED AIR / SEAPORT'", "UNIDENTIFED AIR / SEAPORT", UNKNOWN),
        ("'INT''L FALLS, MN      '", "INTL FALLS", "MN"),
        ("'SWANTON, VT (BP - SECTOR HQ)'", "SWANTON", "VT (BP  SECTOR HQ)"),
        (None, UNKNOWN, UNKNOWN),
        ("A, T, BB", "A", "T"),
        ("A,", "A", ""),
        ("A, BCD, EF, more, parts", "A BCD EF MORE PARTS", UNKNOWN),
    ],
)
def test_labels(spark, label, city, state):
    assert split(spark, [label]) == [(city, state)]


def by_rule(parts):
    """The rule for one label, from its description: parts are already standardised."""
    parts = parts[:2] + [" ".join(parts[2:])] * (len(parts) > 2)
    c, s, o = (parts + [UNKNOWN] * 3)[:3]
    second_is_place = len(s) > 2 and "(" not in s and s != UNKNOWN
    if not second_is_place:
        return c, s
    if o != UNKNOWN and len(o) > 2:
        return f"{c} {s} {o}", UNKNOWN
    return f"{c} {s}", o


PARTS = st.lists(
    st.sampled_from(["A", "AB", "ABC", "AB (C)", "LONG NAME", UNKNOWN, "(X", "É", "ÉÈÊ"]), min_size=1, max_size=4
)


@hypothesis_settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(labels=st.lists(PARTS, min_size=30, max_size=60))
def test_labels_follow_the_rule(spark, labels):
    assert split(spark, [" , ".join(parts) for parts in labels]) == [by_rule(parts) for parts in labels]


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "A, BC", 2.0)], "i int, label string, x double")
    assert values(split_place_label(df, "label", "municipality", "st")) == [(1, 2.0, "A", "BC")]
