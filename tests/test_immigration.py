import math

import pytest
from pyspark.sql import functions as F

from starloom.plans import immigration as im
from starloom.plans.dimensions import build_dimension, build_lookup
from starloom.plans.facts import clean_fact_source
from tests.conftest import UNKNOWN, values

AIRPORTS = """ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
K1,small_airport,"O'Hare Intl., North",600,NA,US,US-IL,Chicago,K1,,ORD,"40.1, -74.9"
K1,small_airport,"O'Hare Intl., North",600,NA,US,US-IL,Chicago,K1,,ORD,"40.1, -74.9"
K2,heliport,Bay,,NA,us,US,,K2,,LAX,"x, 1"
K3,heliport,No code,1,NA,US,US-CA,Town,K3,,,"1, 2"
K4,heliport,Abroad,1,NA,CA,CA-ON,Town,K4,,YYZ,"1, 2"
"""
CITIES = """City;State;Age;Male;Female;Total;Veterans;Foreign;Size;Code;Race;Count
La;California;35.1;1;2;3;4;5;2.5;CA;White;20
La;California;35.1;1;2;3;4;5;2.5;CA;White;10
La;California;35.1;1;2;3;4;5;2.5;CA;Asian;5
Nyc;New York;30.0;1;2;3;;5;2.5;NY;White;7
"""
COUNTRIES = "   Code = Country\n   582 =  'MEXICO Air'\n     0 =  'INVALID: STATELESS'\n   705 =  'INVALID: STATELESS'\n   582 =  'MEXICO Air'\n    1x =  'Bad'\n"
PORTS = "     PORT = CITY\n   'ALC'\t=\t'ALCAN, AK             '\n   'LAX'\t=\t'LOS ANGELES, CA'\n   '060'\t=\t'No PORT Code (60)'\n   'CP '\t=\t'No PORT Code (CP)'"
MODES = "Code = Mode\n1 = 'Air'\n9 = 'Not reported'"
STATES = "Code = City\n'CA'='CALIFORNIA'\n\t'GU'='GUAM'\n\t'NC'='N. CAROLINA'"
VISAS = "Code = Visa\n1 = Business\n2 = Pleasure"


def arrival(**changes):
    row = dict.fromkeys(im.FACT_SOURCES.values(), None) | {
        "i94yr": 2016.0,
        "i94mon": 4.0,
        "i94res": 582.0,
        "arrdate": 20545.0,
        "depdate": 20573.5,
        "i94bir": 40.0,
        "count": 1.0,
        "biryear": 1976.0,
        "admnum": 5.5,
        "gender": " m",
        "i94cit": 582.0,
        "i94port": "lax",
        "i94mode": 1.0,
        "i94addr": "CA",
        "i94visa": 2.0,
    }
    return row | changes


def arrivals_frame(spark, rows):
    numbers = {"i94yr", "i94mon", "i94res", "arrdate", "depdate", "i94bir", "count", "biryear", "admnum", "i94cit", "i94mode", "i94visa"}
    names = list(rows[0])
    schema = ", ".join(f"`{name}` {'double' if name in numbers else 'string'}" for name in names)
    return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], schema)


@pytest.fixture
def inputs(spark, tmp_path):
    texts = {
        "airports": AIRPORTS,
        "cities": CITIES,
        "countries": COUNTRIES,
        "ports": PORTS,
        "modes": MODES,
        "states": STATES,
        "visas": VISAS,
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, "utf-8")
    rows = [
        arrival(),
        arrival(i94addr="GU", i94port=" Alc"),
        arrival(i94addr="NY", depdate=None, i94port="060"),
        arrival(i94mode=None),
        arrival(i94addr=None),
        arrival(i94cit=0.0, i94addr="C.A", fltno="unknown-1"),
        arrival(i94port="YYZ"),
        arrival(i94cit=float("nan")),
    ]
    arrivals_frame(spark, rows).write.parquet(str(tmp_path / "arrivals"))
    return im.Inputs(**{name: str(tmp_path / f"{name}.csv") for name in texts}, arrivals=str(tmp_path / "arrivals"))


@pytest.mark.parametrize("partitions", [("state",), ("state", "local_code")])
def test_whole_run(spark, inputs, tmp_path, partitions):
    root = str(tmp_path / "out")
    settings = im.Settings(airport_partitions=partitions)
    im.run_star_schema(spark, inputs, root, settings)
    # A second run over the first one's tables gives the same tables.
    outcome = im.run_star_schema(spark, inputs, root, settings)
    tables = {name: sorted(values(df), key=str) for name, df in outcome.tables.items()}

    assert tables["dim_countries"] == [(0, UNKNOWN), (582, "MEXICO AIR"), (705, UNKNOWN)]
    assert tables["dim_visa"] == [(1, "BUSINESS"), (2, "PLEASURE")]
    assert tables["dim_modes"] == [(1, "AIR"), (9, "NOT REPORTED")]
    t = UNKNOWN
    assert tables["dim_airports"] == sorted(
        [
            ("K1", "SMALL_AIRPORT", "OHARE INTL NORTH", 600, "US", "CHICAGO", "K1", t, 40.1, -74.9, "IL", "ORD"),
            ("K2", "HELIPORT", "BAY", None, "US", t, "K2", t, None, 1.0, t, "LAX"),
            (t, t, t, -1, t, "ALCAN", t, t, -1.0, -1.0, "AK", "ALC"),
            (t, t, t, -1, t, t, t, t, -1.0, -1.0, t, "060"),
            (t, t, t, -1, t, t, t, t, -1.0, -1.0, t, "CP "),
        ],
        key=str,
    )
    unknown_city = (-1.0, -1, -1, -1, -1, -1, -1.0)
    assert tables["dim_cities"] == sorted(
        [
            ("LA", 35.1, 1, 2, 3, 4, 5, 2.5, "CA", "ASIAN", 5, "CALIFORNIA"),
            ("LA", 35.1, 1, 2, 3, 4, 5, 2.5, "CA", "WHITE", 10, "CALIFORNIA"),
            ("NYC", 30.0, 1, 2, 3, None, 5, 2.5, "NY", "WHITE", 7, "NEW YORK"),
            ("GUAM", *unknown_city, "GU", t, -1, t),
            ("N CAROLINA", *unknown_city, "NC", t, -1, t),
        ],
        key=str,
    )
    fact = outcome.tables["fact_immigration"]
    assert fact.schema == im.FACT
    kept = fact.select("cty_cntry", "prt", "us_stt", "arrvl_dt", "dprtr_dt", "gndr", "occptn", "flght_nmbr", "admssn_nmbr")
    assert sorted(values(kept), key=str) == sorted(
        [
            (582, "LAX", "CA", "2016-04-01", "2016-04-29", "M", t, t, 5.5),
            (582, "ALC", "GU", "2016-04-01", "2016-04-29", "M", t, t, 5.5),
            (582, "060", "NY", "2016-04-01", "1960-01-01", "M", t, t, 5.5),
            (0, "LAX", "CA", "2016-04-01", "2016-04-29", "M", t, t, 5.5),
        ],
        key=str,
    )
    # The analysis counts cleaned arrivals, also those that the fact table dropped.
    assert values(outcome.top_settlements) == [
        ("LA", "ASIAN", 5),
        ("LA", "WHITE", 5),
        ("GUAM", t, 1),
        ("NYC", "WHITE", 1),
    ]
    assert {row[0]: row[1:] for row in values(outcome.checks)} == {
        "dim_countries": (3, 0, "ok"),
        "dim_visa": (2, 0, "ok"),
        "dim_modes": (2, 0, "ok"),
        "dim_airports": (5, 0, "ok"),
        "dim_cities": (5, 0, "ok"),
        "fact_immigration": (4, 0, "ok"),
    }


def dimensions(spark, airports=("LAX",), state_codes=("CA",)):
    return {
        "country": spark.createDataFrame([(582, "MEXICO")], im.COUNTRY),
        "mode": spark.createDataFrame([(1, "AIR")], im.MODE),
        "visa": spark.createDataFrame([(2, "PLEASURE")], im.VISA),
        "airport": spark.createDataFrame([(code,) for code in airports], "local_code string"),
        "city": spark.createDataFrame([(code,) for code in state_codes], "state_code string"),
    }


def fact_of(spark, rows, unique=False, **held):
    cleaned = clean_fact_source(arrivals_frame(spark, rows), im.DAY_NUMBERS)
    return im.immigration_fact(cleaned, dimensions(spark, **held), unique)


def test_unknown_state_needs_an_unknown_city(spark):
    rows = [arrival(i94addr=None)]
    assert fact_of(spark, rows).count() == 0
    found = fact_of(spark, rows, state_codes=("CA", "CA", UNKNOWN))
    assert values(found.select("us_stt")) == [(UNKNOWN,)]


def test_repeated_airports_repeat_facts_unless_told_otherwise(spark):
    twice = ("LAX", "LAX")
    assert fact_of(spark, [arrival()], airports=twice).count() == 2
    assert fact_of(spark, [arrival()], airports=twice, unique=True).count() == 1


def test_fact_cleaning(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, " a-b ", "2016-04-01", 1.0)], "x double, n int, t string, iso string, day double"
    )
    assert values(clean_fact_source(df, ["day"])) == [(-1.0, -1, "AB", "20160401", "1960-01-02")]


def test_coordinate_order_is_a_parameter(spark):
    source = spark.createDataFrame([("a",) * 3 + (1, "NA", "US", "US-PA", "m", "g", "i", "L", "1.5, 2.5")], im.AIRPORT_SOURCE)
    assert values(im.airport_dimension(source, 1, 0).select("latitude", "longitude", "state")) == [(2.5, 1.5, "PA")]


def test_null_keys_are_filled_or_dropped(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("A", 3)], "k string, n int")
    assert sorted(values(build_dimension(df, key=["k"]))) == [("A", 2), (UNKNOWN, 1)]
    assert values(build_dimension(df, key=["k"], null_key="drop")) == [("A", 2)]
    with pytest.raises(ValueError):
        build_dimension(df, null_key="?")


def test_lookups(spark):
    df = spark.createDataFrame([(1, " a"), (1, "A "), (None, "b"), (2, None)], "code long, label string")
    assert build_lookup(df).count() == 4
    assert values(build_lookup(df, complete_only=True, distinct=True)) == [(1, "A")]
    from starloom.functions import TABLE_TEXT

    assert sorted(values(build_lookup(df, True, True, TABLE_TEXT))) == [(1, "A"), (2, UNKNOWN)]
    texts = df.select("label")
    assert build_lookup(texts, True, True, TABLE_TEXT).count() == 3


def test_dimension_reads_columns_once_filtered(spark):
    df = spark.createDataFrame([("us", "US-CA", math.pi), ("ca", "CA-ON", 1.0)], "c string, r string, x double")
    found = build_dimension(df, where=F.upper("c") == "US", columns={"place": "r", "x": "x"})
    assert values(found) == [("USCA", math.pi)]


def test_command_line(spark, inputs, tmp_path, capsys):
    from starloom.__main__ import main

    names = ("airports", "cities", "countries", "ports", "modes", "states", "visas", "arrivals")
    paths = [part for name in names for part in (f"--{name}", getattr(inputs, name))]
    assert main([*paths, "--output", str(tmp_path / "tables"), "--directory-per-airport", "--unique-dimensions"]) == 0
    printed = capsys.readouterr().out
    assert "ok     fact_immigration: 4 rows" in printed
    assert "GUAM" in printed
