"""The immigration star schema: five dimensions, one fact table, an analysis and a check.

Everything specific to it is data (schemas, column names); the work is done by the operators.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import LABEL_TEXT, nth_part, nth_part_as_double
from starloom.operators.aggregates import fanout_topk
from starloom.operators.checks import written_count_check
from starloom.operators.columns import cast_to_schema, rename_all, standardise_strings
from starloom.operators.duplicates import distinct_keys
from starloom.operators.joins import Link, missing_members, star_join
from starloom.operators.place_labels import split_place_label
from starloom.plans.dimensions import build_dimension, build_lookup
from starloom.plans.facts import clean_fact_source
from starloom.plans.runs import Step, run_steps
from starloom.sources.readers import read_delimited, read_format, read_label_list, read_parquet
from starloom.sources.writers import append_table, rows_written, write_table


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(*_typed(entry)) for entry in text.split(",")])


def _typed(entry: str) -> tuple[str, T.DataType]:
    name, kind = entry.split()
    return name, {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType}[kind]()


# The schemas and column names of the inputs and outputs, in their natural order.
AIRPORT_SOURCE = _schema(
    "ident string, type string, name string, elevation_ft int, continent string, iso_country string,"
    "iso_region string, municipality string, gps_code string, iata_code string, local_code string, coordinates string"
)
CITY_SOURCE = _schema(
    "city string, state string, median_age double, male_population int, female_population int,"
    "total_population int, number_of_veterans int, foreign_born int, average_household_size double,"
    "state_code string, race string, count int"
)
AIRPORT = _schema(
    "ident string, type string, name string, elevation_ft int, iso_country string, municipality string,"
    "gps_code string, iata_code string, latitude double, longitude double, state string, local_code string"
)
CITY = _schema(
    "city string, median_age double, male_population int, female_population int, total_population int,"
    "number_of_veterans int, foreign_born int, average_household_size double, state_code string, race string,"
    "count int, state string"
)
COUNTRY = _schema("Code long, Country string")
MODE = _schema("code long, mode string")
VISA = _schema("Code long, Visa string")
FACT = _schema(
    "yr double, mnth double, cty_cntry long, resdnc_cntry double, prt string, arrvl_dt string, arrvl_md long,"
    "us_stt string, dprtr_dt string, rpndnt_age double, vs_typ_id long, cnt double, dt_fl string,"
    "vs_issd_stt string, occptn string, arrvl_flg string, dprtr_flg string, updt_flg string,"
    "arrvl_dprtr_flg string, brth_yr double, allwd_dt string, gndr string, ins_nmbr string, arln string,"
    "admssn_nmbr double, flght_nmbr string, vs_typ string"
)
# Fact column to source column; those not listed are keys that come from a dimension.
FACT_SOURCES = {
    "yr": "i94yr",
    "mnth": "i94mon",
    "resdnc_cntry": "i94res",
    "arrvl_dt": "arrdate",
    "dprtr_dt": "depdate",
    "rpndnt_age": "i94bir",
    "cnt": "count",
    "dt_fl": "dtadfile",
    "vs_issd_stt": "visapost",
    "occptn": "occup",
    "arrvl_flg": "entdepa",
    "dprtr_flg": "entdepd",
    "updt_flg": "entdepu",
    "arrvl_dprtr_flg": "matflag",
    "brth_yr": "biryear",
    "allwd_dt": "dtaddto",
    "gndr": "gender",
    "ins_nmbr": "insnum",
    "arln": "airline",
    "admssn_nmbr": "admnum",
    "flght_nmbr": "fltno",
    "vs_typ": "visatype",
}
DAY_NUMBERS = ("arrdate", "depdate")
CITY_KEY = ("state_code", "race", "city")
TABLES = ("dim_countries", "dim_visa", "dim_modes", "dim_airports", "dim_cities", "fact_immigration")


def airport_dimension(source: DataFrame, latitude_part: int = 0, longitude_part: int = 1) -> DataFrame:
    """US airports that have a local code, their region and coordinates taken apart."""
    return build_dimension(
        source,
        where=F.upper("iso_country") == "US",
        derive={
            "state": nth_part(F.col("iso_region"), "-", 1),
            "latitude": nth_part_as_double(F.col("coordinates"), ",", latitude_part),
            "longitude": nth_part_as_double(F.col("coordinates"), ",", longitude_part),
        },
        columns=AIRPORT.fieldNames(),
        required=["local_code"],
    )


def city_dimension(source: DataFrame, null_key: str = "keep") -> DataFrame:
    """Cities by state code and race, one row each."""
    return build_dimension(source, columns=CITY.fieldNames(), key=CITY_KEY, null_key=null_key)


def country_dimension(labels: DataFrame) -> DataFrame:
    return build_lookup(labels, complete_only=True, distinct=True)


def port_members(labels: DataFrame) -> DataFrame:
    """Ports as airports: code, and the label split into municipality and state."""
    named = rename_all(labels, ["local_code", "label"])
    # The label is standardised while it is split.
    return split_place_label(standardise_strings(named, LABEL_TEXT, ["local_code"]), "label", "municipality", "state")


def state_members(labels: DataFrame) -> DataFrame:
    """States as cities: code and name."""
    return rename_all(build_lookup(labels), ["state_code", "city"])


def fact_links(dimensions: Mapping[str, DataFrame]) -> list[Link]:
    """The five dimensions an arrival refers to."""
    return [
        Link(dimensions["country"], "i94cit", "Code", "cty_cntry"),
        Link(dimensions["airport"], "i94port", "local_code", "prt"),
        Link(dimensions["mode"], "i94mode", "code", "arrvl_md"),
        # Cities repeat their state code: each code is taken once.
        Link(distinct_keys(dimensions["city"], "state_code", "state_code"), "i94addr", "state_code", "us_stt"),
        Link(dimensions["visa"], "i94visa", "Code", "vs_typ_id"),
    ]


def immigration_fact(
    cleaned: DataFrame, dimensions: Mapping[str, DataFrame], unique_dimensions: bool = False
) -> DataFrame:
    """Cleaned arrivals that have a member in every dimension, under their fact column names."""
    projection = {name: FACT_SOURCES.get(name, name) for name in FACT.fieldNames()}
    return cast_to_schema(star_join(cleaned, fact_links(dimensions), projection, unique_dimensions), FACT)


def settlement_topk(cleaned: DataFrame, cities: DataFrame, k: int = 10) -> DataFrame:
    """The cities and races with the most arrivals in their state: ``city, race, n``."""
    return fanout_topk(cleaned, cities, "i94addr", "state_code", ("city", "race"), counted="race", k=k)


@dataclass(frozen=True)
class Inputs:
    """Where the sources are. ``arrivals`` may be in any format that Spark has a reader for."""

    airports: str
    cities: str
    countries: str
    ports: str
    modes: str
    states: str
    visas: str
    arrivals: str
    arrivals_format: str = "parquet"
    arrivals_options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    """How tables are laid out and checked.

    ``airport_partitions`` of ("state", "local_code") gives one directory per airport; by
    default airports share a directory per state and are sorted by code inside it.
    """

    airport_partitions: tuple[str, ...] = ("state",)
    city_partitions: tuple[str, ...] = ("state",)
    fact_partitions: tuple[str, ...] = ("yr", "mnth", "us_stt")
    unique_dimensions: bool = False
    writes_at_once: int = 8
    metrics: Mapping[str, int] = field(default_factory=lambda: dict.fromkeys(TABLES, 0))


@dataclass(frozen=True)
class Outcome:
    """What a run leaves: the tables as written, the analysis and the check."""

    tables: Mapping[str, DataFrame]
    top_settlements: DataFrame
    checks: DataFrame


SCHEMAS = {
    "dim_countries": COUNTRY,
    "dim_visa": VISA,
    "dim_modes": MODE,
    "dim_airports": AIRPORT,
    "dim_cities": CITY,
    "fact_immigration": FACT,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the star schema with its declared schema."""
    return read_parquet(spark, f"{root}/{name}", SCHEMAS[name])


def dimension_steps(spark: SparkSession, inputs: Inputs, root: str, settings: Settings = Settings()) -> dict[str, Step]:
    """The writes of the dimensions: airports before the ports they lack, cities before the states.

    Each returns the number of rows it has written.
    """
    airports, cities = f"{root}/dim_airports", f"{root}/dim_cities"
    by_code = [name for name in ("local_code",) if name not in settings.airport_partitions]

    def write_airports(_):
        rows = airport_dimension(read_delimited(spark, inputs.airports, AIRPORT_SOURCE))
        return _count(write_table(rows, airports, settings.airport_partitions, sort_by=by_code, measures=rows_written()))

    def write_cities(_):
        rows = city_dimension(read_delimited(spark, inputs.cities, CITY_SOURCE, ";"))
        return _count(write_table(rows, cities, settings.city_partitions, measures=rows_written()))

    def write_countries(_):
        rows = country_dimension(read_label_list(spark, inputs.countries, {"Code": "long"}))
        return _count(write_table(cast_to_schema(rows, COUNTRY), f"{root}/dim_countries", measures=rows_written()))

    def append_ports(_):
        ports = port_members(read_label_list(spark, inputs.ports))
        new = missing_members(read_table(spark, root, "dim_airports"), ports, "local_code", AIRPORT)
        return _count(append_table(new, airports, AIRPORT, settings.airport_partitions, by_code, rows_written()))

    def write_modes(_):
        rows = build_lookup(read_label_list(spark, inputs.modes, {"code": "long"}, lower_headers=True))
        return _count(write_table(cast_to_schema(rows, MODE), f"{root}/dim_modes", measures=rows_written()))

    def append_states(_):
        states = state_members(read_label_list(spark, inputs.states, lower_headers=True))
        held = read_table(spark, root, "dim_cities")
        new = missing_members(held, states, "state_code", CITY, null_key="drop", dedupe=CITY_KEY)
        return _count(append_table(new, cities, CITY, settings.city_partitions, measures=rows_written()))

    def write_visas(_):
        rows = build_lookup(read_label_list(spark, inputs.visas, {"Code": "long"}))
        return _count(write_table(cast_to_schema(rows, VISA), f"{root}/dim_visa", measures=rows_written()))

    return {
        "dim_airports": Step(write_airports),
        "dim_cities": Step(write_cities),
        "dim_countries": Step(write_countries),
        "missing ports": Step(append_ports, ["dim_airports"]),
        "dim_modes": Step(write_modes),
        "missing states": Step(append_states, ["dim_cities"]),
        "dim_visa": Step(write_visas),
    }


# The steps whose rows make up a table, where it is more than one.
_PARTS = {"dim_airports": ("dim_airports", "missing ports"), "dim_cities": ("dim_cities", "missing states")}


def _count(measured: Mapping[str, int]) -> int:
    return measured["n_rows"]


def run_dimensions(spark: SparkSession, inputs: Inputs, root: str, settings: Settings = Settings()) -> dict[str, int]:
    """Write the dimensions, independent ones at the same time; returns the rows written by each step."""
    return run_steps(spark, dimension_steps(spark, inputs, root, settings), settings.writes_at_once)


def run_fact(spark: SparkSession, inputs: Inputs, root: str, settings: Settings = Settings()) -> tuple[DataFrame, int]:
    """Write the fact table from the written dimensions; returns the cleaned arrivals and the rows written."""
    arrivals = read_format(spark, inputs.arrivals, inputs.arrivals_format, inputs.arrivals_options)
    names = {
        "country": "dim_countries",
        "visa": "dim_visa",
        "mode": "dim_modes",
        "airport": "dim_airports",
        "city": "dim_cities",
    }
    dimensions = {role: read_table(spark, root, name) for role, name in names.items()}
    whole = clean_fact_source(arrivals, DAY_NUMBERS, all_wanted=True)
    fact = immigration_fact(whole, dimensions, settings.unique_dimensions)
    written = write_table(fact, f"{root}/fact_immigration", settings.fact_partitions, measures=rows_written())
    # Cleaned column by column, so that an analysis reads only what it looks at.
    return clean_fact_source(arrivals, DAY_NUMBERS), _count(written)


def run_star_schema(spark: SparkSession, inputs: Inputs, root: str, settings: Settings = Settings()) -> Outcome:
    """Dimensions, fact, analysis and row-count check, in this order.

    Dimensions that do not wait for each other are written at the same time, and the check takes
    the counts that the writes have measured: no table is read again for it.
    """
    steps = run_dimensions(spark, inputs, root, settings)
    cleaned, facts = run_fact(spark, inputs, root, settings)
    counts = steps | {name: sum(steps[part] for part in parts) for name, parts in _PARTS.items()} | {"fact_immigration": facts}
    tables = {name: read_table(spark, root, name) for name in TABLES}
    return Outcome(
        tables,
        settlement_topk(cleaned, tables["dim_cities"]),
        written_count_check(spark, counts, settings.metrics),
    )
