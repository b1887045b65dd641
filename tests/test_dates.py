import datetime

from pyspark.sql import functions as F

from starloom.functions import day_number_to_iso
from tests.conftest import values


def test_day_numbers(spark):
    days = [20545.0, 20573.5, 0.0, None, -0.5, float("nan")]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d double")
    found = [row[1] for row in sorted(values(df.select("i", day_number_to_iso(F.col("d")))))]
    assert found == ["2016-04-01", "2016-04-29", "1960-01-01", "1960-01-01", "1959-12-31", "1960-01-01"]


def test_whole_range_of_day_numbers(spark):
    start = datetime.date(1960, 1, 1)
    df = spark.range(-30_000, 60_000, 997).select("id", day_number_to_iso(F.col("id")).alias("d"))
    assert all(iso == (start + datetime.timedelta(days)).isoformat() for days, iso in values(df))


def test_other_day_zero(spark):
    assert values(spark.range(1).select(day_number_to_iso(F.lit(1), "2000-02-28"))) == [("2000-02-29",)]
