"""Tables between steps."""

from pathlib import Path

from pyspark.sql import functions as F

from starloom.llm.common import _CLEANUP, saved


def test_saved_tables_leave_no_shuffles(spark):
    before = spark.conf.get(_CLEANUP, None)
    counts = spark.range(10_000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()
    found = saved(spark, counts, "counts")
    assert {(r.k, r["count"]) for r in found.collect()} == {(k, len(range(k, 10_000, 7))) for k in range(7)}
    assert spark.conf.get(_CLEANUP, None) == before
    # What was written can be asked for again, and so can what it was made from.
    assert counts.count() == found.count() == 7
    assert all(Path(f.removeprefix("file://")).exists() for f in found.inputFiles())
