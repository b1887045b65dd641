"""Concurrent writes: order, overlap, failure."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from starloom.operators.checks import written_count_check
from starloom.plans.runs import Step, run_steps
from starloom.sources import append_table, read_parquet, rows_written, write_table
from tests.conftest import values


def test_steps_wait_for_those_before_them_and_get_their_results(spark):
    done = []

    def step(name, value):
        def run(before):
            done.append(name)
            return value + sum(before.values())

        return run

    steps = {"c": Step(step("c", 100), ["a", "b"]), "a": Step(step("a", 1)), "b": Step(step("b", 10), ["a"])}
    assert run_steps(spark, steps) == {"a": 1, "b": 11, "c": 112}
    assert done == ["a", "b", "c"]


def test_independent_steps_overlap(spark):
    both = threading.Barrier(2, timeout=20)
    wait = Step(lambda _: both.wait() >= 0)
    assert run_steps(spark, {"a": wait, "b": wait}) == {"a": True, "b": True}


def test_one_at_a_time(spark):
    under_way, most = [], []

    def run(_):
        under_way.append(1)
        most.append(len(under_way))
        time.sleep(0.05)
        under_way.pop()

    run_steps(spark, {name: Step(run) for name in "abcd"}, at_once=1)
    assert max(most) == 1


def test_a_failure_stops_the_rest(spark):
    started, begun = [], threading.Event()

    def fails(_):
        begun.wait(20)
        raise KeyError("broken")

    steps = {
        "slow": Step(long_job(spark, begun)),
        "fails": Step(fails),
        "next": Step(lambda _: started.append("next"), ["fails"]),
        "last": Step(lambda _: started.append("last"), ["slow"]),
    }
    start = time.monotonic()
    with pytest.raises(KeyError, match="broken"):
        run_steps(spark, steps)
    assert started == []
    assert time.monotonic() - start < 30


def long_job(spark, begun):
    """A job of minutes of plain arithmetic, unless it is cancelled."""

    def run(_):
        begun.set()
        return spark.range(0, 10**13, 1, 8).select(F.max(F.col("id") % 7)).collect()

    return run


def test_circles_and_unknown_names_are_refused(spark):
    nothing = lambda _: pytest.fail("nothing should run")
    with pytest.raises(ValueError, match="nowhere"):
        run_steps(spark, {"a": Step(nothing, ["nowhere"])})
    with pytest.raises(ValueError):
        run_steps(spark, {"a": Step(nothing, ["b"]), "b": Step(nothing, ["a"]), "c": Step(nothing)})


def test_threads_keep_the_settings_of_the_caller(spark):
    spark.sparkContext.setLocalProperty("starloom.test", "kept")
    try:
        steps = {"a": Step(lambda _: spark.sparkContext.getLocalProperty("starloom.test"))}
        assert run_steps(spark, steps) == {"a": "kept"}
    finally:
        spark.sparkContext.setLocalProperty("starloom.test", None)


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_counts_come_from_the_write(spark, tmp_path, keys):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    counted = {}
    plain = jobs_of(spark, lambda: write_table(df, str(tmp_path / "plain"), keys))
    measures = rows_written() | {"largest": F.max("id"), "twos": F.count_if(F.col("k") == 2)}
    measured = jobs_of(spark, lambda: counted.update(write_table(df, str(tmp_path / "t"), keys, measures=measures)))
    assert counted == {"n_rows": 100, "largest": 99, "twos": 33}
    # No job beyond those of the write.
    assert measured == plain
    assert write_table(df, str(tmp_path / "plain"), keys) == {}


@pytest.mark.parametrize("keys", [[], ["id"]])
def test_counts_of_empty_writes_and_appends(spark, tmp_path, keys):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "id long, text string")
    assert write_table(empty, path, keys, measures=rows_written("n")) == {"n": 0}
    assert append_table(spark.range(4).withColumn("text", F.lit("x")), path, empty.schema, keys, measures=rows_written()) == {"n_rows": 4}
    assert read_parquet(spark, path, empty.schema).count() == 4


def test_check_of_known_counts(spark):
    check = written_count_check(spark, {"a": 5, "b": 0, "unasked": 1}, {"a": 0, "b": 0, "c": 3, "d": 0})
    assert sorted(values(check)) == [("a", 5, 0, "ok"), ("b", 0, 0, "failed"), ("c", 0, 3, "ok"), ("d", 0, 0, "failed")]
