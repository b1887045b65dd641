"""Landing with rejects, buckets, ordered files, kept profiles, and scans pruned by dimensions."""

import math
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.duplicates import one_row_per_key
from starloom.operators.joins import Link, star_join, without_match
from starloom.operators.kept_profile import keep_profile, kept_profile
from starloom.queries import layout
from starloom.session import build_session
from starloom.sources import (
    bucket_count,
    checked_delimited,
    file_ranges,
    forget_bucketed,
    land_delimited,
    read_bucketed,
    read_parquet,
    write_bucketed,
    write_ordered,
    write_table,
)
from tests.conftest import final_plan_of, plan_of, values

LINES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())]
)


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.csv").write_text('id,amount,note\n1,1.5,x\n2,many,"y, z"\n\n3,,\nx,2.5,w\n', "utf-8")
    (folder / "b.csv").write_text("id,amount,note\n4,4\n5,5.0,é,more\n6,6.0,v\n", "utf-8")
    return str(folder)


def test_every_line_is_a_row_or_a_reject(spark, lines, tmp_path):
    landed = land_delimited(spark, lines, str(tmp_path / "landed"), LINES)
    assert (landed.n_rows, landed.n_rejects) == (3, 4)
    assert landed.rows.schema == LINES
    assert sorted(values(landed.rows)) == [(1, 1.5, "x"), (3, None, None), (6, 6.0, "v")]
    rejects = {row[0]: (row[1].rsplit("/", 1)[1], *row[2:]) for row in values(landed.rejects)}
    assert rejects == {
        '2,many,"y, z"': ("a.csv", 2, None, "y, z"),
        "x,2.5,w": ("a.csv", None, 2.5, "w"),
        "4,4": ("b.csv", 4, 4.0, None),
        "5,5.0,é,more": ("b.csv", 5, 5.0, "é"),
    }


def test_rejects_are_the_same_whatever_is_asked_for(spark, lines):
    checked = checked_delimited(spark, lines, LINES)
    assert sorted(values(checked.where("_rejected_line IS NULL").select("id"))) == [(1,), (3,), (6,)]


def test_landing_reads_the_text_once(spark, lines, tmp_path):
    landed = land_delimited(spark, lines, str(tmp_path / "landed"), LINES)
    for table, side in ((landed.rows, "NOT _is_reject"), (landed.rejects, "_is_reject")):
        plan = plan_of(table)
        assert "csv" not in plan.lower()
        assert "PartitionFilters: [isnotnull(_is_reject" in plan, side


def test_landing_nothing_and_names_that_clash(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("id,amount,note\n", "utf-8")
    landed = land_delimited(spark, str(tmp_path / "empty.csv"), str(tmp_path / "landed"), LINES)
    assert (landed.n_rows, landed.n_rejects, landed.rows.count(), landed.rejects.count()) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="_rejected_line"):
        checked_delimited(spark, str(tmp_path), T.StructType().add("_rejected_line", "string"))


@pytest.fixture
def bucketed(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(3000).select((F.col("id") % 700).alias("k"), "id", F.lit("text").alias("payload"))
    held = spark.range(500).select(F.col("id").alias("code"), (F.col("id") * 2).alias("twice"))
    paths = str(tmp_path / "facts"), str(tmp_path / "held")
    yield write_bucketed(facts, paths[0], ["k"], 6), write_bucketed(held, paths[1], ["code"], 6), facts, held, paths
    forget_bucketed(spark, paths[0], ["k"], 6)
    forget_bucketed(spark, paths[1], ["code"], 6)


def physical(df):
    plan = plan_of(df)
    return plan[plan.index("== Physical Plan ==") :]


def test_work_on_the_key_of_buckets_shuffles_nothing(bucketed):
    facts, held, plain, plain_held, _ = bucketed
    link = {"attributes": {"double": "twice"}, "unique": True}
    for found, expected in (
        (one_row_per_key(facts, ["k"]), one_row_per_key(plain, ["k"])),
        (
            star_join(facts, [Link(held, "k", "code", "key", **link)]),
            star_join(plain, [Link(plain_held, "k", "code", "key", **link)]),
        ),
    ):
        assert "Exchange" not in physical(found)
        assert "Bucketed: true" in physical(found)
        assert sorted(values(found)) == sorted(values(expected))


def test_anti_join_moves_the_keys_of_the_dimension_only(bucketed):
    facts, _, plain, plain_held, _ = bucketed
    found = without_match(facts, plain_held, "k", "code")
    plan = physical(found)
    scan = plan[: plan.index("FileScan")]
    assert "LeftAnti" in plan and "Exchange" not in scan and "Bucketed: true" in plan
    assert sorted(values(found)) == sorted(values(without_match(plain, plain_held, "k", "code")))


def test_buckets_are_one_file_each_and_known_to_a_new_session(spark, bucketed, tmp_path):
    facts, _, _, _, (path, _) = bucketed
    assert len(list((tmp_path / "facts").glob("*.parquet"))) == 6
    forget_bucketed(spark, path, ["k"], 6)
    again = read_bucketed(spark, path, facts.schema, ["k"], 6)
    assert "Exchange" not in physical(one_row_per_key(again, ["k"]))
    assert again.count() == 3000


def test_buckets_grow_with_the_larger_table(spark, tmp_path, monkeypatch):
    assert bucket_count(spark.range(3000), spark.range(10)) == 8
    assert bucket_count(spark.range(10), spark.range(3000), rows=100) == 30
    monkeypatch.setattr(layout, "bucket_count", partial(bucket_count, rows=500))
    found = layout.bucketed_join(spark, "/root/testdata/sf0.001")
    assert "SelectedBucketsCount: 12 out of 12" in physical(found)


def test_a_hot_bucket_is_read_as_a_plain_table(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("x"))
    path = str(tmp_path / "hot")
    write_bucketed(rows, path, ["k"], 16)
    assert "Bucketed: true" in physical(read_bucketed(spark, path, rows.schema, ["k"], 16).groupBy("k").count())
    plain = read_bucketed(spark, path, rows.schema, ["k"], 16, hot_bytes=1000)
    assert "Bucketed" not in physical(plain.groupBy("k").count())
    assert plain.count() == 30_000
    forget_bucketed(spark, path, ["k"], 16)


@pytest.fixture
def partitioned(spark, tmp_path):
    facts = spark.range(4000).select("id", (F.col("id") % 40).cast("int").alias("yr"), (F.col("id") % 5).cast("string").alias("stt"))
    write_table(facts, str(tmp_path / "facts"), ["yr", "stt"])
    years = spark.range(40).select(F.col("id").cast("int").alias("code"), (F.col("id") % 10).alias("decade"))
    write_table(years, str(tmp_path / "years"))
    return read_parquet(spark, str(tmp_path / "facts"), facts.schema), read_parquet(spark, str(tmp_path / "years"), years.schema)


@pytest.mark.parametrize("unique", [False, True])
def test_a_filtered_dimension_prunes_partitions_of_the_fact(partitioned, unique):
    facts, years = partitioned
    joined = star_join(facts, [Link(years.where("decade = 3"), "yr", "code", "year", unique=unique)])
    assert "dynamicpruning" in plan_of(joined)
    assert joined.count() == 400
    joined.collect()
    metrics = scan_metrics(joined, "numPartitions")
    # 4 of 40 years.
    assert metrics == [4]


def scan_metrics(df, name):
    """A metric of all scans of an executed plan."""
    found = []

    def walk(node):
        metrics = node.metrics()
        if node.nodeName().startswith("Scan") and metrics.contains(name):
            found.append(metrics.apply(name).value())
        children = node.children()
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_keys_of_a_large_filtered_dimension_filter_facts_before_the_shuffle(spark, settings, tmp_path):
    facts = spark.range(200_000).select("id", (F.col("id") % 20_000).alias("k"), F.lit("x").alias("text"))
    facts.repartition(4).write.parquet(str(tmp_path / "facts"))
    held = spark.range(20_000).select(F.col("id").alias("code"), (F.col("id") % 50).alias("kind"))
    held.write.parquet(str(tmp_path / "held"))
    facts, held = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "held"))
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    session = build_session(filter_keys_up_to=4000)
    assert session.conf.get(f"{prefix}.applicationSideScanSizeThreshold") == "40000"
    for name in ("enabled", "creationSideThreshold", "applicationSideScanSizeThreshold"):
        value = session.conf.get(f"{prefix}.{name}")
        settings(**{f"{prefix}.{name}".replace(".", "__"): value})
    settings(spark__sql__autoBroadcastJoinThreshold="-1", **{f"{prefix}.creationSideThreshold".replace(".", "__"): "10MB"})
    links = [Link(held.where("kind = 3"), "k", "code", "key")]

    def shuffled(on):
        settings(**{f"{prefix}.enabled".replace(".", "__"): on})
        joined = star_join(facts, links)
        plan = final_plan_of(joined)
        return plan, sorted(values(joined))

    with_filter, rows = shuffled("true")
    without, same = shuffled("false")
    assert "might_contain" in with_filter and "might_contain" not in without
    assert rows == same and len(rows) == 4000


def test_ordered_files_do_not_overlap(spark, tmp_path):
    df = spark.range(20_000).select(F.xxhash64("id").alias("k"), "id")
    path = str(tmp_path / "ordered")
    assert write_ordered(df, path, ["k"], 8, measures={"n": F.count(F.lit(1))}) == {"n": 20_000}
    held = read_parquet(spark, path, df.schema)
    ranges = sorted((low, high, n) for _, low, high, n in values(file_ranges(held, "k")))
    assert len(ranges) == 8 and all(ranges[i][1] < ranges[i + 1][0] for i in range(7))
    assert max(n for *_, n in ranges) < 3 * 20_000 / 8


def test_a_hot_key_fills_several_ordered_files(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 100).cast("int").alias("k"), "id")
    path = str(tmp_path / "ordered")
    write_ordered(df, path, ["k"], 8)
    ranges = sorted((low, high, n) for _, low, high, n in values(file_ranges(read_parquet(spark, path, df.schema), "k")))
    assert all(ranges[i][1] <= ranges[i + 1][0] for i in range(len(ranges) - 1))
    assert sum(low <= 7 <= high for low, high, _ in ranges) >= 4
    assert max(n for *_, n in ranges) < 20_000 / 3


PROFILED = "id long, x double, note string, day date, ok boolean, parts array<int>"


def test_kept_profile_grows_with_the_table(spark, tmp_path):
    path = str(tmp_path / "profile")
    rows = spark.range(5000).select(
        "id",
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 == 1, float("nan")).otherwise(F.col("id") / 2).alias("x"),
        F.concat(F.lit("n"), F.col("id") % 50).alias("note"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("day"),
        (F.col("id") > 1).alias("ok"),
        F.array(F.col("id").cast("int")).alias("parts"),
    )
    for k in range(3):
        keep_profile(rows.where(F.col("id") % 3 == k), path, f"load {k}")
    # A load kept again replaces its state.
    keep_profile(rows.where("id % 3 = 1"), path, "load 1")
    found = {row.column_name: row for row in kept_profile(spark, path).collect()}
    keep_profile(rows, str(tmp_path / "fresh"), "all")
    fresh = {row.column_name: row for row in kept_profile(spark, str(tmp_path / "fresh")).collect()}
    assert list(sorted(found)) == sorted(rows.columns)
    for name, row in found.items():
        for field in ("position", "data_type", "n_rows", "nulls", "low", "high", "low_number", "high_number"):
            assert row[field] == fresh[name][field], (name, field)
    assert found["x"].nulls == 500 and found["x"].low_number == 1.0 and found["x"].high_number == 2499.5
    assert found["day"].low == "2020-01-01" and found["ok"].high == "true" and found["parts"].distinct is None
    assert math.isclose(found["id"].distinct, 5000, rel_tol=0.06) and found["note"].distinct == 50
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(found["id"][name] / 5000 - share) < 0.03
    assert found["note"].p50 is None
    part = {row.column_name: row.n_rows for row in kept_profile(spark, path, ["load 0"]).collect()}
    assert part["id"] == 1667


def test_kept_profile_of_nothing(spark, tmp_path):
    path = str(tmp_path / "profile")
    keep_profile(spark.createDataFrame([], PROFILED), path, "none")
    keep_profile(spark.createDataFrame([(None,) * 6], PROFILED), path, "nulls")
    found = {row.column_name: row for row in kept_profile(spark, path).collect()}
    assert {row.n_rows for row in found.values()} == {1} and {row.nulls for row in found.values()} == {1}
    assert found["x"].p50 is None and found["id"].distinct == 0
