"""What Spark is asked to do, rather than what comes out."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators.aggregates import fanout_count
from starloom.operators.duplicates import one_row_per_key
from starloom.operators.joins import Link, star_join, without_match
from starloom.plans.facts import clean_fact_source
from starloom.queries import QUERIES
from tests.conftest import final_plan_of, plan_of, values

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")
# These write before they read, which is tested elsewhere.
WRITING = {name for name in QUERIES if name.endswith("_roundtrip")} | {
    "star_schema_run",
    "star_schema_fact",
    "build_lookup",
    "inferred_scan",
    "written_counts",
    "landed_rejects",
    "refreshed_partitions",
    "kept_profile",
}


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"PythonUDF|EvalPython|InPandas|InArrow|CartesianProduct|NestedLoopJoin", plan)


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["star_semi"](spark, SF))
    assert "EqualTo(p_type,ECONOMY)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    # The filter on the country stands below the removal of copies.
    filtered = plan_of(QUERIES["build_dimension"](spark, SF))
    assert "GreaterThan(p_size,5)" in filtered


def before_first_shuffle(plan):
    """The part of a physical plan that runs before anything is shuffled."""
    physical = plan[plan.index("== Physical Plan ==") :]
    return physical[physical.rindex("Exchange hashpartitioning") :]


def test_one_row_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "partial_min" in before_first_shuffle(plan_of(one_row_per_key(df, ["k"])))


def test_anti_join_reduces_the_dimension_before_the_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    new, held = spark.range(10), spark.range(100).select((F.col("id") % 3).alias("k"), F.rand().alias("x"))
    plan = plan_of(without_match(new, held, "id", "k"))
    assert "LeftAnti" in plan
    assert "HashAggregate(keys=[held" in before_first_shuffle(plan)


def test_fanout_counts_before_it_joins(spark):
    fact = spark.range(100).select((F.col("id") % 3).alias("k"))
    held = spark.range(100).select((F.col("id") % 3).alias("d"), F.col("id").cast("string").alias("g"))
    plan = plan_of(fanout_count(fact, held, "k", "d", ["g"], "g"))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("partial_count") == 2


@pytest.fixture
def hot(spark, tmp_path):
    """A fact table of which a third has one key, and its dimension, as files."""
    fact = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"), F.rand(3).alias("x")
    )
    fact.repartition(12).write.parquet(str(tmp_path / "fact"))
    spark.range(5000).select(F.col("id").alias("code")).write.parquet(str(tmp_path / "dim"))
    return spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dim"))


def joined(hot, unique):
    fact, dimension = hot
    return star_join(fact, [Link(dimension, "k", "code", "key")], {"id": "id", "key": "key"}, unique)


@pytest.mark.parametrize("unique", [False, True])
def test_dimensions_are_broadcast_by_size_only(hot, settings, unique):
    assert "BroadcastHashJoin" in plan_of(joined(hot, unique))
    small = sorted(values(joined(hot, unique)))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(joined(hot, unique))
    assert "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in plan
    assert sorted(values(joined(hot, unique))) == small
    assert len(small) == 60_000


@pytest.fixture
def splitting(settings):
    """No broadcasts, and thresholds at which a few thousand rows count as a hot key."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1000",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


@pytest.mark.parametrize("unique", [False, True])
def test_a_hot_key_is_split_over_tasks(hot, splitting, unique):
    df = joined(hot, unique)
    assert "skew=true" in final_plan_of(df)
    assert df.count() == 60_000


@pytest.mark.parametrize("hot_key", ["7", "NULL"])
def test_a_hot_key_of_the_candidates_is_split_in_the_anti_join(hot, splitting, hot_key):
    fact, dimension = hot
    fact = fact.withColumn("k", F.expr(f"if(id % 3 = 0, {hot_key}, k)"))
    df = without_match(fact, dimension.where("code > 100"), "k", "code")
    plan = final_plan_of(df)
    assert "LeftAnti" in plan
    assert "skew=true" in plan
    assert df.count() == fact.where("k <= 100 OR k IS NULL").count()


def test_a_hot_key_of_the_dimension_is_split_in_the_fanout(hot, splitting):
    fact, _ = hot
    members = fact.select(F.col("k").alias("d"), F.col("id").cast("string").alias("g"))
    df = fanout_count(fact, members, "k", "d", ["g"], "g")
    assert "skew=true" in final_plan_of(df)
    assert df.agg(F.sum("n")).first()[0] == fact.groupBy("k").count().agg(F.sum(F.col("count") ** 2)).first()[0]


def test_an_analysis_of_cleaned_arrivals_reads_one_column(spark, tmp_path):
    names = [f"s{i}" for i in range(9)]
    spark.range(5).select("id", *(F.lit("a").alias(name) for name in names)).write.parquet(str(tmp_path / "t"))
    cleaned = clean_fact_source(spark.read.parquet(str(tmp_path / "t")))
    assert "ReadSchema: struct<s3:string>" in plan_of(cleaned.groupBy("s3").count())
