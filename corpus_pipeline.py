"""A corpus from raw documents to shards, in five stages, each by one operator of ``starloom.llm``.

Every stage gets what the one before has left, reads it whole and returns the columns of
documents; the last returns the plan of shards. As its input has been written by then, each stage
first removes the tables that earlier ones kept between their steps. Where rows have to be told apart, a stage numbers
them, as ids may be NULL or repeated: rows that repeat an id together with its text are one document
after the second stage, whatever the id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import SAVED, read_table, remove_tables
from starloom.llm.decisions import applied, numbered
from starloom.llm.decontamination import benchmark_hits
from starloom.llm.jaccard import jaccard_components
from starloom.llm.mixing import mix, mixed_copies
from starloom.llm.quality import resample
from starloom.llm.sharding import minimax_shards
from starloom.session import scratch_path

SHARDS = 40

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What the stage before has kept between its steps.
_LEFT: list[str] = []


def _stage(run: Stage) -> Stage:
    """A stage that first removes what the one before has kept: its result has been written by then."""

    @wraps(run)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_tables(spark, _LEFT)
        _LEFT.clear()
        start = len(SAVED)
        found = run(spark, docs, sf_dir)
        # The result of the last stage is for the caller to write, whenever that may be.
        if run.__name__ != STAGES[-1][0]:
            _LEFT.extend(SAVED[start:])
        return found

    return stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the resampling draws; junk and toxic ones go."""
    return resample(spark, docs, read_table(spark, sf_dir, "labels")).select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by similar word 5-grams, the one with the smallest id, a NULL id being the largest.

    Rows without words link with nothing; of those that repeat an id with its text one is left.
    """
    rows = numbered(spark, docs)
    found = jaccard_components(spark, rows, id_column="_row")
    named = rows.select("_row", "doc_id", F.xxhash64("text").alias("text")).join(found, "_row")
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = [F.when(~wordless, F.col("component_id")), F.when(wordless, F.col("doc_id")), F.when(wordless, F.col("text"))]
    first = named.groupBy(*[column.alias(f"_{k}") for k, column in enumerate(group)]).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    )
    return applied(spark, rows, first.select("first._row", F.lit(1).alias("copies")))


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    hits = benchmark_hits(spark, docs, read_table(spark, sf_dir, "benchmark"), passed=docs.columns)
    return hits.where("NOT contaminated").select("passed.*")


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix of sources takes them: a document may recur or drop out."""
    rows = numbered(spark, docs)
    return applied(spark, rows, mixed_copies(mix(spark, rows, key="_row"), "_row"))


@_stage
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row."""
    return minimax_shards(spark, docs, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The stages are not all expressible in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
