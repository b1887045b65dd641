"""The dealt operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import read_table
from starloom.llm.decontamination import benchmark_hits
from starloom.llm.hard_negatives import hard_negatives
from starloom.llm.hpylm import score_texts
from starloom.llm.jaccard import jaccard_components
from starloom.llm.licenses import license_scan
from starloom.llm.mixing import mix
from starloom.llm.permutation_index import nearest
from starloom.llm.quality import resample
from starloom.llm.sharding import minimax_shards
from starloom.llm.spelling import spelling_variants
from starloom.llm.token_counts import token_counts
from starloom.llm.token_files import read_digests, write_ids
from starloom.llm.url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mix(spark, read_table(spark, sf_dir, "documents"))
    first = lambda name: F.first(name).alias(name)  # noqa: E731  the same in all pieces of a document
    return pieces.groupBy("row_index").agg(
        first("doc_id"),
        first("size"),
        first("source_size"),
        first("target"),
        F.sum("words").alias("taken"),
        F.count_distinct("shard").alias("n_shards"),
    ).drop("row_index")


@query
def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = minimax_shards(spark, read_table(spark, sf_dir, "documents"), shards=40)
    return plan.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


TOKENIZER = "word_bpe_49k.json"


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_digests(write_ids(spark, read_table(spark, sf_dir, "documents"), TOKENIZER, end_id=1))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return benchmark_hits(spark, docs, benchmark).drop("spans")


@query
def op10_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return resample(spark, docs, labels, columns=["doc_id"])


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, read_table(spark, sf_dir, "documents"))


@query
def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark, read_table(spark, sf_dir, "documents"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: source, language and thousand stand for directories.

    Every 50th document stands for a licence file of its directory.
    """
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return license_scan(spark, read_table(spark, sf_dir, "documents"), path, F.col("doc_id") % 50 == 0)


#: The rules of the query.
URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


@query
def op13_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in URL_RULES]))
    )
    found = filter_urls(spark, read_table(spark, sf_dir, "pages"), rules)
    return found.select("passed.page_id", "host", "path", "rule", "verdict")


ORACLES["op13_url_cascade"] = """
    WITH parts AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    addresses AS (
        SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
               translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
    judged AS (
        SELECT page_id, host, path, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM addresses)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
    """


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op12_hard_negatives"] = """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
         AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
    """


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, read_table(spark, sf_dir, "documents"))
