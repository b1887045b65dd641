"""Stages of the pipeline on rows with NULL and repeated ids."""

import collections

import corpus_pipeline
from starloom.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, lang string"
LONG = " ".join(f"w{k}" for k in range(60))
NEAR = LONG + " more"


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rows = [(None, LONG), (None, LONG), (None, NEAR), (None, "alone null"), (None, None), (3, "b c"), (2, "b c"), (2, "own text")]
    rows += [(5, "x y"), (5, "x y"), (6, None), (6, None), (9, "z z z"), (None, "z z z"), (2, "x y")]
    table = spark.createDataFrame([(*row, "s", "en") for row in rows], SCHEMA)
    left = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, table, "").collect())
    linked = [n for (k, t), n in left.items() if t in (LONG, NEAR)]
    assert linked == [1]
    rest = {key: n for key, n in left.items() if key[1] not in (LONG, NEAR)}
    expected = [(None, "alone null"), (None, None), (2, "b c"), (2, "own text"), (2, "x y"), (6, None), (9, "z z z")]
    assert rest == dict.fromkeys(expected, 1)


def test_mixing_counts_rows_not_ids(spark):
    # Sources a, b and c have weights 1, 2 and 3 and 1,000 words each, all rows without an id.
    rows = [(None, f"{source} {k} " + "x " * 8, source, "en") for source in "abc" for k in range(100)]
    rows += [(7, f"{source} same {k} " + "x " * 7, source, "en") for source in "abc" for k in range(10)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = collections.Counter()
    for r in corpus_pipeline.mixing(spark, table, "").collect():
        got[r.source] += len(r.text.split())
    targets = {r.source: r.target for r in mix(spark, table).select("source", "target").distinct().collect()}
    assert all(abs(got[s] - target) <= 10 for s, target in targets.items())


def test_run(spark, tmp_path):
    rows = [(None if k % 3 == 0 else k, f"{k} " + " ".join(f"v{k}x{j}" for j in range(20)), "ab"[k % 2], "en") for k in range(40)]
    spark.createDataFrame([*rows, *rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = [(1, " ".join(f"v4x{j}" for j in range(12)))]
    spark.createDataFrame(item, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plan = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 4 not in {r.doc_id for r in plan} and len(plan) <= 3 * 39
    assert sum(r.doc_id is None for r in plan) <= 3 * 14
