"""Inverted files of pivots against plain footrule distances, and the search against all products."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import permutation_index
from starloom.llm.permutation_index import closeness, inverted_files, nearest, nearest_pivots

SCHEMA = "vec_id long, embedding array<double>, id long, block int, score double"


def table_of(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, 3.0) for k, v in rows], SCHEMA)


def found_by_query(df):
    found = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def test_files_give_the_footrule():
    rng = np.random.default_rng(1)
    pivots, vectors, most = rng.normal(size=(30, 6)), rng.normal(size=(200, 6)), 7
    seen = nearest_pivots(vectors, pivots, most)
    files = inverted_files(seen, len(pivots))
    place = np.full((200, 30), most)
    np.put_along_axis(place, seen, np.arange(most)[None, :], axis=1)
    for q in range(20):
        footrule = np.abs(place - place[q]).sum(1)
        greatest = 2 * sum(range(1, most + 1))
        assert (closeness(seen[q], *files, 200, most) == greatest - footrule).all()


@pytest.mark.parametrize("block", [8192, 150])
def test_recall_over_blocks(spark, monkeypatch, block):
    # The workers get the size in the closure of the index, so that the driver's value holds.
    monkeypatch.setattr(permutation_index, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.4 * rng.normal(size=16)).tolist()) for k in range(900)]
    found = found_by_query(nearest(spark, table_of(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, k=10, part=0.3, least=40))
    everything = np.array([v for _, v in rows])
    hits = 0
    for q in range(0, 900, 20):
        scores = everything @ everything[q]
        order = [int(k) for k in np.argsort(-scores, kind="stable") if k != q][:10]
        hits += len(set(order) & {k for k, _ in found[q]})
        assert np.allclose([s for _, s in found[q]], [scores[k] for k, _ in found[q]])
    assert len(found) == 45 and hits >= 0.9 * 450


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5]), (2, [2.0, 1.0, -0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    rows += [(40, None), (60, []), (80, [0.0]), (100, [float("nan")]), (120, [1.0, None]), (140, [float("inf")]), (None, [1.0])]
    found = found_by_query(nearest(spark, table_of(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == {
        0: [(2, 2.0), (3, 1.0), (3, 1.0), (20, 1.0), (1, 0.5)],
        20: [(2, 2.0), (0, 1.0), (3, 1.0), (3, 1.0), (1, 0.5)],
    }


def test_one_long_vector_keeps_the_others(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(50)] + [(1001, rng.normal(size=9).tolist())]
    found = found_by_query(nearest(spark, table_of(spark, rows), F.col("vec_id") % 20 == 0, k=50))
    assert {q: len(x) for q, x in found.items()} == {0: 50, 20: 50, 40: 50}


def test_copies_of_a_third(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(400)] + [(1001 + k, [2.0] * 8) for k in range(200)]
    found = found_by_query(nearest(spark, table_of(spark, [*rows, (2000, [1.0] * 8)]), F.col("vec_id") == 2000, k=20))
    assert [k for k, _ in found[2000]] == [1001 + k for k in range(20)]


def test_nothing_and_single_rows(spark):
    one = table_of(spark, [(0, [1.0])])
    assert nearest(spark, one, F.lit(True)).count() == 0 and nearest(spark, one.limit(0), F.lit(True)).count() == 0
    assert nearest(spark, table_of(spark, [(0, None)]), F.lit(True)).count() == 0
