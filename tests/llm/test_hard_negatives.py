"""Hard negatives against plain loops over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives as module
from starloom.llm.hard_negatives import Heaps, hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<double>, label int, row long, id string, extra long"


@pytest.mark.parametrize("shape", [(1, 1, 1), (2, 64, 3), (33, 17, 65), (64, 64, 64), (100, 7, 130), (0, 4, 5)])
def test_strassen(shape):
    rows, inner, columns = shape
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**62), 2**62, (rows, inner))
    b = rng.integers(-(2**62), 2**62, (inner, columns))
    # Both sides modulo 2**64.
    assert (strassen(a, b, leaf=2) == a @ b).all()


def test_heaps_merge_in_any_order():
    draw = random.Random(3)
    entries = [(draw.randrange(6), k // 2, k) for k in range(60)]
    heaps = Heaps(1, 7)
    draw.shuffle(entries)
    for k in range(0, 60, 9):
        scores, ids, rows = (np.array(x) for x in zip(*entries[k : k + 9], strict=True))
        heaps.merge(scores[None, :], ids, rows, np.ones((1, len(ids)), bool))
    _, ids, rows, scores = heaps.entries()
    best = sorted(entries, key=lambda e: (-e[0], e[1], e[2]))[:7]
    assert list(zip(scores.tolist(), ids.tolist(), rows.tolist(), strict=True)) == best


def expected(rows):
    fit = [
        (n, i, label, [math.floor(256 * x) for x in v])
        for n, (i, v, label, *_) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for n, anchor, label, v in fit:
        if anchor % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, m, other) for m, i, other, w in fit if m != n)
        for score, positive, _, _ in [s for s in scored if s[3] == label][:5]:
            window = [s for s in scored if s[3] != label and 80 * -score <= 100 * -s[0] <= 100 * -score]
            found += [(anchor, positive, k + 1, s[1], -score, -s[0]) for k, s in enumerate(window[:5])]
    return sorted(found)


def table():
    draw = random.Random(11)
    some = [[draw.gauss(0.2, 0.5) for _ in range(6)] for _ in range(60)]
    rows = [(k, some[k % 60], draw.choice([0, 0, 0, 1, 2]), 1, "x", 2) for k in range(150)]
    odd = [
        (200, None, 1, None, None, None),
        (201, [1.0, None], 1, 1, "x", 1),
        (202, [float("nan")], 1, 1, "x", 1),
        (203, [float("inf"), 1.0], 1, 1, "x", 1),
        (210, [0.5] * 6, None, 1, "x", 1),
        (None, [0.5] * 6, 1, 1, "x", 1),
        (220, [], 1, 1, "x", 1),
        (230, [0.9, 0.9], 0, 1, "x", 1),
        (240, [0.5] * 9, 2, 1, "x", 1),
    ]
    return [*rows, *odd, rows[20], rows[33], rows[33]]


@pytest.mark.parametrize("small", [False, True])
def test_against_loops(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(module, "TILE", 7)
        monkeypatch.setattr(module, "SLICE_BYTES", 600)
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives(spark, df, F.col("vec_id") % 10 == 0)
    assert found.dtypes == [
        (name, "int" if name == "rank" else "bigint")
        for name in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    ]
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_few_rows(spark):
    df = spark.createDataFrame(table()[:3], SCHEMA)
    assert hard_negatives(spark, df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(spark, df.where("vec_id = 0"), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(spark, df, F.lit(None).cast("boolean")).count() == 0


def test_scores_that_do_not_fit(spark):
    df = spark.createDataFrame([(0, [1e12], 1, 1, "x", 1)], SCHEMA)
    with pytest.raises(ValueError):
        hard_negatives(spark, df, F.col("vec_id") % 10 == 0)
