"""What the model's query says beside the score, against a plain count, over one block and many."""

import collections
import math
import zlib

import numpy as np
import pytest

from starloom.llm import hpylm
from starloom.llm.hpylm import score_texts


def corpus():
    rng = np.random.default_rng(8)
    words = [f"Word{k}" for k in range(400)]
    chance = 1 / np.arange(1, 401)
    texts = [" ".join(rng.choice(words, rng.integers(1, 60), p=chance / chance.sum())) for _ in range(300)]
    return [*enumerate(texts), (300, None), (301, ""), (302, "never\tseen  before"), (303, " ".join(words * 40))]


@pytest.mark.parametrize("part_bytes", [8 << 20, 3000])
def test_base_scores(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(hpylm, "PART_BYTES", part_bytes)
    rows = corpus()
    tokens = {k: [*(text or "").lower().split(), None] for k, text in rows}
    held = {k for k in tokens if zlib.crc32(str(k).encode()) % 10 == 0}
    counts = collections.Counter(t for k, some in tokens.items() if k not in held for t in some)
    total, kinds = sum(counts.values()), len(counts)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in score_texts(spark, df).collect()}
    assert set(found) == set(tokens)
    for k, some in tokens.items():
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in some)
        r = found[k]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (k in held, len(some), total)
        assert r.n_known == sum(counts[t] > 0 for t in some)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_scores_of_held_out_texts_are_no_worse_than_the_base(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    found = {r.doc_id: r for r in score_texts(spark, df).collect()}
    held = [r for r in found.values() if r.held_out and r.n_tokens > 5]
    assert held and sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)


def once_only():
    """Texts whose pairs of training tokens are all different, so that every pair has one table whatever is drawn."""
    rng, seen, rows = np.random.default_rng(3), set(), [(1000, None), (1001, "w1 unseen w2"), (1002, "w3 w4 w3 w4 w3")]
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 60, rng.integers(1, 8))]
        pairs = list(zip([None, *words], [*words, None], strict=True))
        held = zlib.crc32(str(k).encode()) % 10 == 0
        if held or (len(set(pairs)) == len(pairs) and not seen & set(pairs)):
            rows.append((k, " ".join(words)))
            seen |= set() if held else set(pairs)
    return [(k, t) for k, t in rows if k < 1000 or zlib.crc32(str(k).encode()) % 10 == 0 or t is None]


@pytest.mark.parametrize("part_bytes", [8 << 20, 100])
def test_scores_are_those_of_a_plain_model(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(hpylm, "PART_BYTES", part_bytes)
    rows = once_only()
    tokens = {k: [*(text or "").split(), None] for k, text in rows}
    pairs = {k: list(zip([None, *some[:-1]], some, strict=True)) for k, some in tokens.items()}
    trained = [p for k, some in pairs.items() if zlib.crc32(str(k).encode()) % 10 for p in some]
    assert len(trained) > 100 and len(set(trained)) == len(trained)
    after, at_parent = collections.Counter(u for u, _ in trained), collections.Counter(w for _, w in trained)

    def chance(u, w):
        n, everyone = at_parent[w], len(trained)
        base = ((n - hpylm.D0) if n else (hpylm.S0 + hpylm.D0 * len(at_parent))) / (hpylm.S0 + everyone)
        own = 1 - hpylm.D if (u, w) in known else 0
        return (own + (hpylm.S + hpylm.D * after[u]) * base) / (hpylm.S + after[u])

    known = set(trained)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.score for r in score_texts(spark, df).collect()}
    for k, some in pairs.items():
        assert math.isclose(found[k], sum(math.log10(chance(*p)) for p in some), rel_tol=1e-9)


def test_contexts_are_words_however_many(spark):
    """5,000 words that are each followed by a word of their own: after the first, the second is next to certain."""
    rows = [(k, f"a{k % 5000} b{k % 5000}") for k in range(40_000)]
    found = score_texts(spark, spark.createDataFrame(rows, "doc_id long, text string")).where("held_out")
    tokens = [r.score / 3 for r in found.collect()]
    # One of 5,000 at the start; the two tokens after it are foreseen in part.
    assert np.mean(tokens) > -2.0
