"""Spelling variants against brute force over all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from starloom.llm.spelling import follow, near_words, spelling_variants

SCHEMA = "doc_id long, text string, word string, n long, key string, form int"


def near(a, b):
    """Exactly one edit apart, by trying all."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(docs):
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-words[v], [ord(c) for c in v]), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(around[w]), form[w] and words[form[w]]) for w, n in words.items())


def as_text(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def docs():
    draw = random.Random(2)
    base = ["".join(draw.choices("abcé", k=draw.randint(6, 11))) for _ in range(30)]
    rows = []
    for k in range(400):
        words = draw.choices(base, weights=[2**-i + 0.001 for i in range(30)], k=60)
        for i, word in enumerate(words):
            at = draw.randrange(len(word))
            if draw.random() < 0.2:
                words[i] = draw.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "É" + word[at + 1 :]])
            words[i] = words[i].title() if draw.random() < 0.3 else words[i]
        rows.append((k if k % 50 else None, draw.choice([" ", ", ", "1", "_"]).join(words)))
    rows += [(7, None), (8, ""), (9, "Ābcdefgh Ābcdefgh"), (10, "q" * 50_000 + " " + "q" * 50_001), rows[3], rows[3]]
    return [*rows, (11, "q" * 50_000 + " " + "q" * 50_001)]


@pytest.mark.parametrize("most_pairs", [20_000, 3])
def test_against_all_pairs(spark, docs, most_pairs):
    df = spark.createDataFrame([(*row, "clash", 1, "k", 2) for row in docs], SCHEMA)
    found = spelling_variants(spark, df, most_pairs=most_pairs)
    assert found.dtypes == [
        ("word", "string"),
        ("form", "string"),
        ("root", "string"),
        ("n", "bigint"),
        ("n_near", "bigint"),
        ("form_n", "bigint"),
    ]
    wanted = expected(docs)
    assert any(row[1] for row in wanted) and any(row[2] != row[1] for row in wanted if row[1])
    assert as_text(map(tuple, found.collect())) == as_text(wanted)


@pytest.mark.parametrize("most_pairs", [20_000, 1])
def test_every_single_edit_is_found(spark, most_pairs):
    """All words over two letters of seven and eight characters: every kind of edit at every place."""
    words = ["".join(w) for k in (7, 8) for w in itertools.product("ab", repeat=k)]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [frozenset((r.a, r.b)) for r in near_words(spark, df, most_pairs=most_pairs).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {frozenset(p) for p in itertools.combinations(words, 2) if near(*p)}


def test_long_ways(spark):
    df = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)], "word string, form string")
    assert {r.root for r in follow(spark, df).collect()} == {"w37"}


def test_no_words(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert spelling_variants(spark, df).count() == 0
    assert spelling_variants(spark, df.limit(0)).count() == 0
