"""Chunks of huge texts: spliced counts against the library, and how much is encoded for them."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm.token_counts import chunks_of, token_counts


def texts():
    draw = random.Random(5)
    words = " ".join("w" * draw.randint(1, 9) + str(draw.randint(0, 999)) for _ in range(4000))
    yield words
    yield "x" * 60_000
    yield words[:9000] + "é" * 30_000 + words[9000:]
    yield "a " + "b" * 5000 + " " + "c d " * 3000
    yield " " * 40_000 + "end"
    yield "\n".join("=" * draw.randint(1, 3000) for _ in range(30))


@pytest.mark.parametrize(("chunk", "overlap"), [(1000, 60), (4000, 200)])
def test_little_more_than_the_text_is_encoded(chunk, overlap):
    for text in texts():
        found = list(chunks_of(text, chunk, overlap))
        assert found[0][0] == 0 and found[-1][2] == len(text)
        assert all(a[1] == b[0] and a[2] - a[1] == overlap for a, b in zip(found, found[1:], strict=False))
        assert sum(end - start for start, _, end in found) <= len(text) * (1 + overlap / chunk) + chunk


def test_chunk_of_an_unbroken_text():
    assert list(chunks_of("x" * 10_000_000, 32_768, 512)) == [(0, 10_000_000, 10_000_000)]


def test_counts_of_huge_texts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts(spark, df, "word_bpe_49k.json", chunk_chars=1000, overlap=60).collect()}
    assert found == {k: len(library.encode(text, add_special_tokens=False).ids) for k, text in rows}
