"""Token counts of whole documents, the huge ones from overlapping chunks.

A huge document is cut into chunks that overlap, so that many tasks encode it. Two neighbours
are spliced at a place in their overlap where both have a token end before a blank, with the
same tokens around it; blanks are known to part tokens, so what stands on either side is
encoded alike in the whole text. An overlap without enough blanks is widened when the text is
cut, and the next chunk starts at its end, so that a run without blanks is encoded once. Where
neighbours still share no such place, the document is cut again with longer chunks and wider
overlaps, in the end so long that one chunk holds it all. Each turn encodes little more than the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import byte_count, saved, ship_package
from starloom.llm.tokens import encoder

BLANKS = frozenset(" \t\n\r\x0b\x0c")
#: How many tokens on each side of a place both chunks must have in common.
AGREE = 3
#: Words that an overlap has to hold: one more than a splice takes, and one cut at either end.
WORDS = 2 * AGREE + 3
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")

EDGE = pa.struct([("at", pa.int64()), ("around", pa.int64()), ("before", pa.int64())])
ENCODED = pa.schema(
    [("row", pa.int64()), ("chunk", pa.int64()), ("tokens", pa.int64()), ("last", pa.bool_())]
    + [("left", pa.list_(EDGE)), ("right", pa.list_(EDGE))]
)
EDGES = "array<struct<at long, around long, before long>>"


def safe_edges(text: str, start: int, ids: list[int], offsets: list[tuple[int, int]], low: int, high: int) -> list[dict]:
    """The token ends before blanks between two places of a chunk, with what stands around them."""
    edges = []
    for k in range(AGREE - 1, len(ids) - AGREE):
        end = offsets[k][1]
        if low <= end < high and end < len(text) and text[end] in BLANKS and offsets[k + 1][0] > end:
            around = repr(ids[k + 1 - AGREE : k + 1 + AGREE])
            edges.append({"at": start + end, "around": xxhash.xxh64_intdigest(around) >> 1, "before": k + 1})
    return edges


def chunks_of(text: str, chunk_chars: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """Where each chunk starts, where its overlap with the next begins, and where it ends.

    The overlap is the last ``overlap`` characters of a chunk, which is made longer until these
    hold ``WORDS`` words; the next chunk starts with them. The last one ends with the text.
    """
    start = 0
    while True:
        end = start + chunk_chars + overlap
        while end < len(text) and sum(1 for _ in _WORD.finditer(text, end - overlap, end)) < WORDS:
            end += overlap
        if end >= len(text):
            yield start, len(text), len(text)
            return
        yield start, end - overlap, end
        start = end - overlap


def _cut(chunk_chars: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch["row"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for chunk, (start, shared, end) in enumerate(chunks_of(text, chunk_chars, overlap)):
                    yield pa.RecordBatch.from_pydict(
                        {"row": [row], "chunk": [chunk], "start": [start], "shared": [shared - start]}
                        | {"last": [end == len(text)], "piece": [text[start:end]]}
                    )

    return cut


def _encode(name: str, overlap: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(name).tokenizer
        for batch in batches:
            for row in batch.to_pylist():
                text, start = row["piece"], row["start"]
                found = tokenizer.encode(text, add_special_tokens=False)
                ids, offsets = found.ids, found.offsets
                left = safe_edges(text, start, ids, offsets, 0, overlap) if row["chunk"] else []
                right = [] if row["last"] else safe_edges(text, start, ids, offsets, row["shared"], len(text))
                out = {"row": row["row"], "chunk": row["chunk"], "tokens": len(ids), "last": row["last"]}
                yield pa.RecordBatch.from_pylist([out | {"left": left, "right": right}], ENCODED)

    return encode


def _count(name: str, over: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(name)
        for batch in batches:
            counts = [len(words.encode(text)) // words.width for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n_bytes"], pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    return count


def token_counts(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text: str = "text",
    chunk_chars: int = 32_768,
    overlap: int = 512,
) -> DataFrame:
    """Id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of each row.

    NULL and empty texts have 0 bytes and 0 tokens; each row counts, with a NULL or a repeated
    id too; further columns are ignored; no rows give no rows. Very long texts are encoded in
    chunks of about ``chunk_chars`` characters, runs without blanks in one piece each. If the tokenizer's settings don't
    prove that blanks part tokens, every document is encoded in one piece.
    """
    ship_package(spark)
    value = F.col(text)
    rows = docs.select(F.col(id_column).alias("id"), byte_count(value).alias("n_bytes"), value.alias("text"))
    huge = F.coalesce(F.length("text") > chunk_chars + overlap, F.lit(False)) & F.lit(encoder(tokenizer).by_word)
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"id {id_type}, n_bytes long, n_tokens long"
    counted = rows.where(~huge).mapInArrow(_count(tokenizer, limit), schema)
    waiting = saved(spark, rows.where(huge).withColumn("row", F.monotonically_increasing_id()), "huge-texts")
    while not waiting.isEmpty():
        chunks = waiting.select("row", "text").mapInArrow(
            _cut(chunk_chars, overlap), "row long, chunk long, start long, shared long, last boolean, piece string"
        )
        encoded = chunks.repartition("row", "chunk").mapInArrow(
            _encode(tokenizer, overlap),
            f"row long, chunk long, tokens long, last boolean, left {EDGES}, right {EDGES}",
        )
        encoded = saved(spark, encoded, "huge-chunks")
        following = encoded.select("row", (F.col("chunk") - 1).alias("chunk"), F.col("left").alias("next"))
        place = lambda edges: F.transform(edges, lambda e: F.struct(e["at"], e["around"]))
        before = lambda edges: F.get(F.filter(edges, lambda e: e["at"] == F.col("shared.at")), F.lit(0))["before"]
        spliced = (
            encoded.where(~F.col("last"))
            .join(following, ["row", "chunk"])
            .withColumn("shared", F.try_element_at(F.array_intersect(place("right"), place("next")), F.lit(1)))
            .select("row", (before("right") - before("next")).alias("tokens"))
        )
        ends = encoded.where("last").select("row", "tokens")
        summed = ends.unionByName(spliced).groupBy("row").agg(
            F.sum("tokens").alias("n_tokens"), F.count_if(F.col("tokens").isNull()).alias("open")
        )
        summed = saved(spark, summed, "huge-sums")
        done = waiting.join(summed.where("open = 0"), "row").select("id", "n_bytes", "n_tokens")
        counted = counted.unionByName(done)
        waiting = saved(spark, waiting.join(summed.where("open > 0").select("row"), "row", "left_semi"), "huge-texts")
        overlap, chunk_chars = 4 * overlap, max(chunk_chars, 16 * overlap)
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
