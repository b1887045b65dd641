"""Passages of a benchmark inside documents, by an Aho-Corasick automaton.

Item texts and documents are normalised alike: A-Z in lower case, words of digits, letters and
all non-ASCII characters, one blank between words. Each run of ten consecutive words of an item
is a window (a shorter item is one window), and one automaton of all windows finds their
occurrences in one pass over a document. The place of a hit in the normalised text leads to
word numbers, and these to places in the original.

The windows are broadcast, so their size is checked: a benchmark above ``SLICE_BYTES`` is cut into
slices of items, each with an automaton of its own that passes over the documents in turn.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import ship_package

#: Text of benchmark items in one automaton; it takes up to some hundred times that in a worker.
SLICE_BYTES = 2 << 20

#: What stands in words, in bytes: no ASCII but digits and letters.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def windows_of(items: list[tuple[str, str | None]], size: int = 10) -> dict[str, list[str]]:
    """The items of each window, the window with a blank on either side."""
    found: dict[str, set[str]] = defaultdict(set)
    for item, text in items:
        words = normal_words(text)
        for k in range(max(1, len(words) - size + 1) if words else 0):
            found[f" {b' '.join(words[k : k + size]).decode('latin-1')} "].add(item)
    return {window: sorted(names) for window, names in found.items()}


class Matcher:
    """One automaton. Characters stand for bytes, which is as good and smaller."""

    def __init__(self, windows: dict[str, list[str]]):
        self._automaton = ahocorasick.Automaton()
        for window, names in windows.items():
            self._automaton.add_word(window, (window.count(" ") - 1, tuple(names)))
        if windows:
            self._automaton.make_automaton()
        self._empty = not windows

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words stand in an occurrence of a window, and the items that occur."""
        text = f" {b' '.join(words).decode('latin-1')} "
        hits = [] if self._empty or not words else list(self._automaton.iter(text))
        if not hits:
            return np.zeros(0, bool), set()
        blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(blanks, [end for end, _ in hits])
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, last - [length for _, (length, _) in hits], 1)
        np.add.at(edge, last, -1)
        return np.cumsum(edge[:-1]) > 0, {name for _, (_, names) in hits for name in names}


def original_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of hit words stand in the original text, as byte offsets in UTF-8."""
    spans: list[tuple[int, int]] = []
    joined = False
    for word, inside in zip(_WORD.finditer(text.encode().lower()), hit, strict=True):
        if inside and joined:
            spans[-1] = (spans[-1][0], word.end())
        elif inside:
            spans.append(word.span())
        joined = bool(inside)
    return spans


#: The automata of a Python worker, by the checksum of their windows: built once, not for each task.
_BUILT: dict[str, Matcher] = {}


class _Shared:
    """Broadcast windows with their checksum."""

    def __init__(self, broadcast, name: str):
        self.broadcast, self.name = broadcast, name

    def matcher(self) -> Matcher:
        if self.name not in _BUILT:
            if len(_BUILT) > 1:
                _BUILT.clear()
            _BUILT[self.name] = Matcher(self.broadcast.value)
        return _BUILT[self.name]


_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _scan(shared: list[_Shared]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            words = [normal_words(text) for text in texts]
            hit = [np.zeros(len(w), bool) for w in words]
            items: list[set[str]] = [set() for _ in words]
            for one in shared:
                matcher = one.matcher()
                for k, w in enumerate(words):
                    inside, names = matcher.find(w)
                    if names:
                        hit[k] |= inside
                        items[k] |= names
            spans = [
                [{"begin": a, "end": b} for a, b in original_spans(t, h)] if found else []
                for t, h, found in zip(texts, hit, items, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["passed"]]
                + [pa.array([f(x) for x in column], pa.int64()) for f, column in ((len, words), (np.sum, hit), (len, items))]
                + [pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string())]
                + [pa.array(spans, _SPAN)],
                ["id", "passed", "n_words", "n_hit", "n_items", "items_sha256", "spans"],
            )

    return scan


def benchmark_hits(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    passed: list[str] | None = None,
) -> DataFrame:
    """For each row of ``docs`` its id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``spans``, ``contaminated``.

    ``spans`` are the byte offsets of hit passages in the original text. Columns named in
    ``passed`` come along in a struct of that name. NULL and empty texts
    have no words and no hits; items without words or without id match nothing; repeated rows and
    items change nothing; further columns are ignored; an empty benchmark leaves all clean.
    """
    ship_package(spark)
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text).alias("text"))
    items = items.where(F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-total // SLICE_BYTES))
    shared = []
    for k in range(slices):
        # Equal parts of a text whose size is known, one after another.
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        windows = windows_of([tuple(row) for row in part.collect()], size)
        name = hashlib.sha256(repr(sorted(windows.items())).encode()).hexdigest()
        shared.append(_Shared(spark.sparkContext.broadcast(windows), name))
    along = F.struct(*[F.col(f"`{name}`") for name in passed]) if passed else F.lit(None).cast("struct<none: int>")
    rows = docs.select(F.col(id_column).alias("id"), along.alias("passed"), F.col(text).alias("text"))
    schema = T.StructType([*rows.drop("text").schema.fields])
    for name in ("n_words", "n_hit", "n_items"):
        schema = schema.add(name, "long")
    schema = schema.add("items_sha256", "string").add("spans", T.ArrayType(T.StructType().add("begin", "long").add("end", "long")))
    found = rows.mapInArrow(_scan(shared), schema)
    found = found.withColumnRenamed("id", id_column).withColumn("contaminated", F.col("n_hit") > 0)
    return found if passed else found.drop("passed")
