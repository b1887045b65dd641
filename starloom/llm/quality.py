"""Importance resampling by hashed n-gram models of good text and of all text.

Two generative models over hashed features are counted: one over all documents, one over those
that labels call good. Features are the words of a document and the 4-grams of its word shapes
(letters, digits and marks, runs shortened, a repeated word as ``=``), each once for a document.
A document's score is the logarithm of the ratio of its probabilities under the two models;
Gumbel noise is added and the highest documents are drawn, as many as the labels let expect.

A ratio counts where the two models differ by more than chance; else thousands of rare words
would drown the few that matter, and long documents would do worse than short ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package, uniform

#: Buckets of each kind of feature, and how many go into one row between tasks.
BUCKETS, BLOCK = 1 << 18, 1 << 12
_SHIFT = np.uint64(64 - 18)

_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def features(text: str | None) -> np.ndarray:
    """The distinct buckets of a document: words below ``BUCKETS``, shapes above."""
    raw = (text or "").encode()
    words = [word.strip(_MARKS) for word in raw.lower().split()]
    shapes = _RUN.sub(rb"\1", raw.translate(_SHAPE)).split()
    for k in range(1, len(words)):
        if words[k] == words[k - 1]:
            shapes[k] = b"="
    grams = set(zip(shapes, shapes[1:], shapes[2:], shapes[3:], strict=False)) or {tuple(shapes)}
    kinds = set(words) - {b""}, {b" ".join(gram) for gram in grams}
    hashed = [np.fromiter(map(xxhash.xxh3_64_intdigest, kind), np.uint64, len(kind)) >> _SHIFT for kind in kinds]
    return np.unique(np.concatenate([hashed[0], hashed[1] + np.uint64(BUCKETS)])).astype(np.int64)


_COUNTS = pa.schema([("block", pa.int32()), ("everything", pa.binary()), ("good", pa.binary())])


def _blocks(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for block, both in counts.items():
        row = {"block": block, "everything": both[0].tobytes(), "good": both[1].tobytes()}
        yield pa.RecordBatch.from_pylist([row], _COUNTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The document counts of a task, block by block."""
    counts = np.zeros((2, 2 * BUCKETS), np.int64)
    for batch in batches:
        for text, good in zip(batch["text"].to_pylist(), batch["good"].to_pylist(), strict=True):
            found = features(text)
            counts[0, found] += 1
            if good:
                counts[1, found] += 1
    yield from _blocks(
        {k: counts[:, k * BLOCK : (k + 1) * BLOCK] for k in range(2 * BUCKETS // BLOCK) if counts[0, k * BLOCK : (k + 1) * BLOCK].any()}
    )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums blocks as they come; there are never more than the model has."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            both = np.stack([np.frombuffer(row[name], np.int64) for name in ("everything", "good")])
            if row["block"] in sums:
                sums[row["block"]] += both
            else:
                sums[row["block"]] = both.copy()
    yield from _blocks(sums)


def fit_ratios(
    spark: SparkSession, flagged: DataFrame, prior: float = 1.0, significant: float = 3.0
) -> np.ndarray:
    """The logarithm of the ratio for each bucket, from documents with ``text`` and a flag ``good``.

    ``prior`` documents as in the whole are added to each bucket of the good ones. A ratio is 0
    unless the good count is ``significant`` standard deviations from what the whole lets expect.
    """
    schema = "block int, everything binary, good binary"
    counts = flagged.select("text", "good").mapInArrow(_count, schema)
    salted = counts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    partial = salted.repartition("block", "salt").select("block", "everything", "good").mapInArrow(_add, schema)
    total = np.zeros((2, 2 * BUCKETS))
    for row in partial.repartition("block").mapInArrow(_add, schema).collect():  # the size of the model
        for k, name in enumerate(("everything", "good")):
            at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
            total[k, at] += np.frombuffer(row[name], np.int64)
    ratios = np.zeros(2 * BUCKETS, np.float32)
    for kind in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        everything, good = total[0, kind], total[1, kind]
        if not good.sum():
            continue
        expected = everything * good.sum() / everything.sum()
        ratio = np.log((good + prior) / (expected + prior))
        # Bad text takes part of the whole, so the usual ratio is above 0; it becomes 0.
        order = np.argsort(ratio, kind="stable")
        mass = np.cumsum(good[order])
        expected *= np.exp(ratio[order][np.searchsorted(mass, mass[-1] / 2)])
        ratio = np.log((good + prior) / (expected + prior))
        chance = np.abs(good - expected) < significant * np.sqrt(expected)
        ratios[kind] = np.where(chance, 0, ratio)
    return ratios


def _score(shared, column: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in batches:
            scores = [float(ratios[features(text)].sum(dtype=np.float64)) for text in batch["_text"].to_pylist()]
            kept = [name for name in batch.schema.names if name != "_text"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in kept], pa.array(scores, pa.float64())], [*kept, column])

    return score


def key_of_rank(keys: DataFrame, column: str, rank: int, bins: int = 4096, few: int = 10_000) -> float:
    """The ``rank``-th highest value, exactly; each pass sends the counts of some thousand bins."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    inside = keys
    while True:
        n = inside.where(F.col(column).between(low, high)).count()
        if n <= few:
            found = sorted((row[0] for row in inside.where(F.col(column).between(low, high)).collect()), reverse=True)
            return found[rank - 1]
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            return low
        bin_ = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).alias("bin")
        counts = inside.where(F.col(column).between(low, high)).groupBy(bin_).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counts.collect(), key=lambda row: -row["bin"]):
            if rank <= row["n"]:
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]


def resample(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    columns: list[str] | None = None,
    most_labels: int = 200_000,
    share: float | None = None,
    temperature: float = 0.25,
    seed: int = 7,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with ``columns`` (all by default) and ``log_ratio``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; good is quality 1 without toxic 1. A
    sample of about ``most_labels`` labelled rows tells the good documents; counts of the whole
    cover all documents. ``share`` of all rows are drawn, by default the share of good ones among
    the labelled; ``temperature`` scales the noise.

    NULL and empty texts have no words and count as neutral; ties at the last place are all
    drawn; rows that repeat an id with its text share their fate, and rows without id are drawn
    each for itself; very long texts are scored whole; conflicting labels count as not good; NULL labels
    and labels without a document are ignored; without labels, or without good ones among them,
    every row is drawn; no rows give no rows. Further columns are passed on, whatever their names.
    """
    ship_package(spark)
    known = labels.select("doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    n_labels = known.count()
    rate = min(1.0, most_labels / n_labels) if n_labels else 1.0
    sample = known.where(uniform(F.lit(seed), F.col("doc_id")) < rate).groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good")
    )
    seen = sample.agg(F.count(F.lit(1)), F.count_if("good")).first()
    columns = docs.columns if columns is None else columns
    inner = [f"_c{k}" for k in range(len(columns))]
    rows = docs.select(
        *[F.col(f"`{name}`").alias(new) for name, new in zip(columns, inner, strict=True)],
        F.col(id_column).alias("_id"),
        # What noise depends on: rows without id differ by their place in the input only.
        F.when(F.col(id_column).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(text)).alias("_draw"),
        F.col(text).alias("_text"),
    )
    name = "log_ratio" if "log_ratio" not in columns else "_log_ratio"
    back = [F.col(new).alias(old) for old, new in zip(columns, inner, strict=True)]
    if not seen[1]:
        return rows.select(*back, F.lit(0.0).alias(name))
    # The size of this side is bounded by ``most_labels``.
    good = F.broadcast(sample.where("good").select(F.col("doc_id").alias("_id"), F.lit(True).alias("good")))
    ratios = fit_ratios(spark, rows.select("_id", F.col("_text").alias("text")).join(good, "_id", "left"))
    shared = spark.sparkContext.broadcast(ratios)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)
    scored = rows.select(*inner, "_id", "_draw", "_text").mapInArrow(_score(shared, "_score"), f"{schema}, _score double")
    noise: Column = -F.log(-F.log(uniform(F.lit(seed + 1), F.col("_id"), F.col("_draw")) + F.lit(2.0**-54)))
    keyed = saved(spark, scored.withColumn("_key", F.col("_score") + F.lit(float(temperature)) * noise), "scored")
    n_rows = keyed.count()
    drawn = round(n_rows * (seen[1] / seen[0] if share is None else share))
    if not drawn:
        return keyed.limit(0).select(*back, F.col("_score").alias(name))
    last = key_of_rank(keyed.select("_key"), "_key", drawn)
    return keyed.where(F.col("_key") >= F.lit(last)).select(*back, F.col("_score").alias(name))
