"""Hard negatives of anchors: rows of other labels that score nearly as high as a positive.

All scores are integer inner products of anchors with all rows, so the work is a product of an
anchor matrix with a candidate matrix. Both are cut into tiles of rows, stored as packed int64, and
each pair of tiles is multiplied by Strassen's recursion: seven products of half-size blocks
instead of eight, down to small blocks. Odd sizes are padded with zeros. Sums and products are
taken modulo 2**64, so whatever the sums on the way come to, a score that fits is exact; that all
scores fit is checked beforehand.

Two passes go over the candidates. The first keeps a heap for each anchor: the best rows of its
own label. The second keeps a heap for each anchor and positive: the best rows of other labels in
the window that the positive's score opens. A task merges its tiles into one heap each; the heaps
of all tasks are merged by Spark, so what is shuffled is a few rows for each anchor and task.

Anchors are broadcast in slices of about ``SLICE_BYTES``, each of which passes over the
candidates in turn: a stated query set against all rows, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package

#: Rows in a tile, and the block size at which the recursion ends.
TILE, LEAF = 512, 16

#: Bytes of packed anchors that are broadcast at a time.
SLICE_BYTES = 32 << 20

#: The score of what isn't there.
_NOTHING = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices modulo 2**64, by seven half-size products where blocks are large."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    depth = 0
    while min(rows, inner, columns) >> (depth + 1) >= leaf:
        depth += 1
    unit = 1 << depth
    padded = [-(-size // unit) * unit for size in (rows, inner, columns)]
    if padded != [rows, inner, columns]:
        whole = np.zeros(padded[:2], np.int64), np.zeros(padded[1:], np.int64)
        whole[0][:rows, :inner], whole[1][:inner, :columns] = a, b
        a, b = whole
    return _halves(a, b, depth)[:rows, :columns]


def _halves(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    if depth == 0:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _halves(a11 + a22, b11 + b22, depth - 1)
    p2 = _halves(a21 + a22, b11, depth - 1)
    p3 = _halves(a11, b12 - b22, depth - 1)
    p4 = _halves(a22, b21 - b11, depth - 1)
    p5 = _halves(a11 + a12, b22, depth - 1)
    p6 = _halves(a21 - a11, b11 + b12, depth - 1)
    p7 = _halves(a12 - a22, b21 + b22, depth - 1)
    product = np.empty((2 * m, 2 * n), np.int64)
    product[:m, :n] = p1 + p4 - p5 + p7
    product[:m, n:] = p3 + p5
    product[m:, :n] = p2 + p4
    product[m:, n:] = p1 - p2 + p3 + p6
    return product


class Heaps:
    """The best ``size`` entries of each of ``n`` lists: higher scores first, then smaller ids, then smaller rows."""

    def __init__(self, n: int, size: int):
        self.scores = np.full((n, size), _NOTHING, np.int64)
        self.ids = np.zeros((n, size), np.int64)
        self.rows = np.zeros((n, size), np.int64)

    def merge(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> None:
        """Takes in entries, one column for each id: ``scores`` and ``wanted`` have a row for each list."""
        size = self.scores.shape[1]
        worst, last = self.scores[:, -1:], self.ids[:, -1:]
        # Most entries are worse than what a list holds already.
        better = wanted & ((scores > worst) | ((scores == worst) & (ids[None, :] <= last)))
        which, place = np.nonzero(better)
        if not len(which):
            return
        touched = np.unique(which)
        held = np.repeat(touched, size)
        lists = np.concatenate([held, which])
        values = np.concatenate([self.scores[touched].ravel(), scores[which, place]])
        names = np.concatenate([self.ids[touched].ravel(), ids[place]])
        numbers = np.concatenate([self.rows[touched].ravel(), rows[place]])
        # Complementing turns the order of scores around without leaving int64.
        order = np.lexsort((numbers, names, ~values, lists))
        lists = lists[order]
        rank = np.arange(len(lists)) - np.searchsorted(lists, lists)
        kept = order[rank < size]
        for target, source in ((self.scores, values), (self.ids, names), (self.rows, numbers)):
            target[touched] = source[kept].reshape(len(touched), size)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List numbers, ids, rows and scores of what is held."""
        which, place = np.nonzero(self.scores != _NOTHING)
        return which, self.ids[which, place], self.rows[which, place], self.scores[which, place]


_TILE = pa.schema([(name, pa.binary()) for name in ("ids", "rows", "labels", "extra", "vectors")])


def _packed(width: int, most: int):
    """Tiles of the rows of a partition, vectors padded with zeros to ``width``."""

    def tile(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = np.zeros((len(batch), width), np.int64)
        lists = batch["vector"]
        sizes = np.diff(lists.offsets.to_numpy())
        inside = np.arange(width)[None, :] < sizes[:, None]
        vectors[inside] = lists.flatten().to_numpy()
        columns = [batch[name].to_numpy().tobytes() for name in ("id", "row", "label")]
        columns.append(np.array(batch["extra"].to_pylist(), np.int64).tobytes())
        return pa.RecordBatch.from_pydict({n: [c] for n, c in zip(_TILE.names, [*columns, vectors.tobytes()], strict=True)}, _TILE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), most):
                yield tile(batch.slice(start, most))

    return pack


def _unpacked(row: dict, width: int) -> tuple[np.ndarray, ...]:
    ids, rows, labels, extra = (np.frombuffer(row[name], np.int64) for name in ("ids", "rows", "labels", "extra"))
    return ids, rows, labels, extra.reshape(len(ids), -1), np.frombuffer(row["vectors"], np.int64).reshape(len(ids), width)


def _scores(row: dict, shared, width: int) -> Iterator[tuple]:
    """A candidate tile with each anchor tile of the slice: tile number, both sides and their scores."""
    others = _unpacked(row, width)
    transposed = np.ascontiguousarray(others[4].T)
    for number, packed in enumerate(shared.value):
        anchors = _unpacked(packed, width)
        yield number, anchors, others, strassen(anchors[4], transposed)


def _best_positives(shared, width: int, size: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, Heaps]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for number, anchors, others, scores in _scores(row, shared, width):
                    _, heaps = held.setdefault(number, (anchors[1], Heaps(len(anchors[1]), size)))
                    same = (anchors[2][:, None] == others[2][None, :]) & (anchors[1][:, None] != others[1][None, :])
                    heaps.merge(scores, others[0], others[1], same)
        for rows, heaps in held.values():
            which, ids, numbers, scores = heaps.entries()
            yield pa.RecordBatch.from_pydict({"anchor": rows[which], "id": ids, "row": numbers, "score": scores})

    return search


def _best_negatives(shared, width: int, size: int, low: int, high: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, list[Heaps]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for number, anchors, others, scores in _scores(row, shared, width):
                    positives = anchors[3]
                    if number not in held:
                        heaps = [Heaps(len(positives), size) for _ in range(positives.shape[1])]
                        held[number] = anchors[1], heaps
                    unlike = anchors[2][:, None] != others[2][None, :]
                    for place, heaps in enumerate(held[number][1]):
                        # An anchor with fewer positives has empty places, for which nothing is wanted.
                        there = positives[:, place : place + 1] != _NOTHING
                        limit = np.where(there, positives[:, place : place + 1], 0)
                        # low * p <= 100 * s <= high * p as bounds of s, rounded inwards.
                        inside = (scores >= -((-low * limit) // 100)) & (scores <= (high * limit) // 100)
                        heaps.merge(scores, others[0], others[1], unlike & inside & there)
        for rows, lists in held.values():
            for place, heaps in enumerate(lists):
                which, ids, numbers, scores = heaps.entries()
                places = np.full(len(which), place + 1, np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"anchor": rows[which], "place": places, "id": ids, "row": numbers, "score": scores}
                )

    return search


def integer_vectors(value: Column) -> Column:
    """``floor(256 * x)`` of each component x, as long; for arrays of finite components."""
    return F.transform(value.cast("array<double>"), lambda x: F.floor(x * 256).cast("long"))


def _tiles(rows: DataFrame, width: int) -> DataFrame:
    return rows.select("id", "row", "label", "extra", "vector").mapInArrow(
        _packed(width, TILE), "ids binary, rows binary, labels binary, extra binary, vectors binary"
    )


def _against_all(spark: SparkSession, anchors: DataFrame, candidates: DataFrame, width: int, search, schema: str, name: str):
    """Every anchor tile with every candidate tile, a slice of anchors at a time; the heaps of all tasks.

    A slice is some ``SLICE_BYTES`` of tiles, however many anchors there are.
    """
    tiles = _tiles(anchors, width).withColumn("tile", F.monotonically_increasing_id())
    tiles = saved(spark, tiles, f"{name}-anchors")
    size = tiles.agg(F.coalesce(F.sum(F.octet_length("vectors")), F.lit(0))).first()[0]
    slices = max(1, -(-size // SLICE_BYTES))
    found = None
    for k in range(slices):
        some = tiles.where(F.pmod(F.xxhash64("tile"), F.lit(slices)) == k).orderBy("tile")
        shared = spark.sparkContext.broadcast([row.asDict() for row in some.collect()])
        heaps = saved(spark, candidates.mapInArrow(search(shared), schema), f"{name}-heaps")
        shared.unpersist()
        found = heaps if found is None else found.unionByName(heaps)
    return found


def hard_negatives(
    spark: SparkSession,
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    id_column: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Vectors become integers by ``floor(256 * x)`` and scores are integer inner products. An anchor's
    positives are the ``positives`` best other rows of its label; for each, the ``negatives`` best
    rows of other labels are returned whose score lies between ``low`` and ``high`` percent of the
    positive's. Higher scores come first, then smaller ids, then, of rows that repeat an id, any
    fixed order. Anchors are the rows for which the condition ``is_anchor`` holds.

    Rows without id, label or vector, and those with a NULL or non-finite component, take no part.
    Shorter vectors count as padded with zeros, an empty one as all zeros. Repeated rows are rows of
    their own: a copy of an anchor is its positive. Further columns are ignored. Without rows,
    anchors, positives or anything in a window, there are no rows. Components must be small enough
    for all scores to fit: a ``ValueError`` says so otherwise.
    """
    ship_package(spark)
    value, finite = F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("value").isNotNull() & F.forall("value", finite)
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        value.cast("array<double>").alias("value"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).where(fit)
    largest = F.aggregate("value", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x)))
    rows = rows.select("id", "label", "asks", integer_vectors(F.col("value")).alias("vector"), largest.alias("largest"))
    rows = saved(spark, rows.withColumn("row", F.monotonically_increasing_id()), "integer-vectors")
    width, most = rows.agg(F.max(F.size("vector")), F.max("largest")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not width:
        # Vectors without components all score 0, which the one zero that pads them gives too.
        width = 1
    if most is not None and (256.0 * most + 1) ** 2 * width * 100 >= 2.0**63:
        raise ValueError(f"components of up to {most} in {width} dimensions give scores that do not fit in 64 bits")
    no_extra = F.array().cast("array<long>").alias("extra")
    candidates = saved(spark, _tiles(rows.select("id", "row", "label", no_extra, "vector"), width), "candidate-tiles")
    asking = rows.where("asks")
    found = _against_all(
        spark,
        asking.select("id", "row", "label", no_extra, "vector"),
        candidates,
        width,
        lambda shared: _best_positives(shared, width, positives),
        "anchor long, id long, row long, score long",
        "positive",
    )
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    ranked = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    ranked = saved(spark, ranked.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Scores by place, for the windows: at most ``positives`` of them for each anchor.
    by_place = ranked.groupBy(F.col("anchor").alias("row")).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "positive_score"))).alias("scores")
    )
    places = [F.coalesce(F.element_at("scores", F.lit(k + 1)), F.lit(int(_NOTHING))) for k in range(positives)]
    windows = asking.join(by_place, "row").select("id", "row", "label", F.array(*places).alias("extra"), "vector")
    found = _against_all(
        spark,
        windows,
        candidates,
        width,
        lambda shared: _best_negatives(shared, width, negatives, low, high),
        "anchor long, place int, id long, row long, score long",
        "negative",
    )
    best = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id", "row")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    anchor_ids = asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    names = schema.replace(",", "").split()[::2]
    return named.join(ranked, ["anchor", "place"]).join(anchor_ids, "anchor").select(*names)
