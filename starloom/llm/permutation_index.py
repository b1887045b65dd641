"""Nearest neighbours by the order in which vectors see a set of pivots.

Vectors that are near each other see the pivots in nearly the same order. Each vector is
described by its nearest pivots in their order, and posted with its rank in the inverted file of
each of them. A query opens the files of its own nearest pivots only and adds up, over the
postings there, how far the ranks differ: the footrule distance, in which a pivot that is not
among a vector's nearest counts as one rank past the last. The vectors with the smallest sums are
compared by the inner product itself.

The inverted files are kept in blocks of some thousand vectors. Blocks and queries meet in one
shuffle, by the number of the block: a task reads a block, then answers queries as they come.
Nothing but the pivots is sent to all tasks. Vectors are scaled by the greatest length and given
one more component that brings them to length one, so that the largest inner product is the
smallest angle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package

#: Vectors in a block, and the bytes they may take; vectors that are lifted and ranked at a time.
BLOCK, BLOCK_BYTES, RANKED = 8192, 16 << 20, 512
#: Blocks that are searched by tasks of their own; beyond that, a task takes several in turn.
MOST_TASKS = 20_000

_INDEX = pa.schema(
    [("part", pa.int32()), ("place", pa.int64()), ("ids", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary())]
    + [("starts", pa.binary()), ("members", pa.binary()), ("ranks", pa.binary())]
)
_FOUND = "query_id long, vec_id long, score double"
_EMPTY = "query_id long, rank int, vec_id long, score double"


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of at most the given length, at length one in one more dimension."""
    scaled = vectors / longest
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1, keepdims=True)))])


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, most: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :most].astype(np.int32)


def inverted_files(seen: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the file of each pivot starts, and its postings: the vectors that see it, and at which rank."""
    vectors, most = seen.shape
    order = np.argsort(seen, axis=None, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(seen.ravel(), minlength=n_pivots))])
    return starts.astype(np.int64), (order // most).astype(np.int32), (order % most).astype(np.int16)


def closeness(pivots: np.ndarray, starts: np.ndarray, members: np.ndarray, ranks: np.ndarray, vectors: int, most: int):
    """By how much each vector's footrule distance from a query falls short of the greatest one.

    Only the files of the query's pivots are read. A common pivot at ranks r and s counts
    ``2 * most - r - s - abs(r - s)``: what is saved against a vector without common pivots.
    """
    begins, lengths = starts[pivots], starts[pivots + 1] - starts[pivots]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + lengths, lengths)
    own = np.repeat(np.arange(len(pivots)), lengths)
    saving = 2 * (most - np.maximum(own, ranks[at]))
    return np.bincount(members[at], weights=saving, minlength=vectors)


def _padded(vector: list[float], size: int) -> np.ndarray:
    found = np.zeros(size)
    found[: len(vector)] = vector
    # Adding 0.0 makes both zeros one.
    return found + 0.0


def _index(pivots: np.ndarray, size: int, longest: float, most: int, most_copies: int):
    full = max(1, min(BLOCK, BLOCK_BYTES // (8 * size)))

    def block(kept: dict[bytes, list[int]], place: int) -> pa.RecordBatch:
        # Of equal vectors, only the smallest ids can be among the nearest.
        copies = [sorted(ids)[:most_copies] for ids in kept.values()]
        vectors = np.frombuffer(b"".join(kept), np.float64).reshape(len(kept), -1)
        order = np.argsort([ids[0] for ids in copies], kind="stable")
        vectors = vectors[order]
        some = [lifted(vectors[k : k + RANKED], longest) for k in range(0, len(vectors), RANKED)]
        files = inverted_files(np.vstack([nearest_pivots(v, pivots, most) for v in some]), len(pivots))
        row = {
            "part": [TaskContext.get().partitionId()],
            "place": [place],
            "ids": [np.array([i for k in order for i in copies[k]], np.int64).tobytes()],
            "copies": [np.array([len(copies[k]) for k in order], np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
        }
        return pa.RecordBatch.from_pydict(
            row | {name: [x.tobytes()] for name, x in zip(("starts", "members", "ranks"), files, strict=True)}, _INDEX
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, list[int]] = {}
        place = 0
        for batch in batches:
            for vec_id, vector in zip(batch["id"].to_pylist(), batch["vector"].to_pylist(), strict=True):
                ids = kept.setdefault(_padded(vector, size).tobytes(), [])
                ids.append(vec_id)
                if len(ids) > 8 * most_copies:
                    ids[:] = sorted(ids)[:most_copies]
                if len(kept) == full:
                    yield block(kept, place)
                    kept, place = {}, place + 1
        if kept:
            yield block(kept, place)

    return index


def _ask(pivots: np.ndarray, size: int, most: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, RANKED):
                some = batch.slice(k, RANKED)
                queries = np.array([_padded(vector, size) for vector in some["vector"].to_pylist()])
                unit = queries / np.sqrt((queries**2).sum(1, keepdims=True))
                seen = nearest_pivots(np.hstack([unit, np.zeros((len(unit), 1))]), pivots, most)
                yield pa.RecordBatch.from_pydict(
                    {"id": some["id"], "vectors": [q.tobytes() for q in queries], "members": [s.tobytes() for s in seen]}
                )

    return ask


class _Block:
    """A block of vectors with its inverted files."""

    def __init__(self, row: dict, most: int):
        self.ids, self.copies = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64)
        self.ends = np.cumsum(self.copies)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.copies), -1)
        kinds = (("starts", np.int64), ("members", np.int32), ("ranks", np.int16))
        self.files = [np.frombuffer(row[name], kind) for name, kind in kinds]
        self.most = most

    def best(self, query_id: int, query: np.ndarray, pivots: np.ndarray, k: int, part: float, least: int):
        """Ids and products of the ``k`` nearest among the candidates of a query."""
        n = len(self.copies)
        close = closeness(pivots, *self.files, n, self.most)
        take = min(n, max(least, int(np.ceil(part * n))))
        # Ties go to the smaller id, as vectors stand in the order of ids.
        near = np.argpartition(np.arange(n) - close * n, take - 1)[:take]
        scores = (self.vectors[near] * query).sum(1)
        which = np.repeat(np.arange(take), self.copies[near])
        offset = np.arange(len(which)) - np.repeat(np.cumsum(self.copies[near]) - self.copies[near], self.copies[near])
        names = self.ids[(self.ends[near] - self.copies[near])[which] + offset]
        scores, names = scores[which][names != query_id], names[names != query_id]
        order = np.lexsort((names, -scores))[:k]
        return names[order], scores[order]


def _search(most: int, k: int, part: float, least: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    block, number = _Block(row, most), row["block"]
                    continue
                if row["block"] != number:
                    raise ValueError("a query came before its block")
                query, pivots = np.frombuffer(row["vectors"], np.float64), np.frombuffer(row["members"], np.int32)
                found.append((row["id"], *block.best(row["id"], query, pivots, k, part, least)))
            if found:
                lengths = [len(names) for _, names, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([q for q, _, _ in found], np.int64), lengths))]
                    + [pa.array(np.concatenate([f[column] for f in found])) for column in (1, 2)],
                    ["query_id", "vec_id", "score"],
                )

    return search


def nearest(
    spark: SparkSession,
    embeddings: DataFrame,
    is_query,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 4096,
    seen: int = 48,
    part: float = 0.12,
    least: int = 512,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found of each query.

    Queries are the rows for which the condition ``is_query`` holds; candidates are all rows but
    those with the query's id. Nearness is the largest inner product in double precision, ties go
    to the smaller id. At most ``pivots`` vectors, and a quarter of a small table's, are sampled;
    each vector is posted in the files of its ``seen`` nearest. Of each block, the ``part`` of the
    vectors with the smallest footrule distance, but at least ``least``, are compared exactly.

    Vectors that are NULL or zero, or hold NULL or non-finite components, take no part, nor do
    rows without id. Shorter vectors count as 0 in the components that they lack. Equal vectors
    count once in the comparison and each in the result, rows that repeat an id too, and a
    repeated query is asked once for each different vector; longer vectors make smaller blocks;
    further columns are ignored, whatever their names; no rows, or a single one, give no rows.
    """
    ship_package(spark)
    value = F.col(vector).cast("array<double>")
    fit = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = embeddings.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & fit).select(
        F.col(id_column).cast("long").alias("id"), value.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    whole = rows.agg(F.max(F.size("vector")).alias("size"), F.max(squares).alias("longest")).first()
    if whole["size"] is None:
        return spark.createDataFrame([], _EMPTY)
    size, longest = whole["size"], float(np.sqrt(whole["longest"]))
    # A sample of bounded size, of which as many different vectors become pivots.
    sample = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(2 * pivots).collect()
    different = list(dict.fromkeys(_padded(row["vector"], size).tobytes() for row in sample))
    chosen = different[: max(1, min(pivots, len(different) // 4))]
    landmarks = lifted(np.frombuffer(b"".join(chosen), np.float64).reshape(len(chosen), -1), longest)
    most = min(seen, len(chosen))
    binary = ("ids", "copies", "vectors", "starts", "members", "ranks")
    index = saved(
        spark,
        rows.select("id", "vector").mapInArrow(
            _index(landmarks, size, longest, most, k + 1), ", ".join(["part int", "place long", *[f"{b} binary" for b in binary]])
        ),
        "pivot-files",
    )
    # Blocks get numbers without gaps; the driver sees one count for each task that made some.
    made = sorted(index.groupBy("part").agg(F.max("place").alias("last")).collect())
    before = np.cumsum([0, *[row["last"] + 1 for row in made]]).tolist()
    first = spark.createDataFrame([(r["part"], n) for r, n in zip(made, before, strict=False)], "part int, first long")
    blocks = index.join(F.broadcast(first), "part").select(
        (F.col("first") + F.col("place")).alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), *binary
    )
    asking = rows.where("asks").select("id", "vector").mapInArrow(
        _ask(landmarks, size, most), "id long, vectors binary, members binary"
    )
    nothing = F.lit(None).cast("binary")
    queries = asking.distinct().select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(before[-1] - 1))).alias("block"),
        F.lit(1).alias("kind"),
        "id",
        *[F.col(b) if b in ("vectors", "members") else nothing.alias(b) for b in binary],
    )
    tasks = min(before[-1], MOST_TASKS)
    met = blocks.unionByName(queries).repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int"))
    found = met.sortWithinPartitions("block", "kind").mapInArrow(_search(most, k, part, least), _FOUND)
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
