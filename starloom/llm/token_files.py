"""Token ids in files of byte planes.

The ids of all documents, each with an end id, follow one another in the order of document ids.
They are cut into parts by ranges of ids, and each part into blocks of 65,536 ids. A block is
stored as planes: all lowest bytes (or bits) of its ids, then all second ones, and so on. Each
plane is compressed by zstandard on its own, and a plane of zeros takes no space.

The file is a parquet table with a row for each block; all but ``planes`` is the index: the
part and block number, the place of the first id in the part, the number of ids, the checksum,
and for each document that has ids in the block its number in the part, its id, the number of
its piece and how many ids stand here. A reader gets at any block without the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package
from starloom.llm.tokens import encoder

#: Ids in a block.
BLOCK = 1 << 16

BLOCK_SCHEMA = (
    "part int, block long, first long, n_ids long, crc long, bits boolean, "
    "orders array<long>, ids array<long>, pieces array<long>, lengths array<long>, planes array<binary>"
)
_LONGS = pa.list_(pa.int64())
_BLOCK = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("crc", pa.int64())]
    + [("bits", pa.bool_()), ("orders", _LONGS), ("ids", _LONGS), ("pieces", _LONGS), ("lengths", _LONGS)]
    + [("planes", pa.list_(pa.binary()))]
)


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The compressed planes of a block of unsigned 32-bit ids."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = np.packbits(np.unpackbits(table, axis=1, bitorder="little"), axis=0) if bits else table
    compress = zstandard.ZstdCompressor(level=1).compress
    return [compress(np.ascontiguousarray(plane).tobytes()) if plane.any() else b"" for plane in planes.T]


def from_planes(planes: list[bytes], n_ids: int, bits: bool) -> np.ndarray:
    """The ids of a block again."""
    expand = zstandard.ZstdDecompressor().decompress
    size = -(-n_ids // 8) if bits else n_ids
    table = np.zeros((size, len(planes)), np.uint8)
    for k, plane in enumerate(planes):
        if plane:
            table[:, k] = np.frombuffer(expand(plane), np.uint8)
    if bits:
        table = np.packbits(np.unpackbits(table, axis=0, count=n_ids), axis=1, bitorder="little")
    return np.ascontiguousarray(table).view("<u4").ravel()


def _encode(name: str, end_id: int, bounds: list[int]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, edges = encoder(name), np.array(bounds, np.int64)
        end = np.array([end_id], words.dtype).tobytes()
        for batch in batches:
            ids = batch["id"].to_pylist()
            parts = [0 if x is None else int(np.searchsorted(edges, x, side="right")) for x in ids]
            packed = [words.encode(text) + end for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), batch["id"], pa.array(packed, pa.binary())], ["part", "id", "packed"]
            )
        words.forget()

    return encode


class _Part:
    """The blocks of one part, as its documents come in."""

    def __init__(self, part: int, bits: bool):
        self.part, self.bits, self.block, self.first, self.order = part, bits, 0, 0, 0
        self._start()

    def _start(self) -> None:
        self.arrays: list[np.ndarray] = []
        self.count, self.rows = 0, ([], [], [], [])

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        piece = 0
        while len(ids):
            here = ids[: BLOCK - self.count]
            self.arrays.append(here)
            self.count += len(here)
            for column, value in zip(self.rows, (self.order, doc_id, piece, len(here)), strict=True):
                column.append(value)
            ids, piece = ids[len(here) :], piece + 1
            if self.count == BLOCK:
                yield from self.flush()
        self.order += 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            ids = np.concatenate(self.arrays).astype("<u4")
            row = dict(zip(("orders", "ids", "pieces", "lengths"), self.rows, strict=True))
            row |= {"part": self.part, "block": self.block, "first": self.first, "n_ids": len(ids), "bits": self.bits}
            row |= {"crc": zlib.crc32(ids.tobytes()), "planes": to_planes(ids, self.bits)}
            yield pa.RecordBatch.from_pylist([row], _BLOCK)
            self.block, self.first = self.block + 1, self.first + len(ids)
            self._start()


def _write(dtype: np.dtype, bits: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Part | None = None
        for batch in batches:
            for part, doc_id, packed in zip(
                batch["part"].to_pylist(), batch["id"].to_pylist(), batch["packed"], strict=True
            ):
                if now is None or now.part != part:
                    if now is not None:
                        yield from now.flush()
                    now = _Part(part, bits)
                yield from now.add(doc_id, np.frombuffer(packed.as_buffer(), dtype))
        if now is not None:
            yield from now.flush()

    return write


def write_ids(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text: str = "text",
    bits: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Writes the ids of all documents and returns the table of blocks.

    NULL and empty texts consist of the end id; a NULL document id comes first; rows with the
    same id each keep their ids, in any order; further columns are ignored; no rows give no
    blocks. ``parts`` is the number of ranges, by default that of shuffle tasks; each is written
    by one task, block by block.
    """
    ship_package(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    bounds: list[int] = []
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        # As many numbers as there are parts; they only shape the parts.
        bounds = rows.agg(F.percentile_approx("id", shares, 20_000)).first()[0] or []
    encoded = rows.mapInArrow(_encode(tokenizer, end_id, bounds), "part int, id long, packed binary")
    ordered = encoded.repartition("part").sortWithinPartitions(F.col("part"), F.col("id").asc_nulls_first())
    return saved(spark, ordered.mapInArrow(_write(encoder(tokenizer).dtype, bits), BLOCK_SCHEMA), "token-ids", "none")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = from_planes(row["planes"], row["n_ids"], row["bits"])
            if zlib.crc32(ids.tobytes()) != row["crc"]:
                raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
            ends = np.cumsum(row["lengths"])
            begins = ends - row["lengths"]
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (row["orders"], row["ids"], row["pieces"], row["lengths"])]
                + [pa.array(row["first"] + begins, pa.int64()), pa.array(crcs, pa.int64())],
                ["part", "order", "id", "piece", "length", "at", "crc"],
            )


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for column in matrix:
        if vector & 1:
            out ^= column
        vector >>= 1
    return out


def crc_of_both(first: int, second: int, second_bytes: int) -> int:
    """The CRC-32 of two texts in a row from theirs: the first is moved on by so many zero bytes.

    One zero bit is a linear map of the 32 bits; squaring it gives the map of 2, 4, 8 ... bits.
    """
    step = [0xEDB88320, *[1 << k for k in range(31)]]  # the reflected polynomial
    bits = second_bytes * 8
    while bits:
        if bits & 1:
            first = _times(step, first)
        step, bits = [_times(step, column) for column in step], bits >> 1
    return first ^ second


def _join_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for pieces in batch["crcs"].to_pylist():
            crc = pieces[0]["crc"]
            for piece in pieces[1:]:
                crc = crc_of_both(crc, piece["crc"], 4 * piece["length"])
            out.append(crc)
        names = ["part", "doc_id", "at", "n_tokens"]
        yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], pa.array(out, pa.int64())], [*names, "ids_crc32"])


def read_digests(blocks: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Id, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from the blocks."""
    pieces = blocks.mapInArrow(
        _read, "part int, order long, id long, piece long, length long, at long, crc long"
    )
    whole = pieces.groupBy("part", "order").agg(
        F.first("id").alias("doc_id"),
        F.min("at").alias("at"),
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("piece", "length", "crc"))).alias("crcs"),  # the blocks of one document
    )
    digests = whole.mapInArrow(_join_crcs, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return digests.join(F.broadcast(starts), "part").select(
        F.col("doc_id").alias(id_column), (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
