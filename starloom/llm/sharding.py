"""Contiguous shards of the smallest possible largest size.

Documents of equal text form one group, which is never cut. Groups stand in the order of their
smallest id, and a shard is a run of groups. The smallest capacity at which a greedy walk needs
no more than the wanted number of shards is found by binary search; the cuts then respect it.

The walk needs the places at which groups begin, in bytes from the start. The driver never sees
all of them: it holds the first and the last place of each of some thousands of bins, which
bound the walk from both sides. As long as the two bounds name different capacities, the bins
that the walk may touch are split further by another pass over the groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import byte_count, running_totals, saved

#: How many bins of places the driver asks for at a time.
BINS = 16_384

Ranges = list[tuple[int, int]]


class Places:
    """Where groups begin, known by the first and the last place of each bin."""

    def __init__(self, end: int, look: Callable[[Ranges, int], list[tuple[int, int]]]):
        self.end, self._look = end, look
        self._take([*look([(0, end - 1)], max(1, -(-end // BINS))), (end, end)])

    def _take(self, bins: list[tuple[int, int]]) -> None:
        self.bins = sorted(bins)
        self._first, self._last = [b[0] for b in self.bins], [b[1] for b in self.bins]

    def last_up_to(self, value: int) -> tuple[int, int]:
        """Bounds of the last place that is not above the value."""
        first, last = self.bins[bisect_right(self._first, value) - 1]
        return (last, last) if last <= value else (first, value)

    def first_from(self, value: int) -> tuple[int, int]:
        """Bounds of the first place that is not below the value."""
        if value <= 0:
            return 0, 0
        first, last = self.bins[bisect_left(self._last, value)]
        return (first, first) if first >= value else (value, last)

    def nearest(self, value: float, low: int, high: int) -> int:
        """The known place nearest to the value, from low to high; low is one."""
        known = [low]
        for at in range(bisect_left(self._last, value) - 1, bisect_left(self._last, value) + 2):
            if 0 <= at < len(self.bins):
                known += [place for place in self.bins[at] if low <= place <= high]
        known.append(self.last_up_to(high)[0] if self.last_up_to(high)[0] >= low else low)
        return min(known, key=lambda place: (abs(place - value), place))

    def split(self, ranges: Ranges) -> None:
        """Look closer at all bins that meet the ranges."""
        merged: Ranges = []
        for low, high in sorted(ranges):
            begin = bisect_left(self._last, low)
            end = min(bisect_right(self._first, high), len(self.bins) - 1) - 1  # the last bin is the end itself
            if begin > end:
                continue
            low, high = self.bins[begin][0], self.bins[end][1]
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        # There are a few ranges for each shard, and all are asked for in one pass.
        width = max(1, -(-sum(b - a + 1 for a, b in merged) // BINS))
        rest = [x for x in self.bins if not any(a <= x[0] <= b for a, b in merged)]
        self._take(rest + self._look(merged, width))

    def walk(self, capacity: int, shards: int, bold: bool) -> list[int]:
        """The ends of greedy shards, from below or, if bold, from above."""
        ends = [0]
        while ends[-1] < self.end and len(ends) <= shards:
            ends.append(self.last_up_to(ends[-1] + capacity)[bold])
        return ends

    def least(self, shards: int, low: int, bold: bool) -> int:
        """The smallest capacity at which the walk gets to the end."""
        high = self.end
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, bold)[-1] >= self.end:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(places: Places, shards: int, largest: int, oversize: list[tuple[int, int]]) -> list[int]:
    """The ends of all shards: none above the smallest feasible capacity, and as even as that allows."""
    while True:
        low = max(largest, -(-places.end // shards))
        least, enough = places.least(shards, low, True), places.least(shards, low, False)
        timid, bold = places.walk(least, shards, False), places.walk(enough, shards, True)
        early, latest = [places.end], [places.end]  # where shards may begin so that the rest still fits
        for _ in range(shards):
            early.append(places.first_from(early[-1] - enough)[0])
            latest.append(places.first_from(latest[-1] - enough)[1])
        if least == enough and latest[-1] == 0:
            break
        # The bounds close in with every pass, and the bins between them get finer.
        places.split(
            [(a, max(a, b)) for a, b in zip(timid, [*bold, *[places.end] * len(timid)], strict=False)]
            + list(zip(early, latest, strict=True))
        )
    begin = latest[::-1]
    ends = [0]
    for k in range(1, shards + 1):
        at, left = ends[-1], shards - k + 1
        ahead = [size for start, size in oversize if start >= at]
        even = (places.end - at - sum(ahead)) / max(1, left - len(ahead))
        if any(start == at for start, _ in oversize):
            even = next(size for start, size in oversize if start == at)
        high = min(places.end, at + enough)
        low = max(at, begin[k])
        ends.append(places.nearest(at + even, low, high) if k < shards else places.end)
    return ends


def minimax_shards(
    spark: SparkSession, docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text", overhead: int = 16
) -> DataFrame:
    """Returns id, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row of ``docs``.

    ``size`` is the length in UTF-8 plus ``overhead`` (1 or more). Rows of equal text share a
    shard; a group as large as several shards makes one large shard. Slots run from 0 without
    gaps, in the order of groups and then ids. NULL texts form one group of their own and have
    no CRC, empty texts another; a NULL id sorts first; repeated rows each get a slot; further
    columns are ignored; no rows give no shards; shards stay empty if there are fewer groups.
    """
    if shards < 1 or overhead < 1:
        raise ValueError("shards and overhead must be at least 1")
    value = F.col(text)
    # Two independent hashes and the length stand for the text.
    rows = saved(
        spark,
        docs.select(
            F.col(id_column).alias("_id"),
            (byte_count(value) + overhead).alias("_size"),
            F.crc32(value).alias("_crc"),
            F.when(value.isNull(), F.lit(0)).otherwise(F.xxhash64(value)).alias("_a"),
            F.when(value.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit("second"), value, byte_count(value))).alias("_b"),
        ),
        "shard-rows",
    )
    # A group of many rows is reduced before the shuffle, and the written table lets the join split its rows.
    shared = saved(
        spark,
        rows.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")).where("_n > 1").drop("_n"),
        "shard-groups",
    )
    # NULL ids are left out by min, so a group has a NULL first id only if it has no other.
    tagged = rows.join(shared, ["_a", "_b"], "left").withColumn("_group", F.coalesce("_first", "_id")).drop("_first")
    placed = saved(
        spark,
        running_totals(spark, tagged, ["_group", "_a", "_b", "_id"], {"_before": "_size"}, "shard-ranges"),
        "shard-places",
    )
    groups = placed.groupBy("_group", "_a", "_b").agg(F.min("_before").alias("start"), F.sum("_size").alias("size"))
    groups = saved(spark, groups.select("start", "size"), "shard-starts")
    whole = groups.agg(F.sum("size").alias("total"), F.max("size").alias("largest")).first()
    if whole["total"] is None:
        cuts: list[int] = []
    else:

        def look(ranges: Ranges, width: int) -> list[tuple[int, int]]:
            inside = reduce(Column.__or__, [F.col("start").between(a, b) for a, b in ranges])
            number = reduce(Column.__add__, [(F.col("start") >= a).cast("int") for a, _ in ranges])
            bins = groups.where(inside).groupBy(number.alias("range"), F.floor(F.col("start") / width).alias("bin"))
            found = bins.agg(F.min("start").alias("first"), F.max("start").alias("last")).collect()
            return [(row["first"], row["last"]) for row in found]

        # Fewer groups than shards can be larger than a shard's even part.
        oversize = groups.where(F.col("size") * shards > whole["total"]).collect()
        cuts = minimax_cuts(
            Places(whole["total"], look), shards, whole["largest"], [(row["start"], row["size"]) for row in oversize]
        )[1:-1]
    shard = reduce(Column.__add__, [(F.col("_before") >= cut).cast("int") for cut in cuts], F.lit(0))
    numbered = placed.withColumn("shard", shard.cast("int"))
    firsts = numbered.groupBy("shard").agg(F.min("row_index").alias("_shard_first"))  # a row for each shard
    return numbered.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_column),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        (F.col("row_index") - F.col("_shard_first")).alias("slot"),
    )
