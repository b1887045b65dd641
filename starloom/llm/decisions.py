"""Decisions on rows of text, made on narrow tables and applied without moving the text.

Documents are numbered as they are written: a row's number is that of the task that wrote it and its
place there. What is decided for each number comes back as one array for each task's rows, a
byte for each of them, and meets the text by a broadcast of these arrays. Their size is bounded: a
broadcast has at most ``MOST_ROWS`` bytes of them, and what is larger is applied range after range
of numbers, each of which reads its own files only. So the plan is the same at all sizes, and text
is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved

#: Rows whose decisions are broadcast together.
MOST_ROWS = 64 << 20

#: Bits of a number that tell the place among the rows of a task, as in ``monotonically_increasing_id``.
_PLACE_BITS = 33


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a number for each row, ``_row``, written so that it stays the same."""
    return saved(spark, docs.withColumn("_row", F.monotonically_increasing_id()), "numbered-documents")


def applied(spark: SparkSession, rows: DataFrame, copies: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Each of the ``numbered`` rows as often as the column ``copies`` says for its ``_row``.

    ``copies`` has an entry from 0 to 127 for some numbers, once each; rows without one go.
    """
    task, place = F.shiftright("_row", _PLACE_BITS), F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # All numbers, so that a row's place in the array is its place in the task.
    complete = rows.select("_row", F.lit(0).cast("byte").alias("copies")).unionByName(
        copies.select("_row", F.col("copies").cast("byte").alias("copies"))
    )
    complete = complete.groupBy("_row").agg(F.max("copies").alias("copies"))
    entry = F.struct(place.cast("int").alias("place"), "copies")
    arrays = complete.groupBy(task.alias("_task")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    arrays = saved(spark, arrays.select("_task", F.col("entries.copies").alias("_copies")), "decisions")
    n_rows, n_tasks = arrays.agg(F.coalesce(F.sum(F.size("_copies")), F.lit(0)), F.max("_task") + 1).first()
    slices = max(1, -(-n_rows // most_rows))
    parts = []
    for k in range(slices):
        low, high = ((n_tasks or 0) * edge // slices << _PLACE_BITS for edge in (k, k + 1))
        some = rows if slices == 1 else rows.where((F.col("_row") >= low) & (F.col("_row") < high))
        held = arrays if slices == 1 else arrays.where((F.col("_task") >= low >> _PLACE_BITS) & (F.col("_task") < high >> _PLACE_BITS))
        parts.append(some.withColumn("_task", task).join(F.broadcast(held), "_task"))
    taken = reduce(DataFrame.unionByName, parts).withColumn("_times", F.get("_copies", place.cast("int"))).where("_times > 0")
    # Most rows are taken once.
    return taken.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*rows.drop("_row").columns)
