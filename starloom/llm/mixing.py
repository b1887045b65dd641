"""Mixing sources to target weights: a splitting tree of multivariate hypergeometric draws.

The words of a source are laid end to end in a random order of its documents, as often as the
target asks for, and cut into blocks. How many blocks of each source an output shard gets is
drawn by a tree: at each node the blocks of its shards are split between the two halves by a
multivariate hypergeometric draw, so that every shard is a fair sample of the whole mix and
the quotas are met to the word. A shard's blocks are disjoint pieces of the source, taken in a
permuted order, and are shuffled inside the shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import running_totals, saved, uniform, word_count

#: A prime above the number of blocks of any source: multiplying by it permutes them.
PRIME = 1_000_003


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: float = 3.0
) -> DataFrame:
    """``source``, ``rank``, ``source_size`` and ``target`` of each source of ``sized`` (source, size).

    Sources in code point order, NULL last, get the weights in turn. They share ``share`` of all
    words by weight, but none gets over ``most`` times its own; what is over is shared again by
    weight among the rest.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # A row for each source from here on, not for each document.
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight.cast("double"), "cap": F.col("source_size") * F.lit(float(most))})
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    earlier, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    # In this order the full sources come first; the first that isn't full sets the level.
    level = ranked.withColumn("level", rest / left).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    open_level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(open_level["level"] * F.col("weight"))
    return level.select("source", "rank", "source_size", target.alias("target"))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are marked, by inversion of the exact distribution."""
    low = F.greatest(F.lit(0), drawn - (total - marked)).cast("long")
    high = F.least(drawn, marked).cast("long")
    steps = F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<long>"))

    def weight_of(before: Column, x: Column) -> Column:
        return before + F.log(
            ((marked - x + 1) * (drawn - x + 1)).cast("double") / (x * (total - marked - drawn + x)).cast("double")
        )

    zero = F.lit(0.0)
    most = F.aggregate(
        steps,
        F.struct(zero.alias("w"), zero.alias("most")),
        lambda s, x: _with(
            weight_of(s["w"], x), lambda w: F.struct(w.alias("w"), F.greatest(s["most"], w).alias("most"))
        ),
        lambda s: s["most"],
    )

    def add(s: Column, x: Column, peak: Column, *more: Column) -> Column:
        return _with(
            weight_of(s["w"], x),
            lambda w: F.struct(w.alias("w"), (s["sum"] + F.exp(w - peak)).alias("sum"), *more),
        )

    def invert(peak: Column) -> Column:
        start = [zero.alias("w"), F.exp(-peak).alias("sum")]
        everything = F.aggregate(steps, F.struct(*start), lambda s, x: add(s, x, peak), lambda s: s["sum"])
        # One more is marked for each value whose cumulative weight the chance exceeds.
        return _with(
            chance * everything,
            lambda goal: F.aggregate(
                steps,
                F.struct(*start, low.alias("x")),
                lambda s, x: add(s, x, peak, F.when(s["sum"] < goal, x).otherwise(s["x"]).alias("x")),
                lambda s: s["x"],
            ),
        )

    return _with(most, invert)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """From one row with an array ``quota`` (blocks by source) to a row for each shard."""
    nodes = quotas.select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "quota")
    half = F.floor(F.col("width") / 2).cast("int")
    total = F.aggregate("quota", F.lit(0).cast("long"), lambda s, q: s + q)
    drawn = F.floor(total * half / F.col("width")).cast("long")

    def draw(s: Column, q: Column) -> Column:
        chance = uniform(F.lit(seed), F.col("first"), F.col("width"), F.size(s["got"]))
        return _with(
            _hypergeometric(s["total"], q, s["drawn"], chance),
            lambda got: F.struct(
                (s["total"] - q).alias("total"),
                (s["drawn"] - got).alias("drawn"),
                F.concat(s["got"], F.array(got)).alias("got"),
            ),
        )

    # The first source is drawn out of all, the next out of what is left, and so on.
    left = F.aggregate(
        "quota",
        F.struct(total.alias("total"), drawn.alias("drawn"), F.array().cast("array<long>").alias("got")),
        draw,
        lambda s: s["got"],
    )
    halves = F.when(
        F.col("width") > 1,
        F.array(
            F.struct(F.col("first"), F.col("half").alias("width"), F.col("left").alias("quota")),
            F.struct(
                (F.col("first") + F.col("half")).alias("first"),
                (F.col("width") - F.col("half")).alias("width"),
                F.zip_with("quota", "left", lambda q, x: q - x).alias("quota"),
            ),
        ),
    ).otherwise(F.array(F.struct("first", "width", "quota")))
    new = {"half": half, "left": F.when(F.col("width") > 1, left)}
    for _ in range((shards - 1).bit_length()):
        nodes = nodes.withColumns(new).select(F.explode(halves).alias("node")).select("node.*")
    return nodes.select(F.col("first").alias("shard"), "quota")


def mix(
    spark: SparkSession,
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    most: float = 3.0,
    shards: int = 32,
    block_words: int = 1024,
    most_blocks: int = 131_072,
    seed: int = 42,
    key: str | None = None,
) -> DataFrame:
    """The pieces of which the mix consists, and a row without a piece for documents left out.

    Returns ``row_index`` (a number for each row of ``docs``), id, ``source``, ``size`` in words,
    ``source_size``, ``target``, ``quota`` (the target in whole words), ``at`` (where the document
    begins among the permuted words of its source), and for each piece ``round`` (0 for the first
    pass over the source), ``block``, ``words``, ``shard`` and ``shuffle_key``, the order inside
    the shard. Blocks have ``block_words`` words, or more if there would be over ``most_blocks``.

    NULL and empty texts have no words and no pieces; a NULL source is a source; ids may be NULL
    or repeated, each row counts; further columns are ignored, but for ``key``, a number of each
    row that its pieces bear too; no rows give no pieces.
    """
    extra = ["_key"] if key else []
    sized = docs.select(
        F.col(id_column).alias("_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(text), F.col(id_column), F.lit(seed)).alias("_dice"),
        *[F.col(key).alias(name) for name in extra],
    )
    sized = saved(spark, sized, "mix-sizes")
    targets = source_targets(sized, weights, share, most)
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    per_block = F.greatest(F.lit(block_words), F.ceil(F.sum("target").over(Window.partitionBy()) / most_blocks)).cast("long")
    targets = targets.withColumns(
        {
            "quota": F.round("target").cast("long"),
            "source_start": F.coalesce(F.sum("source_size").over(earlier), F.lit(0)),
            "per_block": per_block,
        }
    ).withColumn("blocks", F.ceil(F.col("quota") / F.col("per_block")).cast("long"))
    targets = saved(spark, targets, "mix-targets")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "blocks"))), lambda x: x["blocks"])
    leaves = split_quotas(targets.agg(ordered.alias("quota")), shards, seed)
    gained = leaves.select("shard", F.posexplode("quota").alias("rank", "gained"))
    up_to = Window.partitionBy("rank").orderBy("shard")
    ends = (
        gained.withColumn("end", F.sum("gained").over(up_to))
        .groupBy("rank")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends"))
    )
    # A row for each source, with a number for each shard.
    plan = saved(spark, targets.join(ends, "rank"), "mix-plan")
    same_source = sized["source"].eqNullSafe(targets["source"])
    ranked = sized.join(targets.select("source", "rank"), same_source).select("_id", "size", "_dice", "rank", *extra)
    placed = running_totals(spark, ranked, ["rank", "_dice", "_id", *extra], {"before": "size"}, "mix-ranges")
    known = placed.join(plan, "rank").withColumn("at", F.col("before") - F.col("source_start"))
    rounds = F.when(
        (F.col("size") > 0) & (F.col("at") < F.col("quota")),
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - F.col("at") - 1) / F.col("source_size")).cast("long")),
    )
    begin = F.col("at") + F.col("round") * F.col("source_size")
    pieces = known.withColumn("round", F.explode_outer(rounds)).withColumn("begin", begin)
    pieces = pieces.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
    touched = F.when(
        F.col("round").isNotNull(),
        F.sequence(
            F.floor(F.col("begin") / F.col("per_block")).cast("long"),
            F.floor((F.col("end") - 1) / F.col("per_block")).cast("long"),
        ),
    )
    pieces = pieces.withColumn("block", F.explode_outer(touched))
    words = F.least(F.col("end"), (F.col("block") + 1) * F.col("per_block")) - F.greatest(
        F.col("begin"), F.col("block") * F.col("per_block")
    )
    turn = F.floor(uniform(F.lit(seed), F.col("rank")) * F.col("blocks")).cast("long")
    pieces = pieces.withColumn("_place", (F.col("block") * PRIME + turn) % F.col("blocks"))
    shard = F.when(F.col("block").isNotNull(), F.size(F.filter("ends", lambda end: end <= F.col("_place"))))
    return pieces.select(
        "row_index",
        F.col("_id").alias(id_column),
        *[F.col(name).alias(key) for name in extra],
        "source",
        "size",
        "source_size",
        "target",
        "quota",
        "at",
        "round",
        "block",
        F.coalesce(words, F.lit(0)).cast("long").alias("words"),
        shard.alias("shard"),
        F.xxhash64(F.lit(seed), F.col("rank"), F.col("block"), F.col("row_index")).alias("shuffle_key"),
    )


def mixed_copies(pieces: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """How often each document goes whole into the mix: once for each round that takes its middle word."""
    middle = F.col("at") + F.col("round") * F.col("source_size") + F.floor(F.col("size") / 2)
    counted = F.max(F.when(F.col("round").isNotNull() & (middle < F.col("quota")), F.col("round") + 1))
    return pieces.groupBy(id_column).agg(F.coalesce(counted, F.lit(0)).cast("int").alias("copies"))
