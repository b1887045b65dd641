"""Verdicts on URLs by lists of hosts and paths, looked up in a cascade of Bloom filters.

A rule names a host and the start of a path, such as ``example.net/en/``. It fits a URL whose host
is its host or a subdomain of it and whose path starts with its path. So what a URL has to be
looked up under are the last labels of its host joined to the first characters of its path, for
the numbers of labels and characters that rules have: its keys. All keys of all URLs together are
the universe in which the cascade is exact.

The first filter holds the listed keys. Keys of the universe that pass it but are not listed are
its false positives; the second filter holds those. Listed keys that pass the second filter too go
into the third, and so on in turns until nothing passes wrongly. A key is looked up level by level:
the first filter that it does not pass settles whether it is listed. As the levels were made from
all keys of the table, none of them is judged wrongly, and no URL is joined with a rule.

Only keys that pass the first filter are ever shuffled. Filters are arrays of words in one row,
handed to the tasks as the results of scalar subqueries. Their size is bounded: a list whose first
filter would exceed ``MOST_BYTES`` is cut by hash into parts, each with a cascade of its own that
passes over the URLs in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved

#: Bytes of a first filter; what reaches the driver and each task is a little more than that.
MOST_BYTES = 16 << 20

#: Bits for each key, and how many of them it sets in one word: about 1 key in 100 passes the first filter wrongly.
FIRST_LEVEL, OTHER_LEVELS = (12, 6), (6, 3)

#: A-Z and a-z, as only these change case in hosts.
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; empty without one."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise("")


def _labels(host: Column) -> Column:
    """Number of labels of a host, which dots part."""
    return F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))) + 1


def rule_keys(rules: DataFrame, rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """Each rule once, as ``key``, ``labels`` and ``length`` of its host and path, and ``blocks``.

    Rules without a host are left out; of one that is both allowed and blocked the block holds.
    """
    text, blocks = F.col(f"`{rule}`"), F.col(f"`{verdict}`") == "block"
    host = F.translate(F.regexp_extract(text, r"^[^/]*", 0), _CAPITALS, _SMALL)
    path = F.regexp_extract(text, r"^[^/]*((?s).*)", 1)
    named = rules.select(host.alias("host"), path.alias("path"), blocks.alias("blocks")).where("host <> '' AND blocks IS NOT NULL")
    return (
        named.groupBy(F.concat("host", "path").alias("key"))
        .agg(F.first("host").alias("host"), F.first("path").alias("path"), F.max("blocks").alias("blocks"))
        .select("key", _labels(F.col("host")).alias("labels"), F.char_length("path").alias("length"), "blocks")
    )


Shape = tuple[int, int]


def candidate_key(host: Column, path: Column, shape: Shape) -> Column:
    """The last labels of a host joined to the first characters of a path; NULL where either has fewer."""
    labels, length = shape
    fits = (host != "") & (_labels(host) >= labels) & (F.char_length(path) >= length)
    return F.when(fits, F.concat(F.substring_index(host, ".", -labels), F.left(path, F.lit(length))))


@dataclass(frozen=True)
class Filter:
    """One level: its words of 64 bits as a one-row table, their number and the bits set for each key."""

    words: DataFrame
    size: int
    bits: int
    level: int

    def passes(self, key: Column) -> Column:
        mask = _mask(key, self)
        return F.get(self.words.scalar(), _word(key, self)).bitwiseAND(mask) == mask


def _word(key: Column, level: Filter) -> Column:
    """The word of a key. The level stands before the key, so that what collides at one level parts at the next."""
    return F.pmod(F.xxhash64(F.lit(level.level), F.lit("word"), key), F.lit(level.size).cast("long")).cast("int")


def _mask(key: Column, level: Filter) -> Column:
    """The bits of a key in its word, each from six bits of a hash."""
    parts = F.xxhash64(F.lit(level.level), F.lit("bits"), key)
    one = F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for n in range(level.bits):
        place = F.shiftrightunsigned(parts, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
    return mask


def build_filter(spark: SparkSession, keys: DataFrame, n_keys: int, level: int, per_key: int, bits: int) -> Filter:
    """A filter of the column ``key``: its words are found by an aggregate, whatever the number of keys."""
    size = max(1, -(-n_keys * per_key // 64))
    made = Filter(keys, size, bits, level)
    filled = keys.select(_word(F.col("key"), made).alias("word"), _mask(F.col("key"), made).alias("mask"))
    empty = spark.range(size).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = filled.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("words"))
    return Filter(saved(spark, row.select(F.col("words.mask").alias("words")), f"filter-{level}"), size, bits, level)


def listed(key: Column, levels: list[Filter]) -> Column:
    """Whether a key of the universe is listed, level by level."""
    answer = levels[-1].passes(key)
    for level in reversed(levels[:-1]):
        answer = level.passes(key) & ~answer
    return answer


def build_cascade(
    spark: SparkSession,
    rules: DataFrame,
    keys: DataFrame,
    first: tuple[int, int] = FIRST_LEVEL,
    others: tuple[int, int] = OTHER_LEVELS,
) -> list[Filter]:
    """Levels that tell the column ``key`` of ``rules`` from all else in the column ``key`` of ``keys``.

    ``keys`` may repeat; it is read once. False positives are found by grouping what passes the
    first filter with the listed keys, later ones among those.
    """
    rules = rules.select("key")
    levels = [build_filter(spark, rules, rules.count(), 1, *first)]
    passed = keys.select("key").where(levels[0].passes(F.col("key"))).distinct().withColumn("is_rule", F.lit(False))
    marked = passed.unionByName(rules.withColumn("is_rule", F.lit(True)))
    marked = saved(spark, marked.groupBy("key").agg(F.max("is_rule").alias("is_rule"), F.min("is_rule").alias("unseen")), "keys")
    # The universe is that of the URLs: rules that no URL has a key for can't pass wrongly.
    inside, outside = marked.where("is_rule AND NOT unseen").select("key"), marked.where("NOT is_rule").select("key")
    while True:
        # Whether the last level lets keys of the other side through; those fill the next one.
        wrong = saved(spark, outside, f"passed-{len(levels)}")
        n_wrong = wrong.count()
        if n_wrong == 0:
            return levels
        levels.append(build_filter(spark, wrong, n_wrong, len(levels) + 1, *others))
        inside, outside = wrong, inside.where(levels[-1].passes(F.col("key")))


def filter_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    rule: str = "rule",
    verdict: str = "verdict",
    first: tuple[int, int] = FIRST_LEVEL,
    others: tuple[int, int] = OTHER_LEVELS,
    most_bytes: int = MOST_BYTES,
    shapes_a_pass: int = 32,
) -> DataFrame:
    """All columns of ``pages`` in a struct ``passed``, with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has a text such as ``example.net/en/`` and ``block`` or ``allow``. Of the rules that
    fit a URL the longest wins, of equally long ones that with the longer host. Without a fitting
    rule ``rule`` is NULL and the URL, being on no list, is allowed. A NULL URL or one without
    ``://`` has an empty host and path and fits no rule; so does any other with an empty host.
    Case matters in paths, and in hosts but for A-Z. URLs and hosts may be of any length: only as
    many labels and characters are looked at as rules have. Repeated rows are judged each,
    repeated rules count once and without rules all is allowed; columns of any name pass along.
    """
    rules = saved(spark, rule_keys(rules, rule, verdict), "rules")
    n_rules = rules.count()
    # No more of them than the longest host has labels times the longest path characters.
    shapes = [tuple(row) for row in rules.select("labels", "length").distinct().orderBy("labels", "length").collect()]
    rows = pages.select(F.struct(*[F.col(f"`{name}`") for name in pages.columns]).alias("passed"))
    address = F.col("passed").getField(url)
    # The longest fitting rule so far; structs compare by size, then by the size of the host.
    none = F.lit(None).cast("struct<size: int, host_size: int, key: string, blocks: boolean>")
    rows = rows.select("passed", host_of(address).alias("host"), path_of(address).alias("path"), none.alias("best"))
    parts = max(1, -(-n_rules * first[0] // (8 * most_bytes)))
    # Each pass over the URLs looks up some shapes in one part of the list; usually there is one.
    passes = [
        (part, shapes[k : k + shapes_a_pass]) for part in range(parts) for k in range(0, len(shapes), shapes_a_pass)
    ]
    for part, some in passes:
        wanted = rules.where(F.struct("labels", "length").isin([F.struct(F.lit(a), F.lit(b)) for a, b in some]))
        wanted = wanted.where(F.pmod(F.xxhash64(F.lit("part"), F.col("key")), F.lit(parts)) == part)
        keys = F.array(*[candidate_key(F.col("host"), F.col("path"), shape) for shape in some])
        universe = rows.select(F.explode(keys).alias("key")).where("key IS NOT NULL")
        known = build_cascade(spark, wanted, universe, first, others)
        # Which of the listed keys block: all listed keys are the universe of the second cascade.
        blocking = build_cascade(spark, wanted.where("blocks"), wanted, first, others)
        found = F.greatest(*[F.lit(None).cast(_FOUND)] * 2, *[_found(shape, known) for shape in some])
        judged = F.when(
            F.col("found").isNotNull(),
            F.struct("found.size", "found.host_size", "found.key", listed(F.col("found.key"), blocking).alias("blocks")),
        )
        rows = rows.withColumn("found", found).withColumn("best", F.coalesce(F.greatest("best", judged), "best", judged)).drop("found")
        if len(passes) > 1:
            rows = saved(spark, rows, "judged-urls")
    return rows.select(
        "passed",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"),
    )


_FOUND = "struct<size: int, host_size: int, key: string>"


def _found(shape: Shape, known: list[Filter]) -> Column:
    """The key of a shape with its sizes if it is listed."""
    host, path = F.col("host"), F.col("path")
    key = candidate_key(host, path, shape)
    host_size = F.char_length(F.substring_index(host, ".", -shape[0]))
    return F.when(
        key.isNotNull() & listed(key, known),
        F.struct((host_size + shape[1]).alias("size"), host_size.alias("host_size"), key.alias("key")),
    )
