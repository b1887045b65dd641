"""Spelling variants: words one edit apart, the rarer ones led back to a far more frequent one.

Words are near if one inserted, deleted or replaced character parts them. Candidates are found by
asymmetric chunks. The shorter word of a pair (either one of equal length) is cut into two disjoint
chunks, its halves; the other contributes the grams that stand where a chunk would stand, moved by
no more than the one character by which it may be longer. One edit spoils one half at most, so the
other half of the shorter word is a gram of the longer one: at the same place if it comes first,
moved by the difference in length if it comes last.

A half shared by thousands of words would pair them all. The spoiled half is therefore cut in two
again: the edit stands in one part of it, and all outside that part must agree. So an entry of a
word names a *region* that holds the edit, and its key is what stands outside. Where a key still
has more than ``MOST_PAIRS`` candidates, its region is halved once more, as often as it takes: down
to a region of one character, at which all candidates are near. No link is lost by this, no word
left out, and what is paired grows with the links. Candidates are verified by the edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package

#: Words in a Python worker before they are handed on, and candidates of a key beyond which its region is halved.
MOST_WORDS, MOST_PAIRS = 200_000, 20_000

_LETTERS = "A-Za-zÀ-ÿ"
_SMALL = {byte: byte + 32 for byte in range(65, 91)}


def _counted(shortest: int, one_in: int):
    """Occurrences of words in documents, summed over as many documents as the worker has room for."""
    # A run is matched from its first character, so that it is always taken whole.
    run = re.compile(f"[{_LETTERS}]{{{shortest},}}")

    def spoilt(name: str, word: str) -> str:
        """The word, less one character where the checksum says so."""
        checksum = zlib.crc32(f"{name}:{word}".encode())
        if checksum % one_in:
            return word
        gone = checksum % len(word)
        return word[:gone] + word[gone + 1 :]

    def batch_of(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch["name"].to_pylist(), batch["text"].to_pylist(), strict=True):
                runs = Counter(match.group() for match in run.finditer(text or ""))
                for raw, n in runs.items():
                    word = spoilt(name, raw.translate(_SMALL))
                    if len(word) >= shortest:
                        words[word] += n
                if len(words) > MOST_WORDS:
                    yield batch_of(words)
                    words = Counter()
        yield batch_of(words)

    return count


def word_counts(
    spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text: str = "text", shortest: int = 7, one_in: int = 31
) -> DataFrame:
    """``word`` and ``n``: runs of letters of all texts in lower case, of ``shortest`` characters or more.

    A run is spoilt, by leaving out one character, where the checksum of id and run is divisible by
    ``one_in``; a NULL id counts as an empty one. A NULL text has no words.
    """
    ship_package(spark)
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name")
    rows = docs.select(name, F.col(text).alias("text"))
    return rows.mapInArrow(_counted(shortest, one_in), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _key(word: Column, size: Column, low: Column, high: Column, moved: Column) -> Column:
    """What stands outside the region [low, high) of a word of ``size``, as a hash.

    In a word that is longer by ``moved``, what follows the region is moved by as much.
    """
    before, after = F.left(word, low), F.substr(word, high + moved + 1)
    return F.xxhash64(size, low, high, before, after)


def _halved(entries: DataFrame) -> DataFrame:
    """Each entry twice, with either half of its region."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.explode(
        F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    )
    cut = entries.select("word", "n", "size", "moved", halves.alias("region"))
    cut = cut.select("word", "n", "size", "moved", F.col("region.low").alias("low"), F.col("region.high").alias("high"))
    return cut.withColumn("key", _key(*(F.col(name) for name in ("word", "size", "low", "high", "moved"))))


def _entries(words: DataFrame, shortest: int) -> DataFrame:
    """Each word as a word of its own length and, for words shorter by one, as the longer one."""
    length = F.char_length("word")
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("moved")
    whole = words.select("word", "n", sides).select(
        "word", "n", (length - F.col("moved")).alias("size"), "moved", F.lit(0).alias("low"), (length - F.col("moved")).alias("high")
    )
    # Two chunks, and the spoiled one in two again.
    return _halved(_halved(whole.where(F.col("size") >= shortest)).drop("key"))


def _links(entries: DataFrame) -> DataFrame:
    """Verified pairs of the words that share a key."""
    one = entries.where("moved = 0").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    other = entries.select("key", "moved", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # Of two words of equal length either is the other's candidate; one is enough.
    pairs = one.join(other, "key").where((F.col("moved") == 1) | (F.col("a") < F.col("b")))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def near_words(spark: SparkSession, words: DataFrame, shortest: int = 7, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """All pairs of distinct ``word`` that are one edit apart, once: ``a``, ``n_a``, ``b``, ``n_b``."""
    entries, found = saved(spark, _entries(words, shortest), "word-entries"), None
    while True:
        own = F.count_if(F.col("moved") == 0)
        sizes = entries.groupBy("key").agg(own.alias("own"), F.count(F.lit(1)).alias("all"), F.max(F.col("high") - F.col("low")).alias("region"))
        crowded = saved(spark, sizes.where((F.col("own") * F.col("all") > most_pairs) & (F.col("region") > 1)).select("key"), "crowded-keys")
        last = crowded.isEmpty()
        links = saved(spark, _links(entries if last else entries.join(crowded, "key", "left_anti")), "word-links")
        found = links if found is None else found.unionByName(links)
        if last:
            # An edit on the border of two regions is found in both.
            return found.distinct()
        entries = saved(spark, _halved(entries.join(crowded, "key", "left_semi")), "word-entries")


def follow(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: from each ``word`` along ``form`` to the last one, in steps that double."""
    ways = saved(spark, forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = saved(spark, ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(
    spark: SparkSession,
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shortest: int = 7,
    least: int = 2,
    times: int = 10,
    one_in: int = 31,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """One row for each word of ``shortest`` characters or more that occurs ``least`` times or more.

    Columns: ``word``, ``form``, ``root``, ``n`` (occurrences), ``n_near`` (near words among these)
    and ``form_n``. ``form`` is the most frequent near word, of equally frequent ones the first in
    code-point order, if it occurs at least ``times`` as often, else NULL; ``root`` is where forms
    lead, the word itself without one. Forms grow in frequency, so that they never lead in circles
    (``times`` has to be above 1). NULL and empty texts have no words, a NULL id counts as an empty one, texts and
    runs may be of any length, repeated rows count each, and further columns are ignored. A table
    without words gives no rows.
    """
    if times <= 1:
        raise ValueError("forms have to be more frequent: times must be above 1")
    words = word_counts(spark, docs, id_column, text, shortest, one_in).where(F.col("n") >= least)
    words = saved(spark, words, "words")
    links = near_words(spark, words, shortest, most_pairs)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    both = links.select(F.explode(ends).alias("end")).select("end.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    leads = -F.col("best.rank") >= times * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"),
        F.when(leads, -F.col("best.rank")).alias("form_n"),
    )
    judged = saved(spark, judged, "word-forms")
    roots = follow(spark, judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
