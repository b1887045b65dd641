"""Documents that share most of their word n-grams, by prefixes under several token orders.

A document is the set of its distinct runs of five words. Two documents whose sets have a Jaccard
similarity of at least ``t`` have at least ``ceil(t * n)`` members in common, n being the size of
either. So under any order of all tokens, the same for all documents, they share one of the
first ``n - ceil(t * n) + 1`` tokens of each. The first order puts rare tokens in front; pairs
that share a prefix token there must share one under two further orders too before their sets
are compared.

1. Tokens are dealt out by value, in blocks of numbers, and counted by documents. Only tokens of
   two or more documents go on, back to the batch of documents they came from. A document of which
   fewer than ``ceil(t * n)`` tokens are shared with any other is done: under each order its prefix
   consists of tokens of its own. So is a copy of another set.
2. What remains is posted under the prefix tokens of the first order. Within a token's list, not
   all pairs are tried: in each turn the members are compared with one hub of the list, and what
   links joins a component. Members of one component need no comparison, nor do those of which
   too few shared tokens are left in the list's order. When a turn joins little, all remaining
   pairs of different components are compared.

Equal sets count as one until the end. Tokens are 48-bit hashes and sets are named by 64-bit
hashes, which makes a wrong count a matter of one pair in many millions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved, ship_package
from starloom.llm.components import merge_components

#: Bits of a token, and bytes of text for which one block of tokens is counted at a time.
TOKEN_BITS, PART_BYTES = 48, 12 << 20

#: Another turn with hubs is taken if the last one left no more than this part of the components.
WORTH_A_TURN = 0.9

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Another hash of each hash."""
    out = (values + np.uint64(seed)) * _M1
    out ^= out >> np.uint64(31)
    out *= _M2
    return out ^ (out >> np.uint64(29))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct tokens of a document; of a shorter one, a single token."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    run = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        run = _mixed(run) + hashes[k : len(found) - width + 1 + k]
    return np.unique(_mixed(run) >> np.uint64(64 - TOKEN_BITS))


def set_name(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def least_common(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The fewest members that a set of n must share with a partner."""
    return -(-n * percent // 100)


def linked(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, percent: int) -> bool:
    """Whether two sets, of which the tokens not shared with any other are left out, link."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (size_a + size_b - common)


def _pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    table = np.zeros((len(packed) // 6, 8), np.uint8)
    table[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return table.view("<u8").ravel()


def _pack_sorted(tokens: np.ndarray) -> bytes:
    """Sorted tokens as their differences, byte plane by byte plane: the planes of zeros compress away."""
    steps = np.diff(tokens, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _unpack_sorted(packed: bytes) -> np.ndarray:
    table = np.zeros((len(packed) // 6, 8), np.uint8)
    table[:, :6] = np.frombuffer(packed, np.uint8).reshape(6, -1).T
    return np.cumsum(table.view("<u8").ravel(), dtype=np.uint64)


def _name(words: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, words) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(map(set_name, sets), pa.int64())],
                ["id", "n", "node"],
            )

    return name


#: A set of a batch in its dictionary: name and size.
_SET = np.dtype([("node", "<i8"), ("n", "<u4")])
_DEALT = pa.schema(
    [("part", pa.int32()), ("batch", pa.int64()), ("sets", pa.binary()), ("tokens", pa.binary()), ("owners", pa.binary())]
    + [("names", pa.binary()), ("named", pa.binary())]
)
_DEALT_SQL = "part int, batch long, sets binary, tokens binary, owners binary, names binary, named binary"
#: Sets in a batch, so that two bytes tell them apart.
_MOST_SETS = 1 << 16


def _deal(words: int, parts: int):
    """Each batch of documents becomes a row for each range of tokens.

    Tokens go in their order, each with the two-byte number that its set has in the batch, whatever
    the number of ranges; the names and sizes of sets go once, in the row of one range. The name of a batch is
    a hash of its sets. Names of sets are dealt out by their own ranges too, to find copies.
    """

    def rows_of(sets: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate([s for _, s in sets])
        about = np.zeros(len(sets), _SET)
        about["node"], about["n"] = [name for name, _ in sets], [len(s) for _, s in sets]
        batch = xxhash.xxh3_64_intdigest(about.tobytes()) >> 1
        owner = np.repeat(np.arange(len(sets)), about["n"]).astype("<u2")
        part = _part(tokens >> np.uint64(TOKEN_BITS - 32), parts)
        # Ranges follow the tokens.
        order = np.argsort(tokens, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        names = np.ascontiguousarray(about["node"])
        name_part = _part(names.view(np.uint64) >> np.uint64(32), parts)
        for p in range(parts):
            chosen, named = order[edges[p] : edges[p + 1]], np.flatnonzero(name_part == p)
            here = about.tobytes() if p == batch % parts else b""
            if len(chosen) or len(named) or here:
                row = {"part": [p], "batch": [batch], "sets": [here], "tokens": [_pack_sorted(tokens[chosen])]}
                row |= {"owners": [owner[chosen].tobytes()], "names": [names[named].tobytes()]}
                yield pa.RecordBatch.from_pydict(row | {"named": [named.astype("<u2").tobytes()]}, _DEALT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingles(text, words) for text in batch["text"].to_pylist())
            sets = list({set_name(s): s for s in sets if len(s)}.items())
            for start in range(0, len(sets), _MOST_SETS):
                yield from rows_of(sets[start : start + _MOST_SETS])

    return deal


def _part(numbers: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of 32-bit numbers."""
    return (numbers * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each key; they stand together."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != now:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


#: A token of a set of a batch: with the logarithm of the number of sets that have it, or ``_COPY``.
_SHARED = np.dtype([("owner", "<u2"), ("rarity", "u1"), ("token", "<u8")])
_OUT = pa.schema([("batch", pa.int64()), ("sets", pa.binary()), ("shared", pa.binary())])
#: In the place of a rarity: the set has the name of another, which stands for both.
_COPY = 255


def _pack_shared(shared: np.ndarray) -> bytes:
    """Nine bytes for each, in the order of tokens."""
    return shared["owner"].tobytes() + shared["rarity"].tobytes() + _pack_sorted(shared["token"])


def _unpack_shared(packed: bytes) -> np.ndarray:
    k = len(packed) // 9
    shared = np.zeros(k, _SHARED)
    shared["owner"], shared["rarity"] = np.frombuffer(packed, "<u2", k), np.frombuffer(packed, np.uint8, k, 2 * k)
    shared["token"] = _unpack_sorted(packed[3 * k :])
    return shared


def _runs_of(values: np.ndarray) -> np.ndarray:
    """How often each of some sorted values occurs, at each of its places."""
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(edge, len(values)))
    return np.repeat(sizes, sizes)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range of tokens, those of two or more sets, and of its names the copies, by batch."""
    for _, rows in _grouped(batches, "part"):
        # Batches of one name are equal: one stands for all.
        rows = list({row["batch"]: row for row in rows}.values())
        names = np.array([row["batch"] for row in rows], np.int64)

        def owners(column: str, rows: list[dict] = rows) -> np.ndarray:
            """The place of the batch and the number of the set, in one number."""
            return np.concatenate([np.frombuffer(row[column], "<u2").astype(np.int64) | k << 16 for k, row in enumerate(rows)])

        tokens, owner = np.concatenate([_unpack_sorted(row["tokens"]) for row in rows]), owners("owners")
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        sets_of = _runs_of(tokens)
        keep = sets_of > 1
        tokens, owner, sets_of = tokens[keep], owner[keep], sets_of[keep]
        # Of sets with one name, the one in the batch of the smallest name stands for all.
        node, holder = np.concatenate([np.frombuffer(row["names"], np.int64) for row in rows]), owners("named")
        order = np.lexsort((holder & 0xFFFF, names[holder >> 16], node))
        node, holder = node[order], holder[order]
        copies = holder[np.concatenate([[False], node[1:] == node[:-1]])] if len(node) else holder
        out = np.zeros(len(tokens) + len(copies), _SHARED)
        # Copies have no token and come first, so that tokens go on in their order.
        out["owner"] = np.concatenate([copies, owner]) & 0xFFFF
        out["rarity"][: len(copies)], out["rarity"][len(copies) :] = _COPY, 4 * np.log2(np.maximum(sets_of, 1))
        out["token"][len(copies) :] = tokens
        batch = np.concatenate([copies, owner]) >> 16
        order = np.argsort(batch, kind="stable")
        out, edges = out[order], np.searchsorted(batch[order], np.arange(len(rows) + 1))
        for k, row in enumerate(rows):
            if edges[k] < edges[k + 1] or row["sets"]:
                found = {"batch": [row["batch"]], "sets": [row["sets"]], "shared": [_pack_shared(out[edges[k] : edges[k + 1]])]}
                yield pa.RecordBatch.from_pydict(found, _OUT)


_SETS = pa.schema(
    [("node", pa.int64()), ("n", pa.int64()), ("centre", pa.float64()), ("rarity", pa.binary()), ("tokens", pa.binary())]
)


def _gather(percent: int):
    """The shared tokens of each set that has enough of them, in the order of their value."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "batch"):
            about = np.frombuffer(next(row["sets"] for row in rows if row["sets"]), _SET)
            shared = np.concatenate([_unpack_shared(row["shared"]) for row in rows])
            copies = set(shared["owner"][shared["rarity"] == _COPY].tolist())
            shared = shared[shared["rarity"] != _COPY]
            shared = shared[np.argsort(shared["owner"], kind="stable")]
            shared_by = shared["owner"].astype(np.int64)
            edge = np.flatnonzero(np.diff(shared_by, prepend=-1)) if len(shared) else np.zeros(0, np.int64)
            out = []
            for a, b in zip(edge, [*edge[1:], len(shared)], strict=False):
                one = shared[a:b]
                owner = int(one["owner"][0])
                node, n = about[owner].tolist()
                if owner not in copies and b - a >= least_common(n, percent):
                    tokens = one["token"]
                    order = np.argsort(tokens)
                    out.append(
                        {"node": node, "n": n, "centre": -len(one) / n}
                        | {"rarity": one["rarity"][order].tobytes(), "tokens": _pack(tokens[order])}
                    )
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, _SETS)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, _SETS)

    return gather


def prefix(tokens: np.ndarray, rarity: np.ndarray | None, n: int, percent: int, order: int) -> np.ndarray:
    """The prefix under an order: tokens of one set alone come first in all, and aren't here.

    Order 0 goes on by rarity, the others, which need none, by hashes of the token.
    """
    length = len(tokens) - least_common(n, percent) + 1
    by = np.lexsort((tokens, rarity)) if order == 0 else np.argsort(_mixed(tokens, order))
    return tokens[by[:length]]


def _post(percent: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = prefix(_unpack(row["tokens"]), np.frombuffer(row["rarity"], np.uint8), row["n"], percent, 0)
                k = len(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first.astype(np.int64)),
                        pa.array(np.full(k, row["node"], np.int64)),
                        pa.array(np.full(k, row["n"], np.int64)),
                        pa.array(len(row["tokens"]) // 6 - np.arange(k)),
                        pa.array(np.full(k, row["centre"])),
                    ],
                    ["token", "node", "n", "rest", "centre"],
                )

    return post


def _verify(percent: int, orders: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k, row in enumerate(batch.select(["n_a", "n_b", "tokens_a", "tokens_b"]).to_pylist()):
                sides = [(_unpack(row[f"tokens_{s}"]), None, row[f"n_{s}"]) for s in "ab"]
                if all(
                    len(np.intersect1d(*[prefix(*side, percent, order) for side in sides], assume_unique=True))
                    for order in range(1, orders)
                ) and linked(sides[0][0], sides[1][0], row["n_a"], row["n_b"], percent):
                    good.append(k)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return verify


def _compared(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """The pairs (a, b) that link. Rarity, which only the first order looks at, stays behind."""
    ends = saved(spark, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "paired-nodes")
    paired = saved(spark, sets.select("node", "n", "tokens").join(ends, "node", "left_semi"), "paired-sets")
    side = lambda s: paired.select(
        F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "tokens")]
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return saved(spark, both.mapInArrow(_verify(percent, orders), "a long, b long"), "links")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether two members of a list can still link if its token is their first common one.

    ``rest`` shared tokens stand from here on. A pair for which this isn't the first common token
    has been let through by an earlier one, or can't link at all.
    """
    sizes = F.col(f"{a}n") + F.col(f"{b}n")
    return F.least(f"{a}rest", f"{b}rest") * (100 + percent) >= sizes * percent


def _pairs_with_hub(spark: SparkSession, posts: DataFrame, labels: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of lists with several components, each with the hub of its list; and the hubs."""
    now = posts.join(labels, "node")
    hubs = now.groupBy("token").agg(
        F.min(F.struct("centre", "node", "n", "rest", "label")).alias("hub"), F.min("label").alias("l"), F.max("label").alias("h")
    )
    hubs = saved(spark, hubs.where("l < h").select("token", "hub"), "hubs")
    pairs = (
        now.join(hubs, "token")
        .where((F.col("label") != F.col("hub.label")) & _may_link("", "hub.", percent))
        .select(F.col("node").alias("a"), F.col("hub.node").alias("b"))
        .distinct()
    )
    return saved(spark, pairs, "hub-pairs"), hubs


def _pairs_across(spark: SparkSession, posts: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list that are in different components and may link."""
    now = posts.join(labels, "node")
    mixed = now.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("token")
    now = saved(spark, now.join(mixed, "token", "left_semi").drop("centre"), "open-posts")
    other = now.select("token", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "rest", "label")])
    pairs = now.join(other, "token").where(
        (F.col("node") < F.col("b_node")) & (F.col("label") != F.col("b_label")) & _may_link("", "b_", percent)
    )
    return saved(spark, pairs.select(F.col("node").alias("a"), F.col("b_node").alias("b")).distinct(), "cross-pairs")


def _count_components(labels: DataFrame) -> int:
    return labels.where("node = label").count()


def jaccard_components(
    spark: SparkSession,
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 75,
    orders: int = 3,
) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` (smallest id reachable by links) of each row of ``docs``.

    Texts are lower-cased in A-Z and split at ASCII blanks; a text of fewer than ``words`` words
    is one shingle. NULL and empty texts have none and link with nothing, not even each other.
    Equal texts link; repeated rows each get a row; NULL ids are passed over when the smallest
    is sought; further columns are ignored; no rows give no rows.
    """
    ship_package(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    named = saved(spark, rows.mapInArrow(_name(words), "id long, n long, node long"), "named-sets")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))
    dealt = rows.select("text").mapInArrow(_deal(words, parts), _DEALT_SQL)
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part")
    shared = dealt.mapInArrow(_count, "batch long, sets binary, shared binary")
    shared = shared.repartition(parts, "batch").sortWithinPartitions("batch")
    sets = shared.mapInArrow(_gather(percent), "node long, n long, centre double, rarity binary, tokens binary")
    sets = saved(spark, sets, "shared-sets")
    posts = sets.select("node", "n", "rarity", "tokens", "centre").mapInArrow(
        _post(percent), "token long, node long, n long, rest long, centre double"
    )
    posts = saved(spark, posts, "posts")
    labels = saved(spark, sets.select("node", F.col("node").alias("label")), "labels")
    many = _count_components(labels)
    while many:
        pairs, hubs = _pairs_with_hub(spark, posts, labels, percent)
        labels = merge_components(spark, labels, _compared(spark, pairs, sets, percent, orders))
        # A hub has been compared with all of its list; a list of one component is done.
        left = hubs.select("token", F.col("hub.node").alias("done"))
        posts = saved(spark, posts.join(left, "token").where(F.col("node") != F.col("done")).drop("done"), "posts")
        before, many = many, _count_components(labels)
        if many > WORTH_A_TURN * before:
            break
    pairs = _pairs_across(spark, posts, labels, percent)
    labels = merge_components(spark, labels, _compared(spark, pairs, sets, percent, orders))
    # From sets to documents: a set, then a component, is reduced to its smallest id.
    firsts = named.where("n > 0").groupBy("node").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = firsts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = saved(spark, firsts, "set-firsts")
    least = saved(spark, firsts.groupBy("label").agg(F.min("first").alias("component_id")), "component-firsts")
    of_set = firsts.join(least, "label").where("copies > 1 OR component_id <> first").select("node", "component_id")
    of_set = saved(spark, of_set, "set-components")
    return named.join(of_set, "node", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
    )
