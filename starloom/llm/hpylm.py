"""A hierarchical Pitman-Yor model of words after contexts, sampled by Gibbs sweeps.

Each word that came before another is a restaurant; the words that followed are its customers,
seated at tables by the Chinese restaurant process. All restaurants
share one parent, in which each of their tables is a customer. The parent has one table for each
word; its next new table stands for any word not seen in training. With ``c`` customers at ``t``
tables for a word, ``C`` and ``T`` in the restaurant, ``n`` at the parent and ``N``, ``V`` in all,

    P(w | u) = (c - d t + (s + d T) P(w)) / (s + C),  P(w) = (n - d0) / (s0 + N) or (s0 + d0 V) / (s0 + N).

A Gibbs move seats all customers of a pair anew: what the model needs of them is the number of
their tables, which is drawn from its conditional given the tables of all other pairs. A number
``t`` has the weight of all seatings at ``t`` tables, a generalised Stirling number, times the
chances of ``t`` openings here and of ``t`` customers at the parent. Up to ``WHOLE_ROWS`` customers
all numbers are weighed; above, proposals near the conditional are taken or refused, so that the
work grows with the root of the count.

Words are dealt out in blocks by their hash. A word has one pair for each restaurant, so a block's
sums stay small however frequent its words are, and ``n`` is exact there. A restaurant's pairs are
in many blocks: each block asks for the totals ``C`` and ``T`` of the restaurants that it has pairs
of, and tasks that own restaurants by their hash add up what blocks say of them and answer. The
first run of sweeps starts from one table for each pair; the second goes on from its tables, with
the totals of these, and averages the predictive probabilities of its samples.

The documents' words stream past the blocks in portions, and a block answers each portion with one
row of sums by document. A pair not seen in training has the probability ``(s + d T) / (s + C)`` of
its restaurant times ``P(w)``. Of one that was seen, the first factor is taken out. As the words of a text
are its contexts too, one place on, a block adds that factor for the word as a context, whose totals it asks
for as well; so nobody needs a table of all restaurants. Blocks of frequent words have their documents
split among several tasks, each of which draws the same samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import SAVED, remove_tables, saved, ship_package, word_count

#: Text for which the words of one block are sampled together, and blocks to one task that adds up totals of restaurants.
PART_BYTES, OWNER_BLOCKS = 8 << 20, 2
#: Discount and strength of the restaurants and of the parent.
D, S, D0, S0 = 0.7, 20.0, 0.6, 10.0
#: Sweeps before the totals are summed, before samples count, and that count.
FIRST, BURN, SAMPLES = 4, 3, 4
#: Customers of a pair up to which all numbers of tables are weighed, and proposals in a sweep above.
WHOLE_ROWS, TRIES = 2048, 8

#: Text that a task takes apart at once, and pairs that it sums up or scores at once.
DEAL_BYTES, SUM_PAIRS, SCORE_PAIRS = 8 << 20, 1 << 20, 1 << 18

#: A block of more training tokens, and of more than this part of all, is split for scoring.
SPLIT_TOKENS, SPLIT_PART = 4 << 20, 4096

#: The number of the end; the context before the first word is the end's.
END = 1


def numbers(text: str | None) -> np.ndarray:
    """48-bit hashes of the words of a text, then the end."""
    words = text.encode().lower().split() if text else []
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(16)
    return np.append(np.maximum(hashed, np.uint64(2)), np.uint64(END))


def contexts(words: np.ndarray) -> np.ndarray:
    """The word before each, the end's before the first."""
    return np.concatenate([words[-1:], words[:-1]])


def _part(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _dealt(words: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by part, as it was within each, and the edges of the parts in it."""
    part = _part(words, parts).astype(np.uint16 if parts < 1 << 16 else np.int64)
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


#: Word and context share 12 bytes: the word and the upper 16 bits of the context, and the other 32 bits.
_UPPER, _LOWER = np.uint64(16), np.uint64(32)


def _joined(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return words << _UPPER | before >> _LOWER, before.astype(np.uint32)


def _context_of(pairs: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (pairs & np.uint64(0xFFFF)) << _LOWER | rest.astype(np.uint64)


def _names(pairs: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """64-bit names of pairs."""
    mixed = pairs * np.uint64(0x9E3779B97F4A7C15) ^ (rest.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


#: What a block says of the words of a document that it has.
_SUMS = np.dtype([("place", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])

def _places_in_order(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The places of numbers, in long runs in order, among known ones, all in order, or one past the last."""
    found = np.searchsorted(known, asked)
    found[np.append(known, np.uint64(0))[found] != asked] = len(known)
    return found


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The same of numbers in any order. They are looked for in their order, which is several times faster."""
    order = np.argsort(asked)
    places = np.empty(len(asked), np.int64)
    places[order] = _places_in_order(known, asked[order])
    return places


#: The sums of a block, answers to it (by who answers) and documents, in this order.
BLOCK, DOCUMENTS = -1, (1 << 31) - 1
_LONGS = ("tokens", "seats", "kinds", "portion")
_BINARIES = {"places": np.dtype("<u4"), "pairs": np.dtype("<u8"), "rest": np.dtype("<u4"), "counts": np.dtype("<i8"), "tables": np.dtype("<i8")}
#: Rows between tasks. A block has pairs, counts and tables; an answer the totals of restaurants in ``counts`` and ``tables``;
#: a question the same of the block that asks, with the restaurants in ``pairs``; documents have pairs in order and the place of each one's document in the portion.
_ROW = pa.schema(
    [(name, pa.int32()) for name in ("part", "split", "ask")]
    + [(name, pa.int64()) for name in _LONGS]
    + [(name, pa.binary()) for name in _BINARIES]
)
_SQL_ROW = ", ".join(
    [f"{name} int" for name in ("part", "split", "ask")] + [f"{name} long" for name in _LONGS] + [f"{name} binary" for name in _BINARIES]
)


def _packed(array: np.ndarray) -> bytes:
    """The bytes of all numbers, most of which have theirs in common, plane by plane."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(packed: bytes | pa.Buffer, kind: np.dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _stored(name: str, array: np.ndarray) -> bytes:
    """An array of a row; of pairs, which are in order, the differences."""
    array = array.astype(_BINARIES[name], copy=False)
    return _packed(np.diff(array, prepend=array.dtype.type(0)) if name in ("pairs", "rest") else array) if len(array) else b""


def _read(name: str, stored: bytes | pa.Buffer) -> np.ndarray:
    if not len(stored):
        return np.zeros(0, _BINARIES[name])
    array = _unpacked(stored, _BINARIES[name])
    return np.cumsum(array, dtype=array.dtype) if name in ("pairs", "rest") else array


def _rows(rows: list[dict]) -> pa.RecordBatch:
    """Rows of numbers and arrays."""
    empty = dict.fromkeys(_ROW.names, 0) | dict.fromkeys(_BINARIES, b"")
    stored = ({name: _stored(name, x) if isinstance(x, np.ndarray) else x for name, x in row.items()} for row in rows)
    return pa.RecordBatch.from_pylist([empty | row for row in stored], _ROW)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in portions of ``DEAL_BYTES`` of text, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    portion = np.cumsum(sizes) // DEAL_BYTES
    edges = np.flatnonzero(np.diff(portion, prepend=-1)) if len(portion) else []
    for start, end in zip(edges, [*edges[1:], len(portion)], strict=True):
        yield batch.slice(start, end - start)


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _in_order(pairs: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The order by both numbers: by the first, then what ties in it by the second."""
    order = np.argsort(pairs)
    sorted_pairs = pairs[order]
    same = sorted_pairs[1:] == sorted_pairs[:-1]
    tied = np.flatnonzero(np.append(False, same) | np.append(same, False))
    if len(tied):
        some = order[tied]
        group = np.cumsum(np.append(True, pairs[some[1:]] != pairs[some[:-1]])).astype(np.uint64)
        order[tied] = some[np.argsort(group << _LOWER | rest[some])]
    return order


def _sum_pairs(pairs: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> Pairs:
    """Distinct pairs in order, with their counts."""
    order = _in_order(pairs, rest)
    pairs, rest = pairs[order], rest[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (rest[1:] != rest[:-1])
    edges = np.flatnonzero(new)
    return pairs[edges], rest[edges], np.add.reduceat(counts[order], edges) if len(edges) else counts[:0]


def _deal_sums(parts: int):
    """Blocks of pairs summed up over many documents of a task."""

    def dealt(words: list[np.ndarray]) -> pa.RecordBatch:
        pairs, rest = _joined(np.concatenate(words), np.concatenate([contexts(w) for w in words]))
        pairs, rest, counts = _sum_pairs(pairs, rest, np.ones(len(pairs), np.int64))
        order, edges = _dealt(pairs >> _UPPER, parts)
        some = ((p, order[edges[p] : edges[p + 1]]) for p in np.flatnonzero(np.diff(edges)).tolist())
        return _rows([{"part": p, "pairs": pairs[k], "rest": rest[k], "counts": counts[k]} for p, k in some])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, size = [], 0
        for portion in (part for batch in batches for part in _portions(batch)):
            for text in portion["text"]:
                words.append(numbers(text.as_py()))
                size += len(words[-1])
            if size > SUM_PAIRS:
                yield dealt(words)
                words, size = [], 0
        if words:
            yield dealt(words)

    return deal


def _deal_rows(parts: int, splits: dict[int, int]):
    """Blocks of the words of each document; the names of a portion's rows go along as a part of their own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        for number, portion in enumerate((part for batch in batches for part in _portions(batch)), task):
            texts = [numbers(text.as_py()) for text in portion["text"]]
            words, owner = np.concatenate(texts), np.repeat(np.arange(len(texts), dtype=np.uint32), [len(w) for w in texts])
            pairs, rest = _joined(words, np.concatenate([contexts(w) for w in texts]))
            ordered = _in_order(pairs, rest)
            pairs, rest, owner = pairs[ordered], rest[ordered], owner[ordered]
            order, edges = _dealt(pairs >> _UPPER, parts)
            spread = xxhash.xxh3_64_intdigest(number.to_bytes(8, "little"))
            about = {"ask": DOCUMENTS, "portion": number}
            rows = [about | {"part": -1, "split": spread % parts, "counts": portion["row"].to_numpy()}]
            for p in np.flatnonzero(np.diff(edges)).tolist():
                some = order[edges[p] : edges[p + 1]]
                row = {"part": p, "split": spread % splits.get(p, 1)}
                rows.append(about | row | {"places": owner[some], "pairs": pairs[some], "rest": rest[some]})
            yield _rows(rows)

    return deal


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers: Stirling's series, eight above."""
    x = np.asarray(x, np.float64)
    low = np.log(x)
    for k in range(1, 8):
        low = low + np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - 1 / 1260 / y**2) / y**2) / y - low


_ROWS = [np.zeros(0), np.zeros(1)]


def stirling_row(c: int) -> np.ndarray:
    """Logarithms of the weights of all seatings of ``c`` customers at 1, 2, ... ``c`` tables.

    They are generalised Stirling numbers: a further customer opens a table or joins one of ``t``
    with weight ``c - D t``.
    """
    while len(_ROWS) <= c:
        n, last = len(_ROWS) - 1, _ROWS[-1]
        joined = np.append(last + np.log(n - D * np.arange(1, n + 1)), -np.inf)
        _ROWS.append(np.logaddexp(joined, np.concatenate([[-np.inf], last])))
    return _ROWS[c]


_NODES = np.arange(0, 6.6, 0.06)


def log_stirling(c: int, tables: np.ndarray) -> np.ndarray:
    """The entries of ``stirling_row(c)`` for some numbers of tables, without the rows before.

    They are ``c! / (t! D^t)`` times the coefficient of ``x^c`` in ``f^t``, ``f = 1 - (1 - x)^D``,
    an integral along a hyperbola through the saddle: round the cut from 1 on, of which it keeps
    a distance of ``1 / c``, or round 0 if the saddle is nearer to that. ``s`` is ``1 - x``.
    """
    t = np.minimum(np.asarray(tables, np.float64), c - 1)[:, None]
    low, high = np.full_like(t, -60.0), np.full_like(t, np.log(c - 1.0))
    for _ in range(50):
        u = (low + high) / 2
        log_s = -np.logaddexp(0, u)
        above = t * D * np.exp(u + D * log_s) > c * -np.expm1(D * log_s)
        low, high = np.where(above, low, u), np.where(above, u, high)
    s, x = 1 / (1 + np.exp(low)), 1 / (1 + np.exp(-low))
    cut, q = s < 0.5, s**D
    bend = (c + 1) / x**2 - t * D * s ** (D - 2) * (q + D - 1) / np.expm1(D * np.log1p(-x)) ** 2
    width = np.minimum(np.minimum(s, x), 2 / np.sqrt(np.maximum(bend, 1e-300)))
    turn = np.where(cut, np.exp(1.13j), -np.exp(-1.13j))
    step = width * (turn.real * (np.cosh(_NODES) - 1) + 1j * turn.imag * np.sinh(_NODES))
    slope = width * (turn.real * np.sinh(_NODES) + 1j * turn.imag * np.cosh(_NODES))
    near = np.where(cut, s - step, x + step)
    log_near, log_other = np.log(near), np.log1p(-near)
    log_s, log_x = np.where(cut, log_near, log_other), np.where(cut, log_other, log_near)
    log_f = t * np.log(-np.expm1(D * log_s)) - (c + 1) * log_x
    top = log_f[:, :1].real
    parts = (np.exp(log_f - top) * slope).imag
    parts[:, 0] /= 2
    inside = np.maximum(parts.sum(1) * (_NODES[1] / np.pi), 1e-300)
    t = t[:, 0]
    found = log_gamma(c + 1.0) - log_gamma(t + 1) - t * np.log(D) + top[:, 0] + np.log(inside)
    return np.where(np.asarray(tables) < c, found, 0.0)


class Seating:
    """The tables of all pairs of a block."""

    def __init__(self, words: np.ndarray, context: np.ndarray, counts: np.ndarray, seed: int, tables: np.ndarray):
        """``context`` is the place of each pair's restaurant in the totals that are given later."""
        self.context, self.counts = context, counts.astype(np.int64)
        self.words, self.word = np.unique(words, return_inverse=True)
        self.random = np.random.default_rng(seed)
        self.tables = tables.astype(np.int64)
        order = np.argsort(self.counts, kind="stable")
        order = order[self.counts[order] > 1]
        size = self.counts[order]
        edges = np.flatnonzero(np.diff(size, prepend=0)).tolist()
        self.alike = [order[a:b] for a, b in zip(edges, [*edges[1:], len(order)], strict=bool(edges))]  # pairs by count; there may be none
        self.grids: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def parent(self) -> np.ndarray:
        return np.bincount(self.word, self.tables, len(self.words))

    def sweep(self, tables_of: np.ndarray, customers: float, own: np.ndarray) -> None:
        """All customers of each pair are seated anew, given the tables of all others.

        ``tables_of`` and ``customers`` are those of all restaurants and of the parent; ``own`` are
        the tables of each pair that they contain.
        """
        here = np.maximum(tables_of[self.context] - own, 0)  # other tables of the restaurant
        word = self.parent()[self.word] - self.tables  # other customers of the word at the parent
        everyone = np.maximum(customers - own, 0)
        for some in self.alike:
            c = int(self.counts[some[0]])
            if c > WHOLE_ROWS:
                for k in some.tolist():
                    self.tables[k] = self._seat_many(c, int(self.tables[k]), float(here[k]), float(word[k]), float(everyone[k]))
                continue
            most, before, row = max(1, (1 << 18) // c), np.arange(1, c), stirling_row(c)
            for now in (some[k : k + most, None] for k in range(0, len(some), most)):
                # What one more table adds, from 1 table on.
                more = np.log((S + D * (here[now] + before)) * (word[now] + before - D0) / (S0 + everyone[now] + before))
                weight = np.tile(row, (len(now), 1))
                weight[:, 1:] += np.cumsum(more, axis=1)
                weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
                drawn = self.random.random((len(now), 1)) * weight[:, -1:]
                self.tables[now[:, 0]] = 1 + np.minimum((weight <= drawn).sum(axis=1), c - 1)

    def _seat_many(self, c: int, tables: int, here: float, word: float, everyone: float) -> int:
        """The same for very many customers, by independent proposals that are taken or refused.

        They come from the conditional at some numbers of tables, about a standard deviation
        apart, with straight logarithms in between; any number of tables can be proposed.
        """
        if c not in self.grids:
            grid = np.unique(np.append(np.floor((np.arange(2, 2 * int(c**0.5) + 1) / 2) ** 2), c)).astype(np.int64)
            self.grids[c] = grid, log_stirling(c, grid)
        grid, row = self.grids[c]

        def others(t: np.ndarray) -> np.ndarray:
            parent = log_gamma(word + t - D0) - log_gamma(S0 + everyone + t)
            return log_gamma(S / D + here + t) + t * np.log(D) + parent

        at = row + others(grid)
        top = at.max()
        at -= top
        width = np.diff(grid)
        slope = np.diff(at) / width
        slope = np.where(np.abs(slope) < 1e-9, 1e-9, slope)
        # Sums over the numbers of tables from one of the grid up to the next; the last is alone.
        cell = np.append(np.exp(at[:-1]) * np.expm1(slope * width) / np.expm1(slope), np.exp(at[-1]))
        k = np.searchsorted(np.cumsum(cell), self.random.random(TRIES) * cell.sum(), side="right")
        k, chance = np.minimum(k, len(cell) - 1), self.random.random(TRIES)
        inner = np.minimum(k, len(slope) - 1)
        steps = np.floor(np.log1p(chance * np.expm1(slope[inner] * width[inner])) / slope[inner])
        steps = np.where(k < len(slope), np.clip(steps, 0, width[inner] - 1), 0).astype(np.int64)
        t = np.append(tables, grid[k] + steps)
        k = np.searchsorted(grid, t, side="right") - 1
        straight = at[k] + np.where(k < len(slope), slope[np.minimum(k, len(slope) - 1)], 0) * (t - grid[k])
        ratio = log_stirling(c, t) + others(t) - top - straight
        now = 0
        for new, chance in enumerate(np.log(1 - self.random.random(TRIES)), 1):
            if chance < ratio[new] - ratio[now]:
                now = new
        return int(t[now])

    def probabilities(self, tables_of: np.ndarray, customers_of: np.ndarray, customers: float) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair, and of each word by the parent alone."""
        base = (self.parent() - D0) / (S0 + customers)
        top = self.counts - D * self.tables + (S + D * tables_of[self.context]) * base[self.word]
        return top / (S + customers_of[self.context]), base


Row = dict[str, np.ndarray | int]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[Row]]]:
    """The rows of each part and split in turn."""

    def rows() -> Iterator[Row]:
        for batch in batches:
            plain = {name: batch[name].to_pylist() for name in _ROW.names if name not in _BINARIES}
            for place in range(len(batch)):
                row = {name: values[place] for name, values in plain.items()}
                yield row | {name: _read(name, batch[name][place].as_buffer()) for name in _BINARIES}

    yield from groupby(rows(), lambda row: (row["part"], row["split"]))


def _runs(rows: Iterator[Row], most: int) -> Iterator[list[Row]]:
    """Rows in runs of some ``most`` pairs."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row["pairs"])
        if size > most:
            yield some
            some, size = [], 0
    if some:
        yield some


def _block_row(part: int, pairs: np.ndarray, rest: np.ndarray, counts: np.ndarray, tables: np.ndarray) -> pa.RecordBatch:
    about = {"part": part, "ask": BLOCK, "tokens": int(counts.sum()), "seats": int(tables.sum())}
    words = pairs >> _UPPER
    kinds = int(np.count_nonzero(np.diff(words))) + 1
    return _rows([about | {"kinds": kinds, "pairs": pairs, "rest": rest, "counts": counts, "tables": tables}])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each block, at one table each."""
    for (part, _), rows in _by_block(batches):
        summed = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for some in _runs(rows, SUM_PAIRS):
            columns = zip(summed, ("pairs", "rest", "counts"), strict=True)
            summed = _sum_pairs(*(np.concatenate([array, *[row[name] for row in some]]) for array, name in columns))
        yield _block_row(part, *summed, np.ones(len(summed[0]), np.int64))


def _restaurants(block: Row, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Restaurants that a block asks for, those of its own words included, and of each pair; their order by owner and its edges."""
    words = block["pairs"] >> _UPPER
    words = words[np.flatnonzero(np.diff(words, prepend=np.uint64(0)))]
    wanted, at = np.unique(np.concatenate([_context_of(block["pairs"], block["rest"]), words]), return_inverse=True)
    return wanted, at[: len(block["pairs"])], *_dealt(wanted, owners)


def _ask(owners: int):
    """What each block knows of restaurants, for those who add up their totals."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), rows in _by_block(batches):
            for block in rows:
                wanted, at, order, edges = _restaurants(block, owners)
                customers, tables = (np.bincount(at, block[name], len(wanted)).astype(np.int64) for name in ("counts", "tables"))
                asked = []
                for owner in np.flatnonzero(np.diff(edges)).tolist():
                    some = order[edges[owner] : edges[owner + 1]]
                    about = {"part": part, "ask": owner, "tokens": block["tokens"]}
                    asked.append(about | {"pairs": wanted[some], "counts": customers[some], "tables": tables[some]})
                yield _rows(asked)

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of an owner's restaurants, for each block that asks, in the order in which it has asked."""

    def asked() -> Iterator[dict]:
        for batch in batches:
            yield from batch.select(["ask", "part", "tokens", "pairs", "counts", "tables"]).to_pylist()

    for owner, some in groupby(asked(), lambda row: row["ask"]):
        rows = list(some)
        names, at = np.unique(np.concatenate([_read("pairs", row.pop("pairs")) for row in rows]), return_inverse=True)
        totals = {"counts": np.zeros(len(names), np.int64), "tables": np.zeros(len(names), np.int64)}
        edges = [0]
        for row in rows:
            for name, total in totals.items():
                # A block names each restaurant once.
                said = _read(name, row.pop(name))
                total[at[edges[-1] : edges[-1] + len(said)]] += said
            edges.append(edges[-1] + len(said))
        for row, start, end in zip(rows, edges[:-1], edges[1:], strict=True):
            about = {"part": row["part"], "ask": owner, "tokens": row["tokens"]}
            yield _rows([about | {name: total[at[start:end]] for name, total in totals.items()}])


class _Opened:
    """The sums of a block with the totals of its restaurants, or an empty block."""

    def __init__(self, rows: Iterator[Row], owners: int, seed: int):
        self.rows = iter(rows)
        first = next(self.rows)
        if first["ask"] != BLOCK:
            self.rows = chain([first], self.rows)
            first = {name: np.zeros(0, kind) for name, kind in _BINARIES.items()}
        self.block = first
        self.wanted, at, order, edges = _restaurants(first, owners)
        self.customers_of, self.tables_of = np.zeros((2, len(self.wanted)))
        for owner in np.flatnonzero(np.diff(edges)).tolist():
            some, answer = order[edges[owner] : edges[owner + 1]], next(self.rows)
            if answer["ask"] != owner:
                raise RuntimeError(f"block without the answer of {owner}")
            self.customers_of[some], self.tables_of[some] = answer["counts"], answer["tables"]
        self.words = first["pairs"] >> _UPPER
        self.seats = Seating(self.words, at, first["counts"], seed, first["tables"])

    def backing(self, at: np.ndarray) -> np.ndarray:
        """The chance that a restaurant leaves to its parent."""
        return (S + D * self.tables_of[at]) / (S + self.customers_of[at])


def _seat(owners: int, seated: int):
    """The first sweeps. Tables of all blocks are taken to grow as those here do."""

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), rows in _by_block(batches):
            opened = _Opened(rows, owners, part)
            seats = opened.seats
            for _ in range(FIRST):
                grown = seats.tables.sum() / len(seats.tables)
                seats.sweep(opened.tables_of * grown, seated * grown, seats.tables)
            yield _block_row(part, opened.block["pairs"], opened.block["rest"], seats.counts, seats.tables)

    return seat


def _score(owners: int, total: int, customers: int, kinds: int):
    unseen = (S0 + D0 * kinds) / (S0 + customers)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), rows in _by_block(batches):
            if part < 0:
                for row in rows:
                    yield pa.RecordBatch.from_pydict({"portion": [row["portion"]], "part": pa.array([-1], pa.int32()), "sums": [row["counts"].tobytes()]})
                continue
            opened = _Opened(rows, owners, part + 1_000_003)
            seats = opened.seats
            before, seated = seats.tables.copy(), np.zeros(len(seats.tables))
            of_word = np.zeros(len(seats.words))
            for k in range(BURN + SAMPLES):
                seats.sweep(opened.tables_of, customers, before)
                if k >= BURN:
                    some, base = seats.probabilities(opened.tables_of, opened.customers_of, customers)
                    seated += some / SAMPLES
                    of_word += base / SAMPLES
            times = np.append(np.bincount(seats.word, seats.counts, len(seats.words)), 0.0)
            # One entry more, for what training lacks: such a word is no restaurant either.
            words, last_word = seats.words, len(seats.words)
            leaves = np.append(np.log10(opened.backing(np.searchsorted(opened.wanted, words))), 0.0)
            of_word = np.log10(np.append(of_word, unseen))
            names = _names(opened.block["pairs"], opened.block["rest"])
            order = np.argsort(names)
            names, last_pair = names[order], len(order)
            of_pair = np.append((np.log10(seated) - np.log10(opened.backing(seats.context)))[order], 0.0)
            bases = np.log10((times + 0.1) / (total + 0.1 * (kinds + 1)))
            rows = opened.rows
            del opened, seats, order, seated, before
            for some in _runs(rows, SCORE_PAIRS):
                pairs, rest = (np.concatenate([row[name] for row in some]) for name in ("pairs", "rest"))
                edges = np.cumsum([0, *[int(row["places"].max()) + 1 for row in some]])
                owner = np.concatenate([row["places"] + edge for row, edge in zip(some, edges[:-1], strict=True)])
                # The pairs of each row are in order, and so are their words; their names are not.
                at, place = _places_in_order(words, pairs >> _UPPER), _places(names, _names(pairs, rest))
                chance = np.where(place < last_pair, of_pair[place], of_word[at]) + leaves[at]
                here = np.flatnonzero(np.bincount(owner))
                cuts = np.searchsorted(here, edges)
                sums = np.zeros(len(here), _SUMS)
                sums["place"] = here - np.repeat(edges[:-1], np.diff(cuts))
                for name, x in (("known", at < last_word), ("base", bases[at]), ("score", chance)):
                    sums[name] = np.bincount(owner, x)[here]
                yield pa.RecordBatch.from_pydict(
                    {"portion": [row["portion"] for row in some], "part": pa.array([part] * len(some), pa.int32())}
                    | {"sums": [_packed(sums[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]}
                )

    return score


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of a portion, from what all blocks say of it; the names of its rows come first."""
    said = ((portion, sums) for batch in batches for portion, sums in zip(batch["portion"].to_pylist(), batch["sums"], strict=True))
    for _, some in groupby(said, lambda x: x[0]):
        rows = np.frombuffer(next(some)[1].as_buffer(), "<i8")
        total = {name: np.zeros(len(rows)) for name in _SUMS.names[1:]}
        for _, buffer in some:
            sums = _unpacked(buffer.as_buffer(), _SUMS)
            for name, x in total.items():
                x[sums["place"]] += sums[name]
        yield pa.RecordBatch.from_pydict({"row": rows, "known": total["known"].astype(np.int64), "base": total["base"], "score": total["score"]})


def score_texts(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity`` of each row.

    Documents whose crc32 of the id as text is a multiple of 10 are held out, the others train.
    A text is its words in lower case (A-Z) and one end; NULL and empty texts are the end alone.
    Very long texts are a portion each, and are dealt out word by word like all others.
    Rows with a NULL id train. Repeated rows each train and each get their score; further columns
    are ignored; no rows give no rows. If no row trains, every word is unseen.
    """
    ship_package(spark)
    identity = F.col(id_column)
    rows = docs.select(
        identity.alias("id"),
        F.col(text).alias("text"),
        F.xxhash64(identity, F.col(text)).alias("row"),
        F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 10 == 0, F.lit(False)).alias("held_out"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))
    owners = -(-parts // OWNER_BLOCKS)

    def with_totals(blocks: DataFrame) -> DataFrame:
        asked = blocks.mapInArrow(_ask(owners), _SQL_ROW).repartition(owners, "ask").sortWithinPartitions("ask", "part")
        return blocks.unionByName(asked.mapInArrow(_answer, _SQL_ROW))

    def numbers_of(blocks: DataFrame) -> list[int]:
        return [*blocks.agg(*[F.coalesce(F.sum(name), F.lit(0)) for name in ("tokens", "seats", "kinds")]).first()]

    training = rows.where("NOT held_out").select("text").mapInArrow(_deal_sums(parts), _SQL_ROW)
    summed = training.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_sum_blocks, _SQL_ROW)
    blocks = saved(spark, summed, "word-blocks")
    first = with_totals(blocks).repartition(parts, "part").sortWithinPartitions("part", "ask")
    blocks = saved(spark, first.mapInArrow(_seat(owners, numbers_of(blocks)[1]), _SQL_ROW), "seated-blocks")
    remove_tables(spark, SAVED[-2:-1])  # the blocks before they were seated
    total, customers, kinds = numbers_of(blocks)
    most = max(SPLIT_TOKENS, total // SPLIT_PART)
    # No more than SPLIT_PART blocks can have more than that part of all tokens each.
    heavy = blocks.where(F.col("tokens") > most).select("part", F.ceil(F.col("tokens") / most).cast("int").alias("splits"))
    splits = {row["part"]: row["splits"] for row in heavy.collect()}
    times = F.greatest(F.ceil(F.col("tokens") / most), F.lit(1)).cast("int")
    sampled = with_totals(blocks).withColumn("split", F.explode(F.sequence(F.lit(0), times - 1)))
    everything = sampled.unionByName(rows.select("row", "text").mapInArrow(_deal_rows(parts, splits), _SQL_ROW))
    everything = everything.repartition(parts + sum(splits.values()), "part", "split").sortWithinPartitions("part", "split", "ask")
    said = everything.mapInArrow(_score(owners, total, customers, kinds), "portion long, part int, sums binary")
    partial = said.repartition("portion").sortWithinPartitions("portion", "part").mapInArrow(
        _gather, "row long, known long, base double, score double"
    )
    sums = [F.sum(c).alias(f"_{c}") for c in ("known", "base", "score")]
    partial = saved(spark, partial.groupBy("row").agg(*sums, F.count(F.lit(1)).alias("_rows")), "scores")
    light = rows.select("id", "row", "held_out", (word_count(F.col("text")) + 1).alias("n_tokens"))
    # Equal rows have summed up together; each takes its part.
    score = F.col("_score") / F.col("_rows")
    return light.join(partial, "row").select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        F.round(F.col("_known") / F.col("_rows")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("_base") / F.col("_rows")).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
