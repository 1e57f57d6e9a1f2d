"""External induced sorting of sampled suffixes and of the positions before them.

A *sample* is a position of a text with the bytes around it: ``LEFT`` before and ``RIGHT`` from it on. The suffixes at the samples
are sorted first, by the same induction one level up, where a symbol is a word of eight bytes: from the last word to the first,
the order of a suffix follows from its first symbol and the place of the suffix one symbol further on. Then the order of
the positions before the samples is induced byte by byte in the same way. So every position is sorted once, by one symbol.

Tuples of a suffix (next symbol, place of its successor, the symbols still to come, where it came from) travel in disk-backed
priority queues: a queue holds a bounded number of them and writes sorted runs to files beyond that, which are merged when it is
drained. With the order goes, for each suffix, the number of bytes it has in common with the one before it: that of their
successors, which is the smallest value between the two, plus the symbol.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

LEFT, SAMPLE, RIGHT = 26, 24, 50
WORDS = -(-RIGHT // 8)
#: Tuples that a queue holds in memory.
MEMORY = 1 << 20

_WHERE = [("key", "<u8"), ("rank", "<u8"), ("doc", "<i8"), ("block", "<i8"), ("at", "<u4"), ("low", "u1"), ("high", "u1"), ("left", "u1", (LEFT,))]
SEED = np.dtype([*_WHERE, ("right", "<u8", (WORDS,))])
SUFFIX = np.dtype([*_WHERE, ("group", "<u8")])


def ascending(key: np.ndarray) -> np.ndarray:
    """Stable order of unsigned numbers; keys with room for the row number beside them are sorted by value."""
    n = len(key)
    if n < 2:
        return np.arange(n)
    low = key.min()
    bits, span = int(n).bit_length(), int(key.max() - low).bit_length()
    if bits + span > 64:
        return np.argsort(key, kind="stable")
    both = np.sort(((key - low) << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64)


class Queue:
    """Tuples come out by ascending key, equal keys in the order in which they went in."""

    def __init__(self, folder: str | None, memory: int = MEMORY):
        self.folder, self.memory = folder, memory
        self.waiting: list[np.ndarray] = []
        self.size = self.held = 0
        self.runs: list = []

    def push(self, rows: np.ndarray) -> None:
        """Add tuples; beyond ``memory`` of them a sorted run goes to disk."""
        if not len(rows):
            return
        self.waiting.append(rows)
        self.size += len(rows)
        self.held += len(rows)
        if self.held >= self.memory:
            self._spill()

    def _sorted(self) -> np.ndarray:
        rows = np.concatenate(self.waiting) if len(self.waiting) > 1 else self.waiting[0]
        self.waiting, self.held = [], 0
        return rows[ascending(rows["key"])]

    def _spill(self) -> None:
        if self.folder is None:
            raise ValueError("this shard is larger than memory: spark.checkpoint.dir must be a mounted file system, or take more shards")
        file = tempfile.TemporaryFile(dir=self.folder)
        kind = self.waiting[0].dtype
        self._sorted().tofile(file)
        file.seek(0)
        self.runs.append((file, kind))

    def drain(self) -> Iterator[np.ndarray]:
        """Blocks of tuples in order; the queue is empty afterwards."""
        if not self.runs:
            if self.waiting:
                yield self._sorted()
            return
        if self.waiting:
            self._spill()
        count = max(1, self.memory // len(self.runs))
        more = [lambda f=f, k=k: np.fromfile(f, dtype=k, count=count) for f, k in self.runs]
        front = [read() for read in more]
        while any(len(x) for x in front):
            bound = min(x["key"][-1] for x in front if len(x))
            cut = [int(np.searchsorted(x["key"], bound, "left")) for x in front]
            if any(cut):
                rows = np.concatenate([x[:c] for x, c in zip(front, cut)])
                front = [x[c:] for x, c in zip(front, cut)]
                yield rows[ascending(rows["key"])]
                continue
            for i, read in enumerate(more):  # nothing below the bound: all tuples that equal it, run by run
                while len(front[i]) and front[i]["key"][0] == bound:
                    c = int(np.searchsorted(front[i]["key"], bound, "right"))
                    rows, front[i] = front[i][:c], front[i][c:]
                    yield rows
                    front[i] = front[i] if len(front[i]) else read()
        for file, _ in self.runs:
            file.close()
        self.runs = []


def smallest(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest of ``values[low:high + 1]`` for each pair, by tables of minima over doubling stretches."""
    out = np.empty(len(low), dtype=values.dtype)
    if not len(low):
        return out
    start = int(low.min())
    table, low, high = values[start : int(high.max()) + 1], low - start, high - start
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
    return out


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes two words share."""
    x = a ^ b
    return sum((x < np.uint64(1 << (8 * i))).astype(np.uint8) for i in range(1, 8)).astype(np.uint8) + (x == 0)


class Order:
    """One round: takes tuples in order and works out what neighbours have in common, from the round before."""

    def __init__(self, size: int, before: np.ndarray, symbol: int):
        self.shared, self.before, self.symbol = np.empty(size, dtype=np.uint8), before, symbol
        self.done, self.key, self.rank = 0, None, None

    def take(self, rows: np.ndarray) -> np.ndarray:
        """Number the tuples and return the common prefix of each with the tuple before it."""
        key, rank = rows["key"], rows["rank"].astype(np.int64)
        last_key = np.r_[key[:1] if self.key is None else self.key, key[:-1]]
        last_rank = np.r_[rank[:1] if self.rank is None else self.rank, rank[:-1]]
        shared = _equal_bytes(key, last_key) if self.symbol == 8 else np.zeros(len(rows), dtype=np.uint8)
        same = np.flatnonzero(key == last_key)
        same = same[1:] if self.key is None else same
        shared[same] = self.symbol + smallest(self.before, last_rank[same] + 1, rank[same])
        if self.key is None:
            shared[0] = 0
        self.key, self.rank = key[-1:].copy(), rank[-1:].copy()
        self.shared[self.done : self.done + len(rows)] = shared
        rows["rank"] = np.arange(self.done, self.done + len(rows))
        self.done += len(rows)
        return shared


class Repeats:
    """Collects positions whose first ``length`` bytes are also found in a document with a smaller key."""

    def __init__(self, length: int):
        self.length = length
        self.rest: tuple[np.ndarray, ...] | None = None
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def take(self, rows: np.ndarray, shared: np.ndarray, distance: int) -> None:
        """Neighbours in order that share ``length`` bytes form a class; the last class stays open until the next block."""
        new = (rows["doc"], rows["block"], rows["at"] - np.uint32(distance), rows["low"] <= distance, shared >= self.length)
        doc, block, at, counts, joined = new if self.rest is None else map(np.concatenate, zip(self.rest, new))
        first = np.flatnonzero(~joined)
        cut = first[-1] if len(first) else 0
        self.rest = tuple(x[cut:].copy() for x in (doc, block, at, counts, joined))
        self._close(*(x[:cut] for x in (doc, block, at, counts, joined)))

    def end(self) -> None:
        """Close the last class of a round."""
        if self.rest is not None:
            self._close(*self.rest)
        self.rest = None

    def _close(self, doc, block, at, counts, joined) -> None:
        if not len(doc):
            return
        joined = joined.copy()
        joined[0] = False
        first = np.flatnonzero(~joined)
        least = np.minimum.reduceat(np.where(counts, doc, np.iinfo(np.int64).max), first)
        hit = np.flatnonzero(counts & (doc > np.repeat(least, np.diff(np.r_[first, len(doc)]))))
        if len(hit):
            self.found.append((block[hit], at[hit]))
            self.size += len(hit)


def _repeat_rounds(seeds: Queue, folder: str | None, memory: int, length: int) -> Iterator[Repeats]:
    found = Repeats(length)
    shared = np.zeros(seeds.size, dtype=np.uint8)
    suffixes, groups = Queue(folder, memory), 0
    for word in range(WORDS - 1, -1, -1):
        order, following = Order(seeds.size, shared, 8), Queue(folder, memory)
        for rows in seeds.drain():
            common = order.take(rows)
            if word:
                rows["key"] = rows["right"][:, word - 1]
                following.push(rows)
                continue
            group = np.cumsum(common < SAMPLE) + (groups - 1 if groups else -1)
            groups = int(group[-1]) + 1
            found.take(rows, common, 0)
            rest = rows["high"] > 0
            made = np.empty(int(rest.sum()), dtype=SUFFIX)
            for name, *_ in _WHERE:
                made[name] = rows[name][rest]
            made["group"] = group[rest]
            made["key"] = (made["group"] << np.uint64(8)) | made["left"][:, 0]
            suffixes.push(made)
        shared, seeds = order.shared, following if word else seeds
    found.end()
    yield found
    for distance in range(1, LEFT + 1):
        order, following = Order(suffixes.size, shared, 1), Queue(folder, memory)
        for rows in suffixes.drain():
            found.take(rows, order.take(rows), distance)
            rows = rows[rows["high"] > distance]
            if len(rows):
                rows["key"] = (rows["group"] << np.uint64(8)) | rows["left"][:, distance]
                following.push(rows)
            if found.size >= memory:
                yield found
        found.end()
        yield found
        shared, suffixes = order.shared, following


def seed(doc: np.ndarray, block: int, at: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Tuples of samples: position ``at`` of ``block``; distances ``low`` to ``high`` before it are its own; the bytes ``around`` it."""
    rows = np.zeros(len(at), dtype=SEED)
    rows["doc"], rows["block"], rows["at"], rows["low"], rows["high"] = doc, block, at, low, high
    rows["left"] = around[:, LEFT - 1 :: -1] if LEFT else 0
    right = np.zeros((len(at), WORDS * 8), dtype=np.uint8)
    right[:, :RIGHT] = around[:, LEFT:]
    rows["right"] = right.view(">u8")
    rows["key"] = rows["right"][:, WORDS - 1]
    return rows


def repeats(samples: Iterator[np.ndarray], folder: str | None = None, memory: int = MEMORY, length: int = RIGHT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, position) of every own position of the samples whose ``length`` bytes are also own in a document with a smaller key."""
    seeds, count = Queue(folder, memory), 0
    for rows in samples:
        rows["rank"] = np.arange(count, count + len(rows))
        count += len(rows)
        seeds.push(rows)
    if not count:
        return
    for found in _repeat_rounds(seeds, folder, memory, length):
        yield from found.found
        found.found, found.size = [], 0
