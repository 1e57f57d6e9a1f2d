"""Periodic runs of words, found by online dyadic square catching.

Words are appended in order. At level ``k`` the completed blocks of ``2**k`` words have catchers, each in charge of squares with a
period of ``2**k`` to ``2**(k+1) - 1`` words whose first half holds the block. A new word completes one suffix window of
``2**k`` words on every level, and every such window has exactly one catcher in charge: that of the block before the last. If
block and window are equal, their distance is the period of a square. Windows are compared by names that are made of the names
of their halves, so a level costs a fixed number of array operations on the words just appended.

Squares of one period in neighbouring blocks merge; the ends of what they merge to are found by comparing ever shorter windows
(names again), and the words of each run are compared at last. A stretch that also has a smaller period is the run of that one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import WordHashes, batches, mix

#: Words appended at once, and words of the texts that are searched together.
CHUNK, GROUP = 1 << 16, 1 << 17
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_words = WordHashes(seed=12)


class Catchers:
    """Levels of window names over the words appended so far, and the squares caught by now."""

    def __init__(self, longest: int, total: int, exponent: int = 4):
        """``longest``: most words between two separators; periods above ``longest / exponent`` cannot make a run. ``total``: words to come."""
        self.depth = max(1, (longest // exponent).bit_length())
        self.space = [np.empty(total, dtype=np.uint64) for _ in range(self.depth)]
        self.names = [s[:0] for s in self.space]
        self.squares: list[tuple[np.ndarray, np.ndarray, int]] = []

    def append(self, words: np.ndarray) -> int:
        """Append names of words; returns the number of squares that they complete."""
        caught, fresh = 0, words
        for k in range(self.depth):
            size, known = 1 << k, len(self.names[k])
            if k:
                below, half = self.names[k - 1], size >> 1
                ready = max(known, len(below) - half)
                a, b = below[known:ready], below[known + half : ready + half]
                fresh = mix(a * _LEFT + b * _RIGHT + np.uint64(k))
            self.space[k][known : known + len(fresh)] = fresh
            self.names[k] = mine = self.space[k][: known + len(fresh)]
            at = np.arange(max(known, size), len(mine))
            block = ((at >> k) - 1) << k
            hit = np.flatnonzero(mine[at] == mine[block])
            if len(hit):
                self.squares.append((block[hit], at[hit] - block[hit], k))
                caught += len(hit)
        return caught

    def _same(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from ``x`` on equal those from ``y`` on."""
        total, n = np.zeros(len(x), dtype=np.int64), len(self.names[0])
        going = np.ones(len(x), dtype=bool)
        while going.any():  # a stretch may be longer than the largest window, so that is repeated
            for k in range(self.depth - 1, -1, -1):
                names = self.names[k]
                fits = going & (y + total < len(names))
                at = np.flatnonzero(fits)
                same = at[names[x[at] + total[at]] == names[y[at] + total[at]]]
                total[same] += 1 << k
                if k == self.depth - 1:
                    again = np.zeros(len(x), dtype=bool)
                    again[same] = True
            going = again & (y + total < n)
        return total

    def _same_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before ``x`` equal those before ``y``."""
        total = np.zeros(len(x), dtype=np.int64)
        going = np.ones(len(x), dtype=bool)
        while going.any():
            for k in range(self.depth - 1, -1, -1):
                size, names = 1 << k, self.names[k]
                at = np.flatnonzero(going & (x - total >= size))
                same = at[names[x[at] - total[at] - size] == names[y[at] - total[at] - size]]
                total[same] += size
                if k == self.depth - 1:
                    again = np.zeros(len(x), dtype=bool)
                    again[same] = True
            going = again
        return total

    def runs(self, least: int = 6, exponent: int = 4) -> np.ndarray:
        """Rows (start, length, period) of all runs of ``least`` words and ``exponent`` periods or more, by start and period."""
        found = [np.zeros((0, 3), dtype=np.int64)]
        words = self.names[0]
        for k in range(self.depth):
            mine = [(s, q) for s, q, level in self.squares if level == k]
            if not mine:
                continue
            block, period = np.concatenate([s for s, _ in mine]), np.concatenate([q for _, q in mine])
            order = np.lexsort((block, period))
            block, period = block[order], period[order]
            head = np.r_[True, (np.diff(block) != 1 << k) | (np.diff(period) != 0)]
            tail = np.r_[head[1:], True]
            start, period, end = block[head], period[head], block[tail] + (1 << k)
            start = start - self._same_before(start, start + period)
            end = end + self._same(end, end + period) + period
            good = end - start >= np.maximum(least, exponent * period)
            found.append(np.stack([start, end - start, period], axis=1)[good])
        rows = np.unique(np.concatenate(found), axis=0)
        # equal stretches: the smallest period comes first
        rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]] if len(rows) else rows
        exact = [(words[s : s + n - q] == words[s + q : s + n]).all() for s, n, q in rows.tolist()]
        return rows[np.array(exact, dtype=bool)] if len(rows) else rows


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words joined by spaces, without those that a run holds after its first period. ``runs``: start, length, period."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for s, n, q in runs:
        dropped[s + q] += 1
        dropped[s + n] -= 1
    return b" ".join([w for w, out in zip(words, (np.cumsum(dropped[:-1]) > 0).tolist()) if not out])


def runs_of(texts: list[list[bytes]], least: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs of several lists of words, found in one pass: between two texts stands a separator that equals nothing."""
    catchers = Catchers(max(map(len, texts), default=0), sum(map(len, texts)) + len(texts), exponent)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    waiting, size = [], 0
    for i, words in enumerate(texts):
        waiting += [_words.of(words), mix(np.array([i + 1], dtype=np.uint64) * _LEFT)]
        size += len(words) + 1
        if size >= CHUNK or i == len(texts) - 1:
            catchers.append(np.concatenate(waiting))
            waiting, size = [], 0
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, n, q in catchers.runs(least, exponent).tolist():
        i = int(np.searchsorted(ends, s, "right"))
        out[i].append((s - (int(ends[i - 1]) if i else 0), n, q))
    return out


def alike(texts: list[list[bytes]]) -> list[list[int]]:
    """Numbers of texts in groups of about ``GROUP`` words, texts of similar length together, as the longest sets the levels."""
    groups, size = [], GROUP
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if size >= GROUP:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += len(texts[i]) + 1
    return groups


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def repeated(text: bytes | None, loop_from: int | None, loop: int | None) -> list[bytes]:
    """Words of a text; with a loop, words from ``loop_from`` on are the next ``loop`` words over and over."""
    words = (text or b"").split()
    if loop_from is None or not words:
        return words
    turn = words[loop_from : loop_from + loop]
    return words[:loop_from] + (turn * (-(-(len(words) - loop_from) // loop)))[: len(words) - loop_from]


def planted(key: Column) -> tuple[Column, Column, Column]:
    """Whether a document's tail is made periodic, and the two numbers ``g % n`` and ``3 + g % 8`` come from: (yes, g, parts)."""
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")))
    g = F.floor(h / 10).cast("bigint")
    return h % 10 == 0, g, (g % 8 + 3).cast("bigint")


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, exponent: int = 4, plant: bool = False) -> DataFrame:
    """One row per document: ``key``, ``runs`` (start, length and period in words, by start and period), ``collapsed`` (the text's
    words joined by spaces, without those that a run holds after its first period).

    Words end at ASCII white space. A run is a stretch of consecutive words with smallest period ``q``, of ``least`` words and
    ``exponent`` periods or more, that no neighbouring word extends. ``plant`` makes the tails of a tenth of the documents
    periodic before the search (tests plant runs of every period so). NULL and empty texts have no words and no runs; rows repeat
    as given and keep their key, NULL too (it plants like empty text); extra columns are not read; an empty table gives no rows. A text is held by one task as a whole. Nothing is
    shuffled.
    """
    yes, g, parts = planted(F.col(key)) if plant else (F.lit(False), F.lit(0).cast("bigint"), F.lit(3).cast("bigint"))
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"), F.when(yes, g).alias("g"), parts.alias("parts"))
    kind = rows.schema["k"].dataType.simpleString()

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for t, g, parts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            n = len((t or b"").split()) if g is not None else 0
            texts.append(repeated(t, g % n, 1 + (n - g % n) // parts) if n else repeated(t, None, None))
        runs, collapsed = [None] * len(texts), [None] * len(texts)
        for group in alike(texts):
            for i, found in zip(group, runs_of([texts[i] for i in group], least, exponent)):
                runs[i], collapsed[i] = [dict(zip(("start", "length", "period"), r)) for r in found], collapse(texts[i], found)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, _RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["k", "runs", "collapsed"])

    found = rows.mapInArrow(batches(convert), f"k {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("k", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the run with the greatest exponent (ties: smaller start, then smaller period), and digests of runs and words."""

    def before(a: Column, b: Column) -> Column:
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        earlier = F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])
        return F.when(more > less, -1).when(more < less, 1).when(earlier, -1).otherwise(1)

    best = F.get(F.array_sort("runs", before), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select(key, "runs", "collapsed", best.alias("best"))
    return rows.select(
        key, F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
