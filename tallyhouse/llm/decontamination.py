"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

A window of a document has as many words as the benchmark item it is held against, and both are compared by their weighted
shingles of five words (weight: occurrences): sum of minima over sum of maxima. The sum of minima is at most the number of places
in the window whose shingle the item has, so windows with too few such places cannot reach the threshold; running sums of
the places leave, for each item, every start that still can, whatever the order of the words. The 192-bit SimHash of such a window
is looked up in an index over the items' fingerprints, cut into six blocks of 32 bits: fingerprints within ``radius`` bits
agree in one block up to ``radius // 6`` bits, so all are found. Candidates are verified exactly.

Windows at similarity 0.75 differ from their item in 33 bits on average, with a standard deviation of 5; the radius of 53 is
four of these off. Of random items, some 2 in 100 agree with a fingerprint in one of the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import WordHashes, batches, hold, mix, stage, windows

SHINGLE = 5
WORDS = 3
BLOCKS = 2 * WORDS
RADIUS = 53
#: Bytes of item text in one index, which every task holds; larger benchmarks are searched in several blocks.
BLOCK_BYTES = 8 << 20
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)

_words = WordHashes()


def word_hashes(text: bytes | None) -> np.ndarray:
    hold("decontamination", _words.clear)
    return _words.of((text or b"").lower().split())


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The 192 bits of each hash as -1 or 1."""
    wide = mix(hashes[:, None] ^ _SEEDS)
    return np.unpackbits(wide.astype("<u8").view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def simhash(votes: np.ndarray) -> np.ndarray:
    """Fingerprints, six blocks of 32 bits each, from rows of 192 sums."""
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u4")


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of how often each hash occurs."""
    both, first = np.concatenate([a, b]), np.zeros(len(a) + len(b), dtype=bool)
    first[: len(a)] = True
    names, at = np.unique(both, return_inverse=True)
    x, y = np.bincount(at[first], minlength=len(names)), np.bincount(at[~first], minlength=len(names))
    return float(np.minimum(x, y).sum() / max(1, np.maximum(x, y).sum()))


class Index:
    """Items with one length of shingles, and their fingerprints in blocks."""

    def __init__(self, items: list[tuple[int, np.ndarray]], shingle: int = SHINGLE, radius: int = RADIUS):
        """``items``: (id, hashes of words), each of ``shingle`` words or more."""
        self.shingle, self.radius = shingle, radius
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        self.sizes = np.array([len(w) for _, w in items], dtype=np.int64)
        self.shingles = [windows(w, shingle) for _, w in items]
        self.prints = simhash(np.array([_bits(s).sum(axis=0) for s in self.shingles])) if items else np.zeros((0, BLOCKS), "<u4")
        where = sorted({(h, n) for n, s in enumerate(self.shingles) for h in s.tolist()})
        self.known = np.array([h for h, _ in where], dtype=np.uint64)
        self.item = np.array([n for _, n in where], dtype=np.int64)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.known & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def touched(self, fingerprint: np.ndarray) -> np.ndarray:
        """Items that agree with a fingerprint in one of the blocks up to ``radius // 6`` bits."""
        return np.flatnonzero((np.bitwise_count(self.prints ^ fingerprint) <= self.radius // BLOCKS).any(axis=1))

    def candidates(self, fingerprint: np.ndarray) -> np.ndarray:
        """All items whose fingerprint is within the radius."""
        found = self.touched(fingerprint)
        return found[np.bitwise_count(self.prints[found] ^ fingerprint).sum(axis=1) <= self.radius]

    def starts(self, hashes: np.ndarray, threshold: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each item, the starts of all windows that can reach the threshold, and the most that the two can share."""
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
        low, high = np.searchsorted(self.known, hashes[at], "left"), np.searchsorted(self.known, hashes[at], "right")
        count = high - low
        entry = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(at) else at
        place, item = np.repeat(at, count), self.item[entry]
        order = np.argsort(item, kind="stable")
        place, item = place[order], item[order]
        out = {}
        names, first = np.unique(item, return_index=True)
        for n, mine in zip(names.tolist(), np.split(place, first[1:])):
            whole = int(self.sizes[n]) - self.shingle + 1
            wide = min(whole, len(hashes))
            least = threshold * (whole + wide) / (1 + threshold) - 1e-9
            if len(mine) < least:
                continue
            hits = np.zeros(len(hashes) + 1, dtype=np.int64)
            hits[mine + 1] = 1
            hits = np.cumsum(hits)
            shared = hits[wide:] - hits[: len(hits) - wide]
            good = np.flatnonzero(shared >= least)
            if len(good):
                out[n] = good, shared[good]
        return out

    def search(self, words: np.ndarray, threshold: float) -> list[tuple[int, int, int, float]]:
        """(item id, first word, words, similarity) of the best window of each item at ``threshold`` or more; ties: the first."""
        if len(words) < self.shingle or not len(self.ids):
            return []
        hashes, out = windows(words, self.shingle), []
        for n, (starts, shared) in self.starts(hashes, threshold).items():
            whole = int(self.sizes[n]) - self.shingle + 1
            wide = min(whole, len(hashes))
            best, where = 0.0, -1
            base = int(starts[0])
            votes = np.vstack([np.zeros((1, 64 * WORDS), np.int32), np.cumsum(_bits(hashes[base : int(starts[-1]) + wide]), axis=0, dtype=np.int32)])
            marks = simhash(votes[starts - base + wide] - votes[starts - base])
            for i in np.lexsort((starts, -shared)).tolist():
                if shared[i] / (whole + wide - shared[i]) < best:
                    break
                if n in self.candidates(marks[i]):
                    start = int(starts[i])
                    alike = weighted_similarity(hashes[start : start + wide], self.shingles[n])
                    if alike >= threshold and (alike > best or alike == best and start < where):
                        best, where = alike, start
            if where >= 0:
                out.append((int(self.ids[n]), where, int(min(self.sizes[n], len(words))), best))
        return out


class Benchmark:
    """Indexes over one block of items: those of five words or more, and shorter ones as a whole, by their number of words."""

    def __init__(self, items: list[tuple[int, bytes]], radius: int = RADIUS):
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, text in items:
            w = word_hashes(text)
            if len(w):
                by.setdefault(min(len(w), SHINGLE), []).append((i, w))
        self.indexes = [Index(part, shingle, radius) for shingle, part in sorted(by.items())]

    def search(self, text: bytes | None, threshold: float) -> list[tuple[int, int, int, float]]:
        """Hits of all items in one text, by item id."""
        words = word_hashes(text)
        return sorted(hit for index in self.indexes for hit in index.search(words, threshold))


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator:
    """Broadcast indexes, one after the other, over items of ``BLOCK_BYTES`` of text at most (or one longer item)."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(key).cast("long").alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null")
    blocks, mark = 1, F.xxhash64("i", "t")
    while True:
        sizes = items.groupBy(F.pmod(mark, F.lit(blocks)).alias("b")).agg(F.sum(F.octet_length("t")).alias("s"), F.countDistinct("i", "t").alias("n")).collect()
        if all(r["s"] <= BLOCK_BYTES or r["n"] == 1 for r in sizes):
            break
        blocks *= 2
    for b in sorted(r["b"] for r in sizes) or [0]:
        rows = items.where(F.pmod(mark, F.lit(blocks)) == b).distinct().collect()
        yield spark.sparkContext.broadcast(Benchmark([(r["i"], bytes(r["t"])) for r in rows]))


def overlaps(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``contaminated``, and arrays ``item_ids``, ``first_words``, ``n_words``, ``similarities`` of the
    best window for each item it overlaps.

    Letters A-Z are lower-cased, words end at ASCII white space. A window of a text with fewer words than the item is the whole
    text. Items of fewer than five words are compared as one whole shingle of their length, so a short item is found
    wherever its words stand; items without words, NULL included, are found nowhere. NULL and empty texts overlap nothing; rows
    repeat as given and keep their key, NULL too; items with equal texts are all reported, equal rows of the benchmark once; extra
    columns are not read; an empty table of either kind gives no overlaps. A benchmark of several blocks is searched block by block,
    with the texts written in between, so a worker holds one index at a time.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
    found = rows.withColumn("hits", F.expr("cast(array() as array<struct<item:bigint,first:bigint,words:bigint,similarity:double>>)"))
    for b, index in enumerate(_blocks(benchmark, item_key, item_text)):
        found = stage(found, "overlaps") if b else found

        def convert(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            lists = [
                (old or []) + [dict(zip(("item", "first", "words", "similarity"), hit)) for hit in index.value.search(t, threshold)]
                for t, old in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, kind)], ["k", "t", "hits"])

        kind = pa.list_(pa.struct([("item", pa.int64()), ("first", pa.int64()), ("words", pa.int64()), ("similarity", pa.float64())]))
        found = found.mapInArrow(batches(convert), found.schema)
    found = found.select(F.col("k").alias(key), F.sort_array("hits").alias("hits"))
    return found.select(
        key, (F.size("hits") > 0).alias("contaminated"), F.col("hits.item").alias("item_ids"), F.col("hits.first").alias("first_words"),
        F.col("hits.words").alias("n_words"), F.col("hits.similarity").alias("similarities"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no item, unchanged, NULL and empty texts and repeated rows included. No join and no shuffle;
    a benchmark of several blocks is searched block by block, with the rows that are left written in between."""
    at = docs.columns.index(text)
    for b, index in enumerate(_blocks(benchmark, item_key, item_text)):
        docs = stage(docs, "clean") if b else docs

        def convert(batch: pa.RecordBatch, index=index) -> pa.RecordBatch:
            raw = batch.column(at).cast(pa.binary()).to_pylist()
            return batch.filter(pa.array([not index.value.search(t, threshold) for t in raw], pa.bool_()))

        docs = docs.mapInArrow(batches(convert), docs.schema)
    return docs
