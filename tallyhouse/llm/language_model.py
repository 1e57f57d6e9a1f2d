"""An n-gram language model as an Elias-Fano trie: vocabulary, contexts and their successors in memory-mapped levels.

Level one holds the 64-bit hashes of the training words in ascending order, cut into files by range; a word's id is
its rank. Level n holds, for each range of contexts, the successors of each context: the pair (context, successor) as
one ascending number, so the successors of a context are a contiguous run that is searched relative to the context. A second monotone
sequence points to where each context's run begins, which also tells how many successors it has. Beside them lie the contexts'
counts and quantised log probabilities.

In level two a context is a word and a successor a word's id. From level three on, a context is the position of the shorter
n-gram in the level above, and a successor is named relative to its own shorter context: its place in that context's run in the
level above, a number as small as the run. The order, the number of levels, is a parameter.

Probabilities are interpolated after Witten and Bell, from the longest context down to the word alone: what a context has not
seen is shared out by the probabilities after the context without its first word, at last by word frequency, and an
unknown word has the share of words among tokens. Words are counted, then every text is written once as the ids of its words; levels
are built from ids, one after the other, one task per range, from counts that each task has summed before the shuffle. The files lie in the shared folder and are mapped, not loaded: a task touches
the pages its texts need.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from math import ceil
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import eliasfano as ef
from tallyhouse.llm.base import discard, mix, stage, tidy
from tallyhouse.session import workspace

#: Tokens that a task sums before it hands on counts.
FLUSH = 2_000_000
#: Tokens per file of a level beyond the first to aim for.
SHARD = 4_000_000
#: Ids that are looked up together, at least where a task has as many.
CHUNK = 1_000_000
#: Words of more bytes are hashed one by one.
LONG = 256
#: Bins of the quantised log probabilities.
BINS = 256

_ALL = np.uint64((1 << 64) - 1)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts, one after the other, and how many words each text has. A-Z count as a-z.

    All words are hashed at once, eight bytes a step. Words of up to eight bytes that are as long never collide.
    """
    joined = (b"\n".join(t or b"" for t in texts) + b"\n").lower() + bytes(8)
    raw = np.frombuffer(joined, dtype=np.uint8, count=len(joined) - 8)
    gap = (raw == 32) | (raw - np.uint8(9) < 5)
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edge = edge if gap[0] else np.concatenate(([0], edge))
    start, length = edge[0::2], edge[1::2] - edge[0::2]
    bounds = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    sizes = np.diff(np.searchsorted(start, bounds))
    eight = np.ndarray(len(raw), dtype="<u8", buffer=joined, strides=(1,))  # the eight bytes from each place on
    hashes = mix(length.astype(np.uint64))
    live, step = np.flatnonzero(length <= LONG), 0
    while len(live):
        left = length[live] - step
        lane = eight[start[live] + step] & (_ALL >> (64 - 8 * np.minimum(left, 8)).astype(np.uint64))
        hashes[live] = mix(hashes[live] * np.uint64(0x9E3779B97F4A7C15) ^ lane)
        live, step = live[left > 8], step + 8
    for i in np.flatnonzero(length > LONG):
        hashes[i] = xxhash.xxh3_64_intdigest(joined[start[i] : start[i] + length[i]])
    return hashes, sizes


def shared_folder(spark, label: str) -> str:
    """A path in the shared folder that Python can map files from."""
    place = urlparse(workspace(spark, label))
    if place.scheme not in ("", "file"):
        raise ValueError("the model's files are memory-mapped: spark.checkpoint.dir must be a mounted file system")
    os.makedirs(place.path, exist_ok=True)
    return place.path


def _merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct keys, summed counts and, if given, the values of several blobs."""
    parts = [_unpack(b) for b in blobs]
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    values = None if parts[0][2] is None else np.concatenate([p[2] for p in parts])[order[first]]
    return keys[first], np.add.reduceat(counts, first), values


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _plain(raw: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n).T).view(kind).ravel()


def _pack(keys: np.ndarray, counts: np.ndarray, values: np.ndarray | None = None) -> bytes:
    """Ascending keys as differences, counts and perhaps a value of each key, byte planes apart, compressed."""
    planes = [np.diff(keys, prepend=np.uint64(0)).astype("<u8"), counts.astype("<u4")]
    planes += [] if values is None else [values.astype("<f4")]
    return zstandard.ZstdCompressor(level=1).compress(len(keys).to_bytes(8, "little") + b"".join(map(_planes, planes)))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    steps, counts = _plain(raw, "<u8", n, 8), _plain(raw, "<u4", n, 8 + 8 * n)
    values = _plain(raw, "<f4", n, 8 + 12 * n).astype(np.float64) if len(raw) > 8 + 12 * n else None
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64), values


_BLOBS = "shard int, blob binary"


def _dealt(keys: list[np.ndarray], shard: Callable[[np.ndarray], np.ndarray], values: list[np.ndarray] | None = None) -> pa.RecordBatch:
    """Keys summed, with the value of each, one blob for each shard."""
    if values:
        distinct, index, counts = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
        beside = np.concatenate(values)[index]
    else:
        distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
        beside = None
    shards = shard(distinct)
    spans = list(_runs(shards))
    blobs = [_pack(distinct[a:b], counts[a:b], None if beside is None else beside[a:b]) for _, a, b in spans]
    return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in spans], pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _one_task_each(blobs: DataFrame, shards: int) -> DataFrame:
    return blobs.repartitionById(shards, F.col("shard"))


def _by_range(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _gathered(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    blobs: dict[int, list[bytes]] = {}
    for batch in rows:
        for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            blobs.setdefault(shard, []).append(blob)
    for shard in list(blobs):
        yield shard, blobs.pop(shard)


@dataclass(frozen=True)
class Grams:
    """What the files of a level beyond the first share. ``sizes``: n-grams in each file; ``width``: bound of the successors."""

    contexts: int
    width: int
    shards: int
    sizes: tuple[int, ...] = ()

    def shard(self, contexts: np.ndarray) -> np.ndarray:
        return contexts * self.shards // max(self.contexts, 1)

    def first(self, shard: int) -> int:
        """First context of a shard."""
        return -(-shard * self.contexts // self.shards)


@dataclass(frozen=True)
class Model:
    """Where a trained model lies and what its files share. ``sizes``: words in each level-one file; ``grams``: levels from the second."""

    path: str
    sizes: tuple[int, ...]
    ends: int
    tokens: int
    grams: tuple[Grams, ...] = ()

    @property
    def order(self) -> int:
        return len(self.grams) + 1

    @property
    def n_words(self) -> int:
        return sum(self.sizes)

    @property
    def types(self) -> int:
        """Distinct training tokens, the end among them."""
        return self.n_words + (self.ends > 0)

    # ids beyond the words
    @property
    def end(self) -> int:
        return self.n_words

    @property
    def start(self) -> int:
        return self.n_words + 1

    @property
    def unknown(self) -> int:
        return self.n_words + 2


class Levels:
    """A model's mapped files; one per worker process."""

    def __init__(self, model: Model):
        self.model = model
        self.bases = np.concatenate(([0], np.cumsum(model.sizes))).astype(np.int64)
        self.starts = [np.concatenate(([0], np.cumsum(g.sizes))).astype(np.int64) for g in model.grams]
        self.one, self.more = {}, {}

    def _one(self, part: int):
        if part not in self.one:
            arrays, notes = ef.load(f"{self.model.path}/words-{part}")
            self.one[part] = (ef.Sequence(arrays, notes["bits"], notes["n"]), arrays["counts"])
        return self.one[part]

    def _grams(self, n: int, shard: int):
        if (n, shard) not in self.more:
            arrays, notes = ef.load(f"{self.model.path}/grams{n}-{shard}")
            self.more[n, shard] = (arrays, ef.Sequence(arrays, notes["bits"], notes["n"]), ef.Sequence(arrays, notes["point_bits"], notes["contexts"] + 1, "point_"))
        return self.more[n, shard]

    def numbers(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of texts, each with its end, one after the other, and how many ids each text has."""
        hashes, sizes = word_hashes(texts)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        found = np.full(len(distinct), self.model.unknown)
        for part, a, b in _runs(_by_range(distinct, len(self.model.sizes))):
            if self.model.sizes[part]:
                index, equal = self._one(part)[0].successor(distinct[a:b])
                found[a:b][equal] = self.bases[part] + index[equal]
        sizes = sizes + 1
        ids = np.full(int(sizes.sum()), self.model.end)
        inside = np.ones(len(ids), dtype=bool)
        inside[np.cumsum(sizes) - 1] = False
        ids[inside] = found[inverse]
        return ids, sizes

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often words (and the end) occur in training."""
        out = np.zeros(len(ids), dtype=np.int64)
        out[ids == self.model.end] = self.model.ends
        inside = np.flatnonzero(ids < self.model.n_words)
        parts = np.searchsorted(self.bases, ids[inside], side="right") - 1
        order = np.argsort(parts.astype(np.min_scalar_type(len(self.bases))), kind="stable")
        inside, parts = inside[order], parts[order]
        for part, a, b in _runs(parts):
            mine = inside[a:b]
            out[mine] = self._one(part)[1][ids[mine] - self.bases[part]]
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their counts; 0 means unknown, which has the share of types among tokens and types."""
        n, v = self.model.tokens, self.model.types
        return np.where(counts > 0, counts, max(v, 1)) / max(n + v, 1)

    def follow(self, n: int, contexts: np.ndarray, successors: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One level down: log10 probability of each successor after its context, quantised where the n-gram occurs in
        training; the n-gram's position in level ``n`` (-1: none), and its place in the context's run (-1: none).

        A context of -1 does not occur, a successor of -1 never follows. ``lower``: log10 probabilities after the shorter contexts.
        """
        grams, starts = self.model.grams[n - 2], self.starts[n - 2]
        asked = np.flatnonzero(contexts >= 0)
        out, at, place = lower.copy(), np.full(len(contexts), -1), np.full(len(contexts), -1)
        # each distinct n-gram is searched once; ascending contexts are ascending shards
        pairs, inverse = np.unique(contexts[asked] * (grams.width + 1) + successors[asked] + 1, return_inverse=True)
        context, successor = np.divmod(pairs, grams.width + 1)
        successor -= 1
        weight, value = np.zeros(len(pairs)), np.zeros(len(pairs))
        position, within = np.full(len(pairs), -1), np.full(len(pairs), -1)
        for shard, a, b in _runs(grams.shard(context)):
            if not grams.sizes[shard]:
                continue
            arrays, keys, points = self._grams(n, shard)
            local = context[a:b] - grams.first(shard)
            index, equal = keys.successor(local * grams.width + np.maximum(successor[a:b], 0))
            equal &= successor[a:b] >= 0
            # pairs of one context lie together: its run is looked up once
            own = np.flatnonzero(np.concatenate(([True], local[1:] != local[:-1])))
            each, pairs_each = local[own], np.diff(np.append(own, b - a))
            begin = _pointer(points, arrays, each)
            kinds = _pointer(points, arrays, each + 1) - begin
            share = np.log10(np.where(kinds > 0, np.maximum(kinds, 1) / (arrays["totals"][each] + np.maximum(kinds, 1)), 1))
            weight[a:b], begin = np.repeat(share, pairs_each), np.repeat(begin, pairs_each)
            found = a + np.flatnonzero(equal)
            index, begin = index[equal], begin[equal]
            value[found] = arrays["book"][arrays["bins"][index]]
            position[found], within[found] = starts[shard] + index, index - begin
        at[asked], place[asked] = position[inverse], within[inverse]
        out[asked] = np.where(at[asked] >= 0, value[inverse], lower[asked] + weight[inverse])
        return out, at, place

    def walk(self, ids: np.ndarray, begin: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token of texts that begin at ``begin``: context and successor in the level after ``order``, and its log10
        probability in a model of ``order`` levels."""
        contexts, successors, value = np.roll(ids, 1), ids, np.log10(self.unigram(counts))
        contexts[begin] = self.model.start if self.model.ends else -1
        contexts[contexts == self.model.unknown] = -1
        for n in range(2, order + 1):
            value, at, successors = self.follow(n, contexts, successors, value)
            contexts = np.roll(at, 1)
            contexts[begin] = -1
        return contexts, successors, value


def _pointer(points: ef.Sequence, arrays: dict, i: np.ndarray) -> np.ndarray:
    """Value of the pointer sequence at each index: low bits, and the position of the i-th one."""
    ones = arrays["point_ones"]
    word = np.searchsorted(ones, i, side="right") - 1
    left, bits = i - ones[word], points.high[word]
    place = np.zeros(len(i), dtype=np.uint64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((bits >> place) & np.uint64((1 << width) - 1)).astype(np.int64)
        skip = left >= below
        left = np.where(skip, left - below, left)
        place += np.where(skip, np.uint64(width), np.uint64(0))
    top = (word * 64 + place.astype(np.int64) - i).astype(np.uint64)
    return ((top << np.uint64(points.bits)) | points._low(i)).astype(np.int64)


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(sorted_values):
        first = np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1))
        for a, b in zip(first, [*first[1:], len(sorted_values)]):
            yield int(sorted_values[a]), int(a), int(b)


_OPEN: list[Levels] = []


def _levels(model: Model) -> Levels:
    if not _OPEN or _OPEN[0].model != model:
        _OPEN[:] = [Levels(model)]
    return _OPEN[0]


def _raw(text: str) -> Column:
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def _kind(model: Model) -> str:
    return "<u4" if model.unknown < 1 << 32 else "<u8"


def _numbered(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``ids``, the word ids of a text and its end as little-endian numbers, in place of ``t``."""
    others = [c for c in rows.columns if c != "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, kind = _levels(model), np.dtype(_kind(model))
        for batch in batches:
            ids, sizes = levels.numbers(batch.column("t").to_pylist())
            bounds = np.concatenate(([0], np.cumsum(sizes * kind.itemsize))).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), blobs], [*others, "ids"])

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in others)
    return rows.mapInArrow(run, kinds + "ids binary")


def _chunks(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]]:
    """Batches taken together: these, their ids one after the other, where each text begins, and how many ids it has."""
    held, size, width = [], 0, np.dtype(kind).itemsize

    def joined():
        blobs = [x for b in held for x in b.column("ids").to_pylist()]
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // width
        return held, np.frombuffer(b"".join(blobs), dtype=kind).astype(np.int64), np.cumsum(sizes) - sizes, sizes

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column("ids").nbytes // width
        if size > CHUNK:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def train(texts: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count, smooth and write a model of all texts with contexts of up to ``order - 1`` words. NULL texts count as empty: just an end."""
    model, numbered = _learn(texts.select(F.lit(True).alias("learn"), _raw(text).alias("t")), order)
    discard(numbered)
    return model


def _learn(rows: DataFrame, order: int) -> tuple[Model, DataFrame]:
    """A model of the texts ``t`` of rows that say ``learn``, and all rows with ids in place of texts, staged."""
    if order < 2:
        raise ValueError("a model has two levels at least")
    model = _level_one(rows.where("learn").select("t"))
    numbered = stage(_numbered(rows, model), "language-model-ids", codec="zstd")
    parts = len(model.sizes)
    shards = max(parts, ceil(model.tokens / SHARD))
    grams = Grams(model.n_words + 2, model.n_words + 3, shards)
    for n in range(2, order + 1):
        if grams.contexts * (grams.width + 1) >= 1 << 63:
            raise ValueError(f"n-grams of level {n} do not fit 63 bits")
        sizes, width = _level(numbered.where("learn").select("ids"), model, n, grams)
        model = replace(model, grams=(*model.grams, replace(grams, sizes=sizes)))
        grams = Grams(sum(sizes), width, shards)
    return model, numbered


def _level_one(raw: DataFrame) -> Model:
    """Count the words of the texts ``t`` and write level one."""
    spark = raw.sparkSession
    path = shared_folder(spark, "language-model")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def by_range(hashes: np.ndarray) -> np.ndarray:
        return _by_range(hashes, parts)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in rows:
            held.append(word_hashes(batch.column(0).to_pylist())[0])
            size += len(held[-1])
            if size > FLUSH:
                yield _dealt(held, by_range)
                held, size = [], 0
        if size:
            yield _dealt(held, by_range)

    def level_one(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in _gathered(rows):
            keys, counts, _ = _merged(blobs)
            # the range is encoded relative to nothing: high bits of a range cost one zero each, so hashes keep their full value
            arrays, bits = ef.encode(keys, 1 << 64)
            ef.save(f"{path}/words-{part}", arrays | {"counts": counts}, {"bits": bits, "n": len(keys)})
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["shard", "n", "total"])

    with tidy(spark):
        built = _one_task_each(raw.mapInArrow(count, _BLOBS), parts).mapInArrow(level_one, "shard long, n long, total long").collect()
    ends = raw.count()
    sizes = {r["shard"]: r["n"] for r in built}
    tokens = sum(r["total"] for r in built) + ends
    return Model(path, tuple(sizes.get(p, 0) for p in range(parts)), ends, tokens)


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bin for each value and the value of each bin: values themselves where ``BINS`` suffice, else means of bins of equal width."""
    book, bins = np.unique(values, return_inverse=True)
    if len(book) > BINS:
        low, high = book[0], book[-1]
        bins = np.minimum(((values - low) / (high - low) * BINS).astype(np.int64), BINS - 1)
        book = np.bincount(bins, weights=values, minlength=BINS) / np.maximum(np.bincount(bins, minlength=BINS), 1)
    return bins.astype(np.uint8), book


def _level(numbered: DataFrame, model: Model, n: int, grams: Grams) -> tuple[tuple[int, ...], int]:
    """Write level ``n`` below the levels of ``model``: n-grams in each file, and the most successors of a context."""

    def shard(keys: np.ndarray) -> np.ndarray:
        return grams.shard((keys // np.uint64(grams.width)).astype(np.int64))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, held, lower, size = _levels(model), [], [], 0
        for _, ids, begin, _ in _chunks(rows, _kind(model)):
            contexts, successors, value = levels.walk(ids, begin, levels.counts(ids), n - 1)
            seen = np.flatnonzero(contexts >= 0)  # all but the first words of texts, which have no context of this length
            held.append((contexts[seen] * grams.width + successors[seen]).astype(np.uint64))
            if n > 2:
                lower.append(value[seen].astype(np.float32))
            size += len(seen)
            if size > FLUSH:
                yield _dealt(held, shard, lower)
                held, lower, size = [], [], 0
        if size:
            yield _dealt(held, shard, lower)

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, width = _levels(model), grams.width
        for part, blobs in _gathered(rows):
            keys, counts, lower = _merged(blobs)
            first, stop = grams.first(part), grams.first(part + 1)
            keys -= np.uint64(first * width)
            local = (keys // np.uint64(width)).astype(np.int64)
            where = np.searchsorted(local, np.arange(stop - first + 1))
            run = np.diff(where)
            total = np.add.reduceat(np.append(counts, 0), where[:-1]) * (run > 0)
            # in level two the probability of the word alone, which is not sent along
            alone = levels.unigram(levels.counts((keys % np.uint64(width)).astype(np.int64))) if lower is None else 10.0**lower
            value = np.log10((counts + run[local] * alone) / (total[local] + run[local]))
            bins, book = quantised(value)
            pairs, bits = ef.encode(keys, (stop - first) * width)
            points, point_bits = ef.encode(where, len(keys) + 1)
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(points["high"]).astype(np.int64))[:-1]))
            arrays = pairs | {"point_" + k: a for k, a in points.items()} | {"point_ones": ones, "book": book, "bins": bins}
            arrays["totals"] = total.astype(np.min_scalar_type(int(total.max())))
            ef.save(f"{model.path}/grams{n}-{part}", arrays, {"bits": bits, "n": len(keys), "point_bits": point_bits, "contexts": stop - first})
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([int(run.max())], pa.int64())], ["shard", "n", "widest"])

    with tidy(numbered.sparkSession):
        built = _one_task_each(numbered.mapInArrow(count, _BLOBS), grams.shards).mapInArrow(write, "shard long, n long, widest long").collect()
    sizes = {r["shard"]: r["n"] for r in built}
    return tuple(sizes.get(p, 0) for p in range(grams.shards)), max((r["widest"] for r in built), default=0)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    NULL and empty texts are one token, the end. Rows repeat as given and keep their key, NULL too; extra columns are not
    read; an empty table gives no rows. A model of no texts gives every text probability 1. No shuffle.
    """

    rows = docs.select(F.col(key).alias("k"), _raw(text).alias("t"))
    return _scored(_numbered(rows, model), model).withColumnRenamed("k", key)


def _scored(numbered: DataFrame, model: Model) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(model)
        for held, ids, begin, sizes in _chunks(rows, _kind(model)):
            counts = levels.counts(ids)
            base = np.log10((counts + 1) / (model.tokens + model.types + 1))
            made = levels.walk(ids, begin, counts, model.order)[2]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column("k") for b in held]), pa.array(sizes), pa.array(np.add.reduceat((counts > 0).astype(np.int64), begin)),
                 pa.array(np.full(len(sizes), model.tokens, dtype=np.int64)), pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(made, begin))],
                ["k", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kind = numbered.schema["k"].dataType.simpleString()
    return numbered.mapInArrow(run, f"k {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text", order: int = 2) -> DataFrame:
    """Train on the rows where ``learn_from`` holds and score all rows. Texts become word ids once, for both."""
    learn = F.coalesce(learn_from, F.lit(False)).alias("learn")
    model, numbered = _learn(docs.select(F.col(key).alias("k"), learn, _raw(text).alias("t")), order)
    return _scored(numbered.select("k", "ids"), model).withColumnRenamed("k", key)
