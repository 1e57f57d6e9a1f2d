"""Repeated passages: bytes covered by a 50-byte string that also starts in a document with a smaller key are cut out.

The suffixes of a corpus do not fit one machine, so they are sorted in shards by content. Of the 27 places that a 24-byte sample
can have in a 50-byte window, the one with the smallest hash is the window's sample; equal windows have equal samples at equal
places, so windows only need to be sorted with windows of the same sample, and a sample goes to the shard of its hash together with
the few bytes around it that its windows reach. Each shard is sorted by ``induced``: samples first, the positions before them induced.

1. Texts are gathered into blocks of some megabytes, once.
2. Hashes of samples, each once a block, meet by hash: a sample found in one document alone is dead. One that is found very
   often is split: each of its windows goes to the shard of its own bytes.
3. Samples that live go to their shards. A block that holds the same stretch twice sends it once, for its smallest key; the
   others are known to be repeated there and then.
4. Repeated positions return to their blocks, whose texts are cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.base import mix, stage
from tallyhouse.llm.induced import LEFT, MEMORY, RIGHT, SAMPLE, repeats, seed
from tallyhouse.session import workspace

#: Bytes of text in a block, unless a single text is longer, and bytes looked at together.
BLOCK_BYTES, CHUNK_BYTES = 8 << 20, 1 << 20
#: Bytes of text whose samples meet in one shard.
SHARD_BYTES = 32 << 20
#: A sample that is found more often is split by window.
HOT = 4096
#: Stands for a NULL key: greater than all others.
NO_KEY = np.iinfo(np.int64).max
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_DEAD, _ALIVE, _HOT = 0, 1, 2
_SENT = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; numbers lie in planes of equal bytes, which compress better."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes, n: int, *types: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 40) if n else b"", 0, []
    for kind in map(np.dtype, types):
        plane = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel() if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return out


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number."""
    n = max(0, len(text) - 7)
    return np.ndarray(n, dtype="<u8", buffer=text, strides=(1,)).copy() if n else np.zeros(0, "<u8")


def samples(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, low, high, hash) of every sample of a block: it is the sample of the windows that start ``low`` to ``high`` bytes before it.

    ``ends``: where the documents of the block end; no window crosses an end.
    """
    parts: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
    free = np.r_[0, ends[:-1]]
    for start in range(0, max(0, len(text) - RIGHT + 1), CHUNK_BYTES):
        stop = min(start + CHUNK_BYTES, len(text) - RIGHT + 1)  # window starts of this piece
        eight = _eights(text[start : stop + RIGHT - 1])
        mixed = mix(eight[: -2 * 8] * _A + eight[8:-8] * _B + eight[16:] * _C)
        least = (mixed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(mixed), dtype=np.uint64)
        for step in (1, 2, 4, 8, LEFT + 1 - 16):  # of 27 places: stretches of 2, 4, 8, 16, then two of 16
            least = np.minimum(least[:-step], least[step:])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(stop - start + 1, dtype=np.int64)
        first, last = np.clip(free, start, stop) - start, np.clip(ends - RIGHT + 1, start, stop) - start
        good = first < last
        np.add.at(inside, first[good], 1)
        np.add.at(inside, last[good], -1)
        valid = np.cumsum(inside[:-1]) > 0
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        fresh[first[good]] = True
        head = np.flatnonzero(fresh & valid)
        after = np.flatnonzero(fresh | ~valid)
        tail = np.r_[after, len(at)][np.searchsorted(after, head, "right")] - 1
        parts.append((at[head] + start, at[head] - tail, at[head] - head, mixed[at[head]]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _names(hashes: np.ndarray) -> np.ndarray:
    """48 bits that say nothing about which hash is small."""
    return mix(hashes ^ _C) >> np.uint64(16)


def _shard(names: np.ndarray, shards: int) -> np.ndarray:
    return ((names * np.uint64(shards)) >> np.uint64(48)).astype(np.int64)


def _blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Texts gathered into blocks: ``block``, ``keys``, ``sizes``, ``n_bytes``, ``texts`` (compressed)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def made() -> pa.RecordBatch:
            whole = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()), "keys": pa.array([keys], pa.list_(pa.int64())),
                "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), "n_bytes": pa.array([size], pa.int64()), "texts": pa.array([whole], pa.binary()),
            })

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(k)
                texts.append(t or b"")
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield made()
                    number, keys, texts, size = number + 1, [], [], 0
        if keys:
            yield made()

    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("binary").alias("t"))
    return stage(rows.mapInArrow(gather, "block bigint, keys array<bigint>, sizes array<bigint>, n_bytes bigint, texts binary"), "repeats-blocks")


def _read(texts: bytes, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(texts), np.uint8), np.cumsum(sizes, dtype=np.int64)


def _known(text: np.ndarray, ends: np.ndarray) -> tuple:
    """Samples of a block with the number of their name, the names, whether a name is in several documents, and how often it is there."""
    at, low, high, hashes = samples(text, ends)
    names, inverse = np.unique(_names(hashes), return_inverse=True)
    doc = np.searchsorted(ends, at, "right")
    first, last = np.full(len(names), len(ends)), np.full(len(names), -1)
    np.minimum.at(first, inverse, doc)
    np.maximum.at(last, inverse, doc)
    return at, low, high, inverse, names, first != last, np.bincount(inverse, minlength=len(names)).astype(np.uint32)


def _verdicts(blocks: DataFrame, shards: int) -> DataFrame:
    """For each block, whether its names are dead, alive or hot, in their order."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                *_, names, several, count = _known(*_read(row["texts"], row["sizes"]))
                cut = np.searchsorted(_shard(names, shards), np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(cut)).tolist():
                    part = slice(cut[s], cut[s + 1])
                    steps = np.diff(names[part], prepend=np.uint64(0))
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "block": [row["block"]], "n": pa.array([len(steps)], pa.int64()), "names": [_pack(steps, several[part], count[part])]})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        steps, several, count = zip(*(_unpack(r["names"], r["n"], "<u8", "?", "<u4") for r in rows))
        every, inverse = np.unique(np.concatenate([np.cumsum(s, dtype=np.uint64) for s in steps]), return_inverse=True)
        alive = (np.bincount(inverse, minlength=len(every)) > 1) | (np.bincount(inverse, np.concatenate(several), len(every)) > 0)
        often = np.bincount(inverse, np.concatenate(count), len(every)) > HOT
        verdict = np.where(alive, np.where(often, _HOT, _ALIVE), _DEAD).astype(np.uint8)[inverse]
        at = 0
        for r in rows:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([r["shard"]], pa.int32()), "block": [r["block"]], "n": pa.array([r["n"]], pa.int64()), "verdict": [_pack(verdict[at : at + r["n"]])]})
            at += r["n"]

    sent = blocks.select("block", "sizes", "texts").mapInArrow(send, "shard int, block bigint, n bigint, names binary")
    return sent.repartitionById(shards, F.col("shard")).mapInArrow(judge, "shard int, block bigint, n bigint, verdict binary")


def _once(doc: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Whether a stretch also stands in a document of this block with a smaller key: same bytes, same own positions."""
    wide = np.zeros((len(doc), 80), dtype=np.uint8)
    wide[:, : LEFT + RIGHT], wide[:, 78], wide[:, 79] = around, low, high
    mark = np.zeros(len(doc), dtype=np.uint64)
    for i, word in enumerate(wide.view("<u8").T):
        mark = mix(mark ^ (word * _A + np.uint64(i)))
    order = np.lexsort((doc, mark))
    first = np.r_[True, mark[order][1:] != mark[order][:-1]] if len(order) else np.zeros(0, dtype=bool)
    of = np.empty(len(doc), dtype=np.int64)
    of[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    later = np.flatnonzero(doc > doc[of])
    known = np.zeros(len(doc), dtype=bool)
    known[later] = (wide[later] == wide[of[later]]).all(axis=1)
    return known


def _send(blocks: DataFrame, shards: int) -> DataFrame:
    """Living samples with the bytes around them by shard; stretches repeated within a block as results (``kind`` 0)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, ends = _read(row["texts"], row["sizes"])
                at, low, high, name, names, _, _ = _known(text, ends)
                verdict = np.zeros(len(names), dtype=np.uint8)
                cut = np.searchsorted(_shard(names, shards), np.arange(shards + 1))
                for v in row["verdicts"] or []:
                    verdict[cut[v["shard"]] : cut[v["shard"] + 1]] = _unpack(v["verdict"], v["n"], "u1")[0]
                live = np.flatnonzero(verdict[name])
                for piece in range(0, len(live), CHUNK_BYTES // 16):
                    yield from part(row, text, ends, names, verdict, *(x[live[piece : piece + CHUNK_BYTES // 16]] for x in (at, low, high, name)))

    def part(row, text, ends, names, verdict, at, low, high, name) -> Iterator[pa.RecordBatch]:
        keys = np.array([NO_KEY if k is None else k for k in row["keys"]], dtype=np.int64)
        hot = verdict[name] == _HOT
        own = high - low + 1
        spread = np.repeat(np.flatnonzero(hot), own[hot])  # a hot sample is sent window by window
        step = np.arange(len(spread)) - np.repeat(np.cumsum(own[hot]) - own[hot], own[hot])
        of = np.r_[np.flatnonzero(~hot), spread]
        low, high = np.r_[low[~hot], low[spread] + step], np.r_[high[~hot], low[spread] + step]
        at, name, cold = at[of], name[of], int((~hot).sum())
        doc = keys[np.searchsorted(ends, at, "right")]
        padded = np.r_[np.zeros(LEFT, np.uint8), text, np.zeros(RIGHT, np.uint8)]
        around = np.lib.stride_tricks.sliding_window_view(padded, LEFT + RIGHT)[at].copy()
        place = np.arange(LEFT + RIGHT)
        around[(place < LEFT - high[:, None]) | (place >= LEFT + RIGHT - low[:, None])] = 0
        shard = _shard(names[name], shards)
        window = np.zeros(len(of) - cold, dtype=np.uint64)
        for i in range(LEFT + RIGHT):  # the other bytes are zero, so these are the window's and its distance's
            window = mix(window ^ (around[cold:, i].astype(np.uint64) + np.uint64(i) * _B)) if len(window) else window
        shard[cold:] = _shard(window >> np.uint64(16), shards)
        known = _once(doc, low, high, around)
        if known.any():
            yield result(int(row["block"]) % shards, row["block"], (at - high)[known], (at - low)[known])
        left = np.flatnonzero(~known)
        left = left[np.argsort(shard[left], kind="stable")]
        cuts = np.searchsorted(shard[left], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            mine = left[cuts[s] : cuts[s + 1]]
            facts = _pack(at[mine].astype("<u4"), low[mine].astype("u1"), high[mine].astype("u1"), doc[mine])
            yield _row(s, 1, row["block"], len(mine), facts, zstandard.ZstdCompressor(level=1).compress(around[mine].tobytes()))

    return blocks.mapInArrow(send, "shard int, kind int, block bigint, n bigint, a binary, b binary")


def _row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SENT)], schema=_SENT)


def result(shard: int, block: int, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    """A row that says which windows of a block, from ``first`` to ``last`` each, are repeated."""
    return _row(shard, 0, block, len(first), _pack(first.astype("<u4"), last.astype("<u4")), b"")


def _sort(sent: DataFrame, shards: int, folder: str | None, memory: int) -> DataFrame:
    """Every shard sorted by induction; rows as ``result`` makes them."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []

        def arriving() -> Iterator[np.ndarray]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    if not row.column(1)[0].as_py():
                        ready.append(row)
                        continue
                    r = row.to_pylist()[0]
                    at, low, high, doc = _unpack(r["a"], r["n"], "<u4", "u1", "u1", "<i8")
                    around = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["b"]), np.uint8).reshape(-1, LEFT + RIGHT)
                    yield seed(doc, r["block"], at, low, high, around)

        for block, at in repeats(arriving(), folder, memory):
            yield from ready
            ready.clear()
            order = np.lexsort((at, block))
            block, at = block[order], at[order].astype(np.int64)
            new = np.r_[True, (np.diff(block) != 0) | (np.diff(at) != 1)]
            first, last, of = at[new], at[np.r_[new[1:], True]], block[new]
            cuts = np.r_[np.flatnonzero(np.diff(of, prepend=of[:1] - 1)), len(of)].tolist()
            for low, high in zip(cuts, cuts[1:]):
                yield result(0, int(of[low]), first[low:high], last[low:high])
        yield from ready

    return sent.repartitionById(shards, F.col("shard")).mapInArrow(sort, sent.schema)


def _cut(blocks: DataFrame, key: str) -> DataFrame:
    """Texts without the bytes of repeated windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, ends = _read(row["texts"], row["sizes"])
                found = [_unpack(r["a"], r["n"], "<u4", "<u4") for r in row["found"] or []]
                first, last = (np.concatenate([np.zeros(0, "<u4"), *x]) for x in (zip(*found) if found else ([], [])))
                edge = np.bincount(first, minlength=len(text) + 1) - np.bincount(last.astype(np.int64) + RIGHT, minlength=len(text) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                free, filled = np.r_[0, ends[:-1]], np.diff(ends, prepend=0) > 0
                starts, stops = np.r_[True, ~gone[:-1]][: len(text)], np.r_[~gone[1:], True][: len(text)]
                starts[free[filled]] = stops[ends[filled] - 1] = True  # a span ends with its document
                starts, stops = np.flatnonzero(gone & starts), np.flatnonzero(gone & stops) + 1
                kept, spans, body = [], [], text.tobytes()
                for s, e, low, high in zip(free.tolist(), ends.tolist(), np.searchsorted(starts, free).tolist(), np.searchsorted(starts, ends).tolist()):
                    spans.append([{"start": a - s, "length": b - a} for a, b in zip(starts[low:high].tolist(), stops[low:high].tolist())])
                    kept.append(text[s:e][~gone[s:e]].tobytes() if low < high else body[s:e])
                for i in range(0, len(kept), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["keys"][i : i + 500], pa.int64()), pa.array(row["sizes"][i : i + 500], pa.int64()), pa.array(spans[i : i + 500], _SPANS), pa.array(kept[i : i + 500], pa.binary())],
                        names=[key, "n_bytes", "spans", "kept"],
                    )

    return blocks.select("block", "keys", "sizes", "texts", "found").mapInArrow(cut, f"`{key}` bigint, n_bytes bigint, spans array<struct<start:bigint,length:bigint>>, kept binary")


def scratch(spark: SparkSession) -> str | None:
    """The shared folder as a path where it is mounted: queues that outgrow memory spill to it."""
    place = urlparse(workspace(spark, "queue"))
    return place.path.rsplit("/", 1)[0] if place.scheme in ("", "file") else None


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", memory: int = MEMORY) -> DataFrame:
    """One row per document: ``key``, ``n_bytes``, ``spans`` (start and length in bytes of what was removed), ``kept`` (the other bytes).

    A byte is removed if a string of 50 bytes that covers it also starts in a document with a smaller key; strings are judged on the
    input, and never cross documents. Keys are integers. Documents with equal keys do not count against each other; a NULL
    key is greater than all others, and equal to NULL. NULL texts are empty, rows repeat as given, texts under 50 bytes stay whole,
    extra columns are not read, and an empty table gives no rows. A text is held by one task as a whole; ``memory`` is the number of
    tuples that a shard keeps in memory before it spills to the shared folder (without a mounted one, that is an error).
    """
    blocks = _blocks(docs, key, text)
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    shards = max(1, min(1 << 16, -(-total // SHARD_BYTES)))
    told = _verdicts(blocks, shards).groupBy("block").agg(F.collect_list(F.struct("shard", "n", "verdict")).alias("verdicts"))
    sent = _send(blocks.join(told, "block", "left").select("block", "keys", "sizes", "texts", "verdicts"), shards)
    found = stage(_sort(sent, shards, scratch(docs.sparkSession), memory), "repeats-found")
    lists = found.groupBy("block").agg(F.collect_list(F.struct("n", "a")).alias("found"))
    return _cut(blocks.join(lists, "block", "left"), key)
