"""Packing by cutting stock: column generation over a histogram of piece lengths.

Documents are cut into whole sequences, a part that is a multiple of ``unit`` tokens, and a tail below it. There are then
less than ``size / unit + unit`` lengths whatever the corpus, so the linear program (fewest sequences that hold the
histogram) has a bounded number of rows. Its columns are patterns, how many pieces of each length share a
sequence; an unbounded knapsack by dynamic programming prices new ones. Counts are rounded down, what is left over is
filled largest first, and the pieces, ranked within their length, take the places of the patterns in turn.

Only the histogram reaches the driver, and only the patterns go back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import tokens
from tallyhouse.llm.base import stage

SIZE, UNIT = 4096, 64


def knapsack(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within ``room``, any number of each: its value and counts."""
    useful = np.flatnonzero(values > 1e-12)
    counts = np.zeros(len(sizes), dtype=np.int64)
    if not len(useful):
        return 0.0, counts
    useful = useful[np.argsort(sizes[useful], kind="stable")]
    s, v = sizes[useful], values[useful]
    fits = np.searchsorted(s, np.arange(room + 1), side="right")
    best, pick = np.zeros(room + 1), np.full(room + 1, -1, dtype=np.int64)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        k = fits[c]
        if k:
            worth = best[c - s[:k]] + v[:k]
            i = int(worth.argmax())
            if worth[i] > best[c]:
                best[c], pick[c] = worth[i], i
    c = room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[useful[pick[c]]] += 1
            c -= int(s[pick[c]])
    return float(best[room]), counts


def patterns(lengths: np.ndarray, demand: np.ndarray, size: int = SIZE, gap: float = 1e-3, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """(how often, pieces of each length) so that every piece has exactly one place and no pattern is longer than ``size``.

    Revised simplex from one-length patterns. It ends when no column prices better than ``1 + gap``, which bounds the distance
    to the optimum by that factor, or after ``rounds`` columns; the solution is a whole one either way.
    """
    m = len(lengths)
    out: list[tuple[int, np.ndarray]] = []
    left = demand.astype(np.int64).copy()
    if m:
        columns = np.diag(size // lengths).astype(float)
        inverse = np.diag(1.0 / np.diag(columns))
        x = inverse @ demand
        for _ in range(rounds):
            price = inverse.sum(axis=0)
            value, made = knapsack(lengths, price, size)
            if value <= 1 + gap:
                break
            step = inverse @ made
            able = step > 1e-9
            ratio = np.where(able, x / np.where(able, step, 1), np.inf)
            leave = int(ratio.argmin())
            x = np.maximum(x - ratio[leave] * step, 0)
            x[leave] = ratio[leave]
            columns[:, leave] = made
            row = inverse[leave] / step[leave]
            inverse -= np.outer(step, row)
            inverse[leave] = row
        for times, column in zip(np.floor(x + 1e-6).astype(np.int64), columns.T.astype(np.int64)):
            used = column > 0
            times = min(int(times), int((left[used] // column[used]).min())) if used.any() else 0
            if times > 0:
                out.append((times, column))
                left -= times * column
    order = np.argsort(-lengths, kind="stable")
    while left.any():
        column, room = np.zeros(m, dtype=np.int64), size
        for i in order:
            column[i] = min(left[i], room // lengths[i])
            room -= column[i] * lengths[i]
        used = column > 0
        times = int((left[used] // column[used]).min())
        out.append((times, column))
        left -= times * column
    return out


@dataclass(frozen=True)
class Layout:
    """For each length, the first rank of each run of places with its pattern's first sequence and pieces per sequence."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(lengths: np.ndarray, chosen: list[tuple[int, np.ndarray]]) -> Layout:
        runs: dict[int, list] = {int(n): [] for n in lengths}
        taken, sequence = np.zeros(len(lengths), dtype=np.int64), 0
        for times, column in chosen:
            for i in np.flatnonzero(column):
                runs[int(lengths[i])].append((taken[i], sequence, column[i]))
                taken[i] += times * column[i]
            sequence += times
        return Layout({n: tuple(np.array(v, dtype=np.int64) for v in zip(*r)) for n, r in runs.items() if r})

    def sequences(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.zeros(len(length), dtype=np.int64)
        for n in np.unique(length):
            mine = length == n
            first, sequence, each = self.runs[int(n)]
            at = np.searchsorted(first, rank[mine], side="right") - 1
            out[mine] = sequence[at] + (rank[mine] - first[at]) // each[at]
        return out


def cut(n: int, size: int = SIZE, unit: int = UNIT) -> list[int]:
    """Lengths of a document's pieces: whole sequences, a multiple of ``unit``, a tail."""
    whole, rest = divmod(n, size)
    return [size] * whole + [p for p in (rest - rest % unit, rest % unit) if p]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encoded and cut documents, written to the shared folder: key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    and ``part`` and ``nth``, which number the pieces of each length within the task that made them."""

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = tokens.encoder(tokens.vocabulary_file(vocabulary))
        end, seen = np.array([end_id], dtype="<u2").tobytes(), np.zeros(SIZE + 1, dtype=np.int64)
        for batch in rows:
            made: list[list] = [[] for _ in range(8)]
            for k, raw in zip(batch.column(0).to_pylist(), encoder(batch.column(1).to_pylist())):
                raw += end
                total, at = len(raw) // 2, 0
                wide = np.frombuffer(raw, "<u2").astype("<u4")
                for n in cut(total):
                    some = wide[at : at + n].tobytes()
                    for column, value in zip(made, (k, at, n, zlib.crc32(some), total, part, int(seen[n]), some if with_ids else None)):
                        column.append(value)
                    seen[n] += 1
                    at += n
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], ["k", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", "ids"])

    shape = "k long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long, ids binary"
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return stage(rows.mapInArrow(encode, shape), "pieces")


def pack(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids``).

    NULL text counts as empty, so it is a piece that holds just the end id. Rows with equal or NULL keys are documents of
    their own, other columns are not read, and an empty table gives no rows. Pieces lie in a sequence longest first without
    gaps; a sequence shorter than ``SIZE`` is padded by the reader unless its length is a power of two.
    """
    found = pieces(docs, vocabulary, end_id, key, text, with_ids)
    sizes = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = sorted((r["length"], r["n"]) for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect())
    lengths = np.array([n for n, _ in histogram], dtype=np.int64)
    layout = Layout.of(lengths, patterns(lengths, np.array([n for _, n in histogram], dtype=np.int64)))

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = batch.schema.get_field_index("rank")
            yield batch.set_column(at, pa.field("sequence_id", pa.int64()), pa.array(layout.sequences(length, rank)))

    kept = ["k", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    ranked = found.join(before, ["length", "part"]).select(*kept, (F.col("nth") + F.col("before")).alias("rank"))
    shape = "k long, start long, length long, ids_crc32 long, doc_tokens long, " + "ids binary, " * with_ids + "sequence_id long"
    placed = ranked.mapInArrow(place, shape)
    ahead = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "k", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).withColumnRenamed("k", key)


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence (little-endian, 4 bytes each), from ``pack(..., with_ids=True)``."""
    one = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(one, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
