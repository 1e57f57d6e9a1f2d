"""Token counts by rank-synchronous merging of ragged numpy arrays.

All distinct pre-tokens of a batch are held as one flat array of symbols with row bounds. In each round every row finds
its lowest-rank adjacent pair and merges all its occurrences, all rows at once, until no row has a known pair. What
survives is counted; no ids are needed. Long rows have many rounds: there the places of each waiting rank are kept, and a
round touches only the places of its rank and their neighbours.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import tokens
from tallyhouse.llm.base import batches, hold


#: Bytes of a pre-token from which on the places of each rank are kept.
LONG = 512


def _every_other(follows: np.ndarray) -> np.ndarray:
    """Every other place of each run from its first on; ``follows`` says that a place goes on the run of the one before it."""
    place = np.arange(len(follows))
    return (place - np.maximum.accumulate(np.where(follows, 0, place))) % 2 == 0


class Merger:
    """Merge table of a BPE file as sorted pair keys, with the symbols that start a pre-token."""

    def __init__(self, path: str):
        with open(path, encoding="utf8") as file:
            model = json.load(file)["model"]
        ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        letters = tokens.byte_letters()
        self.inner = np.array([ids[letters[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([ids[letters[b] + end] for b in range(256)], dtype=np.int64)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of the words (non-empty bytes)."""
        out = np.zeros(len(words), dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for rows, count in ((np.flatnonzero(lengths < LONG), self._short), (np.flatnonzero(lengths >= LONG), self._long)):
            if len(rows) == len(words):
                return count(words)
            if len(rows):
                out[rows] = count([words[i] for i in rows])
        return out

    def _symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starting symbols of words, one after the other; the row of each; the words' lengths."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[flat[ends - 1]]
        return symbols, np.repeat(np.arange(len(words)), lengths), lengths

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, the number of ranks for a pair that does not merge."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.keys))

    def _long(self, words: list[bytes]) -> np.ndarray:
        symbols, row, _ = self._symbols(words)
        n, none = len(symbols), len(self.keys)
        # neighbours by place; place n stands for none, and its symbol pairs with nothing
        symbols = np.append(symbols, -1)
        after = np.append(np.where(row[1:] == row[:-1], np.arange(1, n), n), [n, n])
        before = np.concatenate(([n], np.where(row[1:] == row[:-1], np.arange(n - 1), n), [n]))
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def add(places: np.ndarray) -> None:
            rank = self._ranks(symbols[places], symbols[after[places]])
            places, rank = places[rank < none], rank[rank < none]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else []
            for a, b in zip(first, [*first[1:], len(rank)]):
                r = int(rank[a])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(places[a:b])

        add(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[self._ranks(symbols[places], symbols[after[places]]) == r]  # other merges may have come first
            places = places[_every_other(np.concatenate(([False], after[places[:-1]] == places[1:])))] if len(places) else places
            gone = after[places]
            symbols[places], symbols[gone] = self.made[r], -1
            after[places] = after[gone]
            before[after[places]] = places
            before[n] = n
            add(np.unique(np.concatenate((places, before[places]))))
        return np.bincount(row[symbols[:n] >= 0], minlength=len(words))

    def _short(self, words: list[bytes]) -> np.ndarray:
        symbols, row, lengths = self._symbols(words)
        final = lengths.copy()
        none = len(self.keys)
        while len(symbols) > 1:
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            rank = np.where((self.keys[at] == pair) & (row[:-1] == row[1:]), self.ranks[at], none)
            # lowest rank of each row that is left; a row's pairs start where the row starts
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            size = np.diff(np.r_[starts, len(row)])
            lowest = np.minimum.reduceat(np.r_[rank, none], starts)
            live = np.repeat(lowest < none, size)
            hit = np.r_[(rank == np.repeat(lowest, size)[:-1]) & (rank < none), False]
            # in a run such as a a a only every other pair is merged, from the left
            run = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
            if len(run):
                place = np.arange(len(hit))
                since = place - np.repeat(run, np.diff(np.r_[run, len(hit)])) if run[0] == 0 else np.r_[np.zeros(run[0], np.int64), place[run[0] :] - np.repeat(run, np.diff(np.r_[run, len(hit)]))]
                hit &= since % 2 == 0
            symbols = symbols.copy()
            where = np.flatnonzero(hit)
            symbols[where] = self.made[np.r_[rank, none][where]]
            keep = live & ~np.r_[False, hit[:-1]]
            done = np.flatnonzero(lowest >= none)
            final[row[starts[done]]] = size[done]
            symbols, row = symbols[keep], row[keep]
        if len(symbols):
            final[row[0]] = 1
        return final


_COUNTERS: dict[str, tokens.Pieces] = {}


def counter(path: str) -> tokens.Pieces:
    """Token counts of texts; one per worker process and file.

    The library cuts and normalises short pieces (its pre-tokenizer), the merges are done here.
    """
    hold("counter", _COUNTERS.clear)
    if path not in _COUNTERS:
        tool, merger = tokens._library(path), Merger(path)
        back = {c: b for b, c in tokens.byte_letters().items()}
        cut, clean = tool.pre_tokenizer.pre_tokenize_str, tool.normalizer.normalize_str if tool.normalizer else str

        def fill(chunks: list[str]) -> list[int]:
            words, row = [], []
            for i, chunk in enumerate(chunks):
                if tokens.is_word(chunk):
                    words.append(chunk.encode() if spaced else chunk.strip(" ").lower().encode())
                    row.append(i)
                    continue
                for word, _ in cut(clean(chunk)):
                    words.append(bytes(map(back.__getitem__, word)))
                    row.append(i)
            out = np.zeros(len(chunks), dtype=np.int64)
            if words:
                np.add.at(out, row, merger.counts(words))
            return out.tolist()

        spaced = tool.normalizer is None
        special = sorted((t.content for t in tool.get_added_tokens_decoder().values()), key=len, reverse=True)

        def whole(text: str) -> int:
            parts, total = [text], 0
            for mark in special:
                split = [p.split(mark) for p in parts]
                total += sum(len(s) - 1 for s in split)
                parts = [p for s in split for p in s]
            return total + sum(fill([p for p in parts if p]))

        _COUNTERS[path] = tokens.Pieces(fill, sum, whole, spaced)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, over: int = 2048, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``over`` tokens) of each row.

    NULL text counts as empty: 0 bytes, 0 tokens. A NULL key stays NULL, repeated rows each give a row, other columns are
    not read, and an empty table gives no rows. No shuffle; each task keeps a bounded memory of counted pieces.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("b", F.octet_length("t").cast("long"))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array(counter(tokens.vocabulary_file(vocabulary))(batch.column(1).to_pylist()), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(found, pa.int64()), pa.array(found > over, pa.bool_())],
            ["k", "n_bytes", "n_tokens", "over_limit"],
        )

    kind = rows.schema["k"].dataType.simpleString()
    made = rows.mapInArrow(batches(convert), f"k {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return made.withColumnRenamed("k", key)
