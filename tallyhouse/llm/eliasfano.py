"""Elias-Fano sequences over plain arrays, so that they can be memory-mapped, and files that hold several arrays."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

ONE, WORD, ALL = np.uint64(1), np.uint64(63), np.uint64((1 << 64) - 1)


def save(path: str, arrays: dict[str, np.ndarray], notes: dict) -> None:
    """Write arrays and notes to one file: under another name first, so that a repeated task leaves one whole file."""
    at, places = 0, {}
    for name, a in arrays.items():
        places[name] = (at, a.dtype.str, len(a))
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"notes": notes, "arrays": places}).encode()
    head += b" " * (-(len(head) + 8) % 64)
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as file:
        file.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            file.write(a.tobytes() + b"\0" * (-a.nbytes % 64))
    os.replace(draft, path)


def load(path: str) -> tuple[dict[str, np.ndarray], dict]:
    """The arrays of a file, memory-mapped, and its notes."""
    with open(path, "rb") as file:
        size = int.from_bytes(file.read(8), "little")
        head = json.loads(file.read(size))
    whole = np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)  # plain views of the mapping are cheaper to index
    out = {}
    for name, (at, kind, n) in head["arrays"].items():
        begin = 8 + size + at
        out[name] = whole[begin : begin + n * np.dtype(kind).itemsize].view(kind)
    return out, head["notes"]


def encode(values: np.ndarray, universe: int) -> tuple[dict[str, np.ndarray], int]:
    """Arrays of an ascending sequence below ``universe`` and the number of low bits.

    ``low`` holds the low bits of each value, ``high`` the others in unary (a one for each value, a zero for each step up), and
    ``zeros`` how many zeros lie before each 64-bit word of ``high``.
    """
    n = len(values)
    values = values.astype(np.uint64)
    bits = max(0, int(universe // max(1, n)).bit_length() - 1)
    low = values & np.uint64((1 << bits) - 1)
    spread = np.zeros(-(-n * bits // 64) * 64 + 64, dtype=np.uint8)
    for b in range(bits):
        spread[b : n * bits : bits] = (low >> np.uint64(b)) & ONE
    top = (values >> np.uint64(bits)).astype(np.int64)
    length = n + ((universe - 1) >> bits if universe else 0) + 2
    unary = np.zeros(-(-length // 64) * 64 + 64, dtype=np.uint8)
    unary[top + np.arange(n)] = 1
    high = np.packbits(unary, bitorder="little").view("<u8")
    zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))[:-1]))
    return {"low": np.packbits(spread, bitorder="little").view("<u8"), "high": high, "zeros": zeros}, bits


class Sequence:
    """Vectorised look-ups in an encoded sequence of ``n`` values."""

    def __init__(self, arrays: dict[str, np.ndarray], bits: int, n: int, prefix: str = ""):
        self.low, self.high, self.zeros = (arrays[prefix + x] for x in ("low", "high", "zeros"))
        self.bits, self.n = bits, n
        self.mask = np.uint64((1 << bits) - 1)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & WORD
        first = self.low[word] >> shift
        rest = (self.low[np.minimum(word + 1, len(self.low) - 1)] << ONE) << (WORD - shift)
        return (first | rest) & self.mask

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of ``high``, from 0."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        left, inverted = k - self.zeros[word], ~self.high[word]
        place = np.zeros(len(k), dtype=np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            part = (inverted >> place) & np.uint64((1 << width) - 1)
            below = np.bitwise_count(part).astype(np.int64)
            skip = left >= below
            left = np.where(skip, left - below, left)
            place += np.where(skip, np.uint64(width), np.uint64(0))
        return word * 64 + place.astype(np.int64)

    def _next_zero(self, at: np.ndarray) -> np.ndarray:
        """Position of the first zero of ``high`` beyond each position."""
        at = at + 1
        word = at >> 6
        left = ~self.high[word] & (ALL << (at.astype(np.uint64) & WORD))
        none = np.flatnonzero(left == 0)
        while len(none):
            word[none] += 1
            left[none] = ~self.high[word[none]]
            none = none[left[none] == 0]
        lowest = left & (~left + ONE)
        return word * 64 + np.bitwise_count(lowest - ONE).astype(np.int64)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value not below each ``x`` (``n`` if there is none), and whether it equals ``x``."""
        x = x.astype(np.uint64)
        top, want = (x >> np.uint64(self.bits)).astype(np.int64), x & self.mask
        # values with these high bits lie between two zeros; among them the low bits ascend
        before = np.where(top > 0, self._zero(np.maximum(top - 1, 0)), -1)
        index = before + 1 - top
        stop = self._next_zero(before) - top
        end = stop.copy()
        live = np.flatnonzero(index < stop)
        while len(live):
            middle = (index[live] + stop[live]) >> 1
            below = self._low(middle) < want[live]
            index[live[below]] = middle[below] + 1
            stop[live[~below]] = middle[~below]
            live = live[index[live] < stop[live]]
        equal = index < end
        found = np.flatnonzero(equal)
        equal[found] = self._low(index[found]) == want[found]
        return index, equal

    def values(self, start: int, stop: int) -> np.ndarray:
        """Decode a range (for tests and small reads)."""
        ones = np.flatnonzero(np.unpackbits(np.asarray(self.high).view(np.uint8), bitorder="little"))[start:stop]
        i = np.arange(start, stop)
        return ((ones - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)
