"""Elias-Fano sequences and the n-gram trie made of them: compact levels in one file, read through a memory map."""
from __future__ import annotations

import json

import numpy as np


class EliasFano:
    """A sorted sequence: ``low_bits`` of each value packed, the rest as unary gaps in a bit vector.

    All questions take arrays. The directory (ones before each 64-bit word) is made when the sequence is opened."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray):
        self.n, self.low_bits, self.high, self.low = n, low_bits, high, low
        self.ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        self.zeros = 64 * np.arange(len(high) + 1) - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, ((top + 1) // max(1, n)).bit_length() - 1)
        high = (v >> np.uint64(bits)).astype(np.int64)
        marks = np.zeros(-(-(n + (top >> bits) + 2) // 64) * 64, np.uint8)
        marks[high + np.arange(n)] = 1
        low = ((v[:, None] >> np.arange(bits, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(np.uint8).ravel()
        low = np.concatenate((low, np.zeros(-len(low) % 64 + 64, np.uint8)))
        return cls(n, bits, np.packbits(marks, bitorder="little").view("<u8"), np.packbits(low, bitorder="little").view("<u8"))

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero."""
        before = self.ones if ones else self.zeros
        w = np.searchsorted(before, k, side="right") - 1
        w = np.minimum(w, len(self.high) - 1)
        left = k - before[w]
        word = np.asarray(self.high[w]) if ones else ~np.asarray(self.high[w])
        place = w * 64
        for half in (32, 16, 8, 4, 2, 1):
            part = word & np.uint64((1 << half) - 1)
            c = np.bitwise_count(part).astype(np.int64)
            go = left >= c
            left = left - np.where(go, c, 0)
            word = np.where(go, word >> np.uint64(half), part)
            place = place + np.where(go, half, 0)
        return place

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        w, off = at >> 6, (at & 63).astype(np.uint64)
        a, b = np.asarray(self.low[w]), np.asarray(self.low[w + 1])
        joined = a >> off | np.where(off > 0, b << (np.uint64(64) - np.maximum(off, np.uint64(1))), np.uint64(0))
        return joined & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return (self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low_bits) | self._lows(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that is at least x (n if there is none)."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64)
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        last = int(self.zeros[-1]) - 1
        inside = h < last
        h = np.where(inside, h, 0)
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        hi = np.minimum(self._select(h, False) - h, self.n)
        rest = x & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            less = self._lows(mid) < rest[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        return np.where(inside, lo, self.n)


#: Quantised log10 probabilities: code c > 0 means 10 ** (-(c - 1) / CODES_A_DECADE); 0 means absent. A fixed grid, so
#: that a value does not depend on what else a shard holds.
CODES_A_DECADE = 4096


def quantised(p: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.rint(-np.log10(p) * CODES_A_DECADE), 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) / CODES_A_DECADE), 0.0)


class NgramTrie:
    """Contexts, pointers to their successors, successors, and a quantised probability for each successor.

    A context's successors are stored relative to it: to each range the last value of the range before is added, so the
    whole level is one sorted sequence, and a successor is found by one search for its context's base plus its id."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, p: np.ndarray) -> NgramTrie:
        """From rows sorted by (context, word), each once."""
        head = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.zeros(0, np.int64)
        n = np.diff(np.append(head, len(context)))
        last = word[head + n - 1] if len(head) else np.zeros(0, np.int64)
        base = np.concatenate(([0], np.cumsum(last + 1)[:-1])) if len(head) else np.zeros(0, np.int64)
        return cls(EliasFano.of(context[head]), EliasFano.of(np.append(head, len(context))), EliasFano.of(word + np.repeat(base, n)), quantised(p))

    def save(self, path: str) -> None:
        arrays = [a for e in (self.contexts, self.pointers, self.successors) for a in (e.high, e.low)] + [self.codes]
        head = {"n": [e.n for e in (self.contexts, self.pointers, self.successors)], "low_bits": [e.low_bits for e in (self.contexts, self.pointers, self.successors)],
                "sizes": [len(a) for a in arrays]}
        line = json.dumps(head).encode()
        with open(path, "wb") as f:
            f.write(line + b" " * (-(len(line) + 1) % 8) + b"\n")
            for a in arrays:
                f.write(np.ascontiguousarray(a).tobytes())

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        with open(path, "rb") as f:
            line = f.readline()
        head, at = json.loads(line), len(line)
        level = np.memmap(path, np.uint8, "r")
        arrays = []
        for k, n in enumerate(head["sizes"]):
            width = 2 if k == 6 else 8
            arrays.append(level[at:at + width * n].view("<u2" if k == 6 else "<u8"))
            at += width * n
        parts = [EliasFano(head["n"][i], head["low_bits"][i], arrays[2 * i], arrays[2 * i + 1]) for i in range(3)]
        return cls(*parts, arrays[6])

    def look_up(self, context: np.ndarray, of_context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of (context[of_context[i]], word[i]); 0 where the trie has none."""
        if not self.contexts.n or not len(word):
            return np.zeros(len(word), np.uint16)
        i = self.contexts.successor(context)
        there = i < self.contexts.n
        i = np.where(there, i, 0)
        there &= self.contexts.access(i) == context.astype(np.uint64)
        first, end = self.pointers.access(i).astype(np.int64), self.pointers.access(i + 1).astype(np.int64)
        base = np.where(first > 0, self.successors.access(np.maximum(first - 1, 0)) + np.uint64(1), np.uint64(0))
        want = base[of_context] + word.astype(np.uint64)
        at = self.successors.successor(want)
        found = there[of_context] & (at < end[of_context])
        at = np.where(found, at, 0)
        found &= self.successors.access(at) == want
        return np.where(found, np.asarray(self.codes[at]), 0).astype(np.uint16)
