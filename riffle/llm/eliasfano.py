"""Elias-Fano sequences and a two-level trie of contexts and successors over a memory-mapped file."""

from __future__ import annotations

import os
import tempfile

import numpy as np


PIECE = 1 << 16
_BLOCK = 512  # bits for each entry of a directory
_ONES = np.bitwise_count(np.arange(256, dtype=np.uint8))
#: place of the k-th set bit of a byte, from bit 0 on
_PLACE = np.array([[*np.flatnonzero(np.unpackbits(np.uint8(b), bitorder="little")), *[8] * 8][:8] for b in range(256)], dtype=np.uint8)


class Bits:
    """A bit sequence, bit 0 of each byte first, searched in place: one count for every 512 bits is kept beside it."""

    def __init__(self, data: np.ndarray):
        """``data``: bytes, in whole blocks."""
        self.words = data.view("<u8").reshape(-1, _BLOCK // 64)
        counts = np.concatenate([np.bitwise_count(self.words[i : i + PIECE]).sum(axis=1, dtype=np.int64) for i in range(0, len(self.words), PIECE)])
        self.ones = np.append(0, np.cumsum(counts))

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the k-th (from 0) bit of this value, which must be there."""
        out = np.empty(len(k), dtype=np.int64)
        before = self.ones if bit else np.arange(len(self.ones)) * _BLOCK - self.ones
        for at in range(0, len(k), PIECE):
            rest = k[at : at + PIECE].astype(np.int64)
            block = np.searchsorted(before, rest, side="right") - 1
            rest = rest - before[block]
            words = self.words[block] if bit else ~self.words[block]
            words, place, rest = _descend(words, np.bitwise_count(words), rest)
            inner = words.view(np.uint8).reshape(-1, 8)
            byte, place8, rest = _descend(inner, _ONES[inner], rest)
            out[at : at + PIECE] = block * _BLOCK + place * 64 + place8 * 8 + _PLACE[byte, rest]
        return out


def _descend(parts: np.ndarray, ones: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part of each row that holds the k-th set bit, its place in the row, and which of the part's bits it is."""
    upto = np.cumsum(ones, axis=1, dtype=np.int64)
    place = (upto <= k[:, None]).sum(axis=1)
    rows = np.arange(len(k))
    return np.ascontiguousarray(parts[rows, place]), place, k - (upto[rows, place] - ones[rows, place])


class EliasFano:
    """A non-decreasing sequence below ``universe``: low bits packed, high bits in unary, searched without decoding it."""

    def __init__(self, low_bits: int, n: int, lows: np.ndarray, highs: np.ndarray):
        self.low_bits, self.n, self.lows, self.highs = low_bits, n, lows, Bits(highs)
        self.most = int(self.highs.select(np.array([n - 1]), 1)[0]) - n + 1 if n else 0  # the largest high part

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Width of the low bits, their bytes and the unary bytes; works through pieces, so it needs little beside its result."""
        n = len(values)
        low_bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        most = int(values[-1]) >> low_bits if n else 0
        lows = np.zeros((n * low_bits + 7) // 8 + 16, np.uint8)
        # what follows the last one is zeros enough for the next select
        highs = np.zeros(((most + n + 1 + _BLOCK) // _BLOCK + 1) * _BLOCK // 8, np.uint8)
        for at in range(0, n, PIECE):  # a multiple of 8, so that pieces end with whole bytes
            part = np.ascontiguousarray(values[at : at + PIECE].astype("<u8"))
            if low_bits:
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :low_bits]
                packed = np.packbits(bits.ravel(), bitorder="little")
                lows[at * low_bits // 8 : at * low_bits // 8 + len(packed)] = packed
            place = (part >> np.uint64(low_bits)).astype(np.int64) + np.arange(at, at + len(part))
            byte = place >> 3
            first = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
            highs[byte[first]] |= np.bitwise_or.reduceat((1 << (place & 7)).astype(np.uint8), first)
        return low_bits, lows, highs

    def _low(self, at: np.ndarray) -> np.ndarray:
        """Low bits of the elements at the given places."""
        bit = at * self.low_bits
        out = np.zeros(len(at), dtype=np.uint64)
        byte, shift = bit >> 3, bit & 7
        for k in range((self.low_bits + 14) // 8):
            part = self.lows[byte + k].astype(np.uint64)
            move = 8 * k - shift
            out |= np.where(move >= 0, part << np.maximum(move, 0).astype(np.uint64), part >> np.maximum(-move, 0).astype(np.uint64)) * (move < 64)
        return out & np.uint64((1 << self.low_bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        high = self.highs.select(at, 1) - at
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def _first(self, high: np.ndarray) -> np.ndarray:
        """How many elements have a smaller high part."""
        out = np.zeros(len(high), dtype=np.int64)
        some = high > 0
        out[some] = self.highs.select(high[some] - 1, 0) - high[some] + 1
        return out

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Place of the first element not below each value (its successor); n if there is none."""
        asked = asked.astype(np.uint64)
        high = (asked >> np.uint64(self.low_bits)).astype(np.int64)
        out = np.full(len(asked), self.n, dtype=np.int64)
        if not self.n:
            return out
        inside = np.flatnonzero((high >= 0) & (high <= self.most))
        low, end = self._first(high[inside]), self._first(high[inside] + 1)
        want = asked[inside] & np.uint64((1 << self.low_bits) - 1)
        while len(open_ := np.flatnonzero(low < end)):
            mid = (low[open_] + end[open_]) >> 1
            less = self._low(mid) < want[open_]
            low[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]
        out[inside] = low
        return out


class Trie:
    """Contexts, the range of successors of each, successors and their quantised values, in one memory-mapped file.

    A successor is stored as its context's rank and its own id, so each level is one monotone sequence, and
    looking for a word among a context's successors is one successor search.  ``bits``: width of a successor id.
    """

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, values: np.ndarray, bits: int):
        """``contexts`` and ``successors`` of all pairs, sorted by both; ``values`` uint16."""
        self.bits = bits
        known, start = np.unique(contexts, return_index=True)
        rank = np.repeat(np.arange(len(known), dtype=np.uint64), np.diff(np.append(start, len(contexts))))
        levels = (
            EliasFano.pack(known, 1 << 64),
            EliasFano.pack(np.append(start, len(contexts)), len(contexts) + 1),
            EliasFano.pack(rank << np.uint64(bits) | successors, max(1, len(known)) << bits),
        )
        parts = [p for _, lows, highs in levels for p in (np.append(lows, np.zeros(-len(lows) % 8, np.uint8)), highs)]
        parts.append(values.astype("<u2").view(np.uint8))
        handle, path = tempfile.mkstemp(prefix="trie-")
        try:
            with os.fdopen(handle, "wb") as f:
                for p in parts:
                    f.write(p.tobytes())
                f.write(b"\0")
            whole = np.memmap(path, dtype=np.uint8, mode="r")
        finally:
            os.unlink(path)  # the mapping keeps the pages; nothing stays behind if the task is lost
        cut = np.split(whole, np.cumsum([len(p) for p in parts]))
        sizes = (len(known), len(known) + 1, len(contexts))
        self.contexts, self.pointers, self.successors = (
            EliasFano(levels[i][0], sizes[i], cut[2 * i], cut[2 * i + 1]) for i in range(3)
        )
        self.known, self.pairs, self.values = len(known), len(contexts), cut[6].view("<u2")

    def degrees(self) -> tuple[np.ndarray, np.ndarray]:
        """Every context and how many successors it has."""
        at = np.arange(self.known)
        return self.contexts.get(at), self.pointers.get(at + 1).astype(np.int64) - self.pointers.get(at).astype(np.int64)

    def lookup(self, contexts: np.ndarray, runs: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Values of the asked pairs, 0 where unknown: context i is asked for the next ``runs[i]`` successors."""
        out = np.zeros(len(successors), dtype=np.uint16)
        if not self.pairs or not len(successors):
            return out
        rank = self.contexts.find(contexts)
        there = rank < self.known
        there[there] = self.contexts.get(rank[there]) == contexts[there]
        ask = np.flatnonzero(np.repeat(there, runs))
        key = np.repeat(rank, runs)[ask].astype(np.uint64) << np.uint64(self.bits) | successors[ask]
        at = self.successors.find(key)
        hit = at < self.pairs
        hit[hit] = self.successors.get(at[hit]) == key[hit]
        out[ask[hit]] = self.values[at[hit]]
        return out
