"""Elias-Fano encoding of ascending numbers, with a select structure.

A number's low bits stand in a packed array; its high part h sets bit h + i of a bit vector, i being its rank. With
l = floor(log2(universe / n)) low bits a number takes at most l + 2 bits, plus 1/8 bit for the place of every 256th
set bit. The number of rank i is found from the nearest such place by counting bits, so no table of offsets exists.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQQ")
#: Set bits between two stored places.
SAMPLE = 256
#: Numbers whose bits are spread out at once.
_STEP = 1 << 16
_ONE, _FULL = np.uint64(1), np.uint64(2**64 - 1)


def _padded(bits: np.ndarray) -> bytes:
    raw = np.packbits(bits, bitorder="little").tobytes()
    return raw + bytes(-len(raw) % 8)


def encode(values: np.ndarray) -> bytes:
    """Bytes that hold ascending values below 2^64, repeats allowed; their length is a multiple of 8."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    universe = int(values[-1]) + 1 if n else 1
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, bool)
    high[ones] = True
    places = np.arange(low, dtype=np.uint64)
    own = [((values[at : at + _STEP, None] >> places) & _ONE).astype(bool).reshape(-1) for at in range(0, n, _STEP)] if low else []
    lows, highs = _padded(np.concatenate(own)) if own else b"", _padded(high)
    samples = ones[::SAMPLE].astype("<u4").tobytes()
    return _HEAD.pack(n, low, len(lows), len(highs)) + lows + highs + samples + bytes(-len(samples) % 8)


class EliasFano:
    """Ascending numbers read from encoded bytes, by rank."""

    def __init__(self, data: bytes | memoryview):
        n, low, lows, highs = _HEAD.unpack_from(data)
        self.n, self.low = n, low
        at = _HEAD.size
        self.lows = np.frombuffer(data, "<u8", lows // 8, at)
        self.highs = np.frombuffer(data, "<u8", highs // 8, at + lows)
        n_samples = -(-n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", n_samples, at + lows + highs)
        #: Encoded bytes in all.
        self.size = at + lows + highs + 4 * n_samples + (-4 * n_samples) % 8

    def __len__(self) -> int:
        return self.n

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The numbers of these ranks (each from 0 to n - 1)."""
        ranks = np.asarray(ranks, np.int64)
        begin = self.samples[ranks // SAMPLE].astype(np.int64)
        at, left = begin >> 6, ranks % SAMPLE
        word = self.highs[at] & (_FULL << (begin & 63).astype(np.uint64))
        todo = np.arange(len(ranks))
        while len(todo):  # on to the word that holds the set bit
            have = np.bitwise_count(word[todo]).astype(np.int64)
            todo, have = todo[left[todo] >= have], have[left[todo] >= have]
            left[todo] -= have
            at[todo] += 1
            word[todo] = self.highs[at[todo]]
        place = at << 6
        for half in (32, 16, 8, 4, 2, 1):  # inside the word
            have = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
            upper = left >= have
            left[upper] -= have[upper]
            word[upper] >>= np.uint64(half)
            place[upper] += half
        high = (place - ranks).astype(np.uint64)
        return high << np.uint64(self.low) | self._lows(ranks)

    def _lows(self, ranks: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(ranks), np.uint64)
        bit = ranks * self.low
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        out = self.lows[word] >> shift
        over = np.flatnonzero(shift + np.uint64(self.low) > 64)
        out[over] |= self.lows[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & np.uint64((1 << self.low) - 1)

    def all(self) -> np.ndarray:
        """All numbers, in order."""
        return np.concatenate([self.select(np.arange(a, min(a + _STEP, self.n))) for a in range(0, self.n, _STEP)]) if self.n else np.zeros(0, np.uint64)

    def rank(self, value: int) -> int:
        """How many numbers are below value, by binary search over select."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if int(self.select(np.array([middle]))[0]) < value:
                low = middle + 1
            else:
                high = middle
        return low
