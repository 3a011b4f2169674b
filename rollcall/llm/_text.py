"""Word and shingle hashing over Arrow string columns, in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D; those bytes never occur inside a
UTF-8 sequence, so splitting bytes equals splitting code points. Hashes are 64 bits and depend on
nothing but the words, so every executor computes the same ones. Two different words of a corpus have the
same hash with a probability of 2^-64.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that one step of a batch holds in numpy arrays (about 60 bytes of arrays each).
STEP_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word that numpy hashes; longer words go to blake2b one by one.
_SHORT = 64
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def steps(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about STEP_BYTES each; one long text makes a range of its own."""
    sizes = np.diff(_offsets(column))
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + STEP_BYTES, "right")))
        yield start, stop
        start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array without nulls (null: empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.fill_null("") if column.null_count else column


class Words:
    """Words of a run of texts: byte ranges, the text each belongs to, and how many each text has."""

    def __init__(self, texts: pa.Array, cut: tuple[np.ndarray, np.ndarray] | None = None, space: np.ndarray = _SPACE):
        """cut: tables of bytes between which a word is cut in two as well, the one before and the one after.

        space: a table of the bytes that belong to no word.
        """
        offsets = _offsets(texts)
        data = texts.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        bounds = offsets - offsets[0]
        word = ~space[self.bytes]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = bounds[(bounds > 0) & (bounds < len(word))]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        if cut is not None:
            more = np.flatnonzero(cut[0][self.bytes[:-1]] & cut[1][self.bytes[1:]]) + 1
            first[more], last[more - 1] = word[more], word[more - 1]
        self.mask, self.starts, self.ends = word, np.flatnonzero(first), np.flatnonzero(last) + 1
        self.counts = np.diff(np.searchsorted(self.starts, bounds))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of each word; with lower, A-Z count as a-z.

        Eight bytes at a time go through a nonlinear mix of all that came before, so no structure of a text
        (as of Thue-Morse words, which any polynomial in the bytes confuses) makes hashes equal.
        """
        own = _LOWER[self.bytes] if lower else self.bytes
        padded = np.concatenate([own, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        lengths = self.ends - self.starts
        h = mix(lengths.astype(np.uint64) * _SEED)
        todo = np.flatnonzero(lengths <= _SHORT)
        for at in range(0, _SHORT, 8):
            todo = todo[lengths[todo] > at]
            if not len(todo):
                break
            rest = np.minimum(lengths[todo] - at, 8).astype(np.uint64)
            part = eight[self.starts[todo] + at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - rest * np.uint64(8)))
            h[todo] = mix(h[todo] ^ part) + _SEED
        for i in np.flatnonzero(lengths > _SHORT):
            h[i] = int.from_bytes(hashlib.blake2b(own[self.starts[i] : self.ends[i]].tobytes(), digest_size=8).digest(), "little")
        return h


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows of one run of word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = mix(out * _STEP ^ hashes[j : j + n])
    return mix(out)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, in lower case.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = Words(texts)
    hashes = words.hashes(True)
    all_windows = windows(hashes, k)
    for i, n in enumerate(words.counts):
        at = words.first[i]
        if n >= k:
            yield np.unique(all_windows[at : at + n - k + 1])
        elif n:
            own = windows(hashes[at : at + n], int(n))
            yield mix(own + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)


def slices(text: bytes, gap: re.Pattern[bytes], ahead: int, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in slices of about size bytes, cut where gap finds a run of bytes between words; each with the bytes up to
    the end of the `ahead` words that follow, and how many bytes are its own."""
    at = 0
    while len(text) - at > size and (cut := gap.search(text, at + size)):
        following = list(itertools.islice(gap.finditer(text, cut.start()), ahead + 1))
        stop = following[-1].start() if len(following) > ahead else len(text)
        yield text[at:stop], cut.start() - at
        at = cut.start()
    yield text[at:], len(text) - at


def binary(parts: list[np.ndarray]) -> pa.Array:
    """A binary column whose rows are the arrays' bytes."""
    return pa.array([p.tobytes() for p in parts], pa.binary())
