"""Sum-of-squares online packing of tokenized documents into fixed windows.

Each partition tokenizes and packs its documents in one pass, so nothing is shuffled. A document's full
windows go out at once; its rest, of s tokens, goes on the fill level h that makes the sum of squared
counts of partially filled windows smallest, over all levels with a window and h + s <= capacity, and over
a new window. The counts are a level array. Documents may be cut, so when a partition ends, or holds
OPEN_LIMIT partially filled windows, the emptiest ones are cut to fill the fullest: at most one padded
window a partition, and memory that doesn't follow the number of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._session import prepare

#: Partially filled windows that a partition holds at most.
OPEN_LIMIT = 1024
#: Pieces whose ids a worker remembers; beyond that it keeps the half used last. Longer pieces are encoded each time.
REMEMBERED_PIECES = 400_000
PIECE_BYTES = 24

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,!?;:"]] = True


class Tokenizer:
    """Ids of whole texts by a tokenizers file that drops white space and case, from the ids of each distinct piece.

    White space ends a token there, and so does a stop after an ASCII letter; pieces between such places are
    encoded apart, with A-Z as a-z. Pieces with "<" could be one of the file's special tokens, where case
    counts, and are always encoded anew, as are pieces of more than PIECE_BYTES. Of the others the ids are
    remembered; they are found by hash and known by all their bytes. A piece costs some 70 bytes.
    """

    _loaded: dict[str, Tokenizer] = {}

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Public

        self.public = Public.from_file(path)
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.exact = np.zeros((0, 1 + PIECE_BYTES // 8), np.uint64)
        self.starts, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, np.uint32)
        self.now = 0

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids one after another, and how many each has; encoded as one text, told apart by offsets."""
        if not pieces:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ends = np.cumsum([len(p) + 1 for p in pieces])
        found = self.public.encode(" ".join(pieces), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
        return ids, np.bincount(np.searchsorted(ends, at, "right"), minlength=len(pieces))

    def _learn(self, keys: np.ndarray, exact: np.ndarray, pieces: list[str]) -> None:
        ids, sizes = self._encode(pieces)
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, ids])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.exact = np.insert(self.keys, at, keys), np.insert(self.exact, at, exact, axis=0)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)
        self.used = np.insert(self.used, at, self.now)

    def _drop(self, at: np.ndarray) -> None:
        """Another piece of the same hash takes their place."""
        if len(at):
            self.keys, self.exact, self.starts, self.sizes, self.used = (np.delete(x, at, axis=0) for x in (self.keys, self.exact, self.starts, self.sizes, self.used))

    def _forget(self) -> None:
        """Keep the half used last."""
        keep = self.used > np.median(self.used)
        sizes = self.sizes[keep]
        self.pool = self.pool[np.repeat(self.starts[keep] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
        self.keys, self.exact, self.used = self.keys[keep], self.exact[keep], self.used[keep]
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes

    def _bytes(self, words: _text.Words, short: np.ndarray) -> np.ndarray:
        """A row for each word of `short`: its length and its bytes, A-Z as a-z."""
        folded = np.concatenate([_FOLD[words.bytes], np.zeros(8, np.uint8)])
        eight = np.ndarray((len(folded) - 7,), "<u8", folded, strides=(1,))  # the eight bytes from each place on
        lengths = words.ends[short] - words.starts[short]
        out = np.zeros((len(short), self.exact.shape[1]), np.uint64)
        out[:, 0] = lengths
        for j in range(1, out.shape[1]):
            todo = np.flatnonzero(lengths > 8 * (j - 1))
            rest = np.minimum(lengths[todo] - 8 * (j - 1), 8).astype(np.uint64)
            out[todo, j] = eight[words.starts[short[todo]] + 8 * (j - 1)] & (np.uint64(2**64 - 1) >> (np.uint64(64) - rest * np.uint64(8)))
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array, and where each text's begin (one more than there are texts)."""
        words = _text.Words(texts, (_LETTER, _STOP))
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        self.now += 1
        if len(self.keys) > REMEMBERED_PIECES:
            self._forget()
        data = words.bytes.tobytes()
        told = lambda at: [data[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
        apart = words.ends - words.starts > PIECE_BYTES
        apart[np.searchsorted(words.starts, np.flatnonzero(words.bytes == ord("<")), "right") - 1] = True
        short = np.flatnonzero(~apart)
        exact = self._bytes(words, short)
        hashes = np.zeros(len(short), np.uint64)
        for j in range(exact.shape[1]):
            hashes = _text.mix(hashes ^ exact[:, j])
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        alike = (exact[first[inverse]] == exact).all(axis=1)
        apart[short[~alike]] = True  # words of one hash and other bytes
        at = np.searchsorted(self.keys, distinct)
        at[at == len(self.keys)] = 0
        same = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        known = same.copy()
        known[same] = (self.exact[at[same]] == exact[first[same]]).all(axis=1)
        self._drop(at[same & ~known])
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(distinct[new], exact[first[new]], told(short[first[new]]))
        at = np.searchsorted(self.keys, distinct)
        self.used[at] = self.now
        # Of each word where its ids begin in the pool, behind which the ids of words encoded anew follow.
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[short], sizes[short] = self.starts[at[inverse]], self.sizes[at[inverse]]
        anew = np.flatnonzero(apart)
        more, sizes[anew] = self._encode(told(anew))
        starts[anew] = len(self.pool) + np.cumsum(sizes[anew]) - sizes[anew]
        pool = np.concatenate([self.pool, more]) if len(anew) else self.pool
        before = np.concatenate([[0], np.cumsum(sizes)])
        flat = pool[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])]
        return flat, before[words.first]


#: A piece: doc_id, start in its document, ids, tokens of its document.
Piece = tuple[int, int, np.ndarray, int]


class Packer:
    """Packs documents in the order of `add`; `emit` gets each finished window's pieces."""

    def __init__(self, capacity: int, emit: Callable[[list[Piece]], None]):
        self.capacity, self.emit = capacity, emit
        self.levels = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self.emit([(doc_id, start, ids[start : start + self.capacity], total)])
            start += self.capacity
        if start < total:
            self._place((doc_id, start, ids[start:], total))

    def level_for(self, s: int) -> int:
        """The fill level of least increase of the sum of squares; 0 is a new window, ties go to the fullest."""
        n, c = self.levels, self.capacity
        rise = 2 * (n[s : c + 1] - n[: c + 1 - s]) + 2  # leave level h, enter level h + s
        rise[0] = 2 * n[s] + 1
        rise[c - s] = 1 - 2 * n[c - s]  # the window is full and counts no more
        rise[1:][n[1 : c + 1 - s] == 0] = np.iinfo(np.int64).max
        return int(c - s - np.argmin(rise[::-1]))

    def _place(self, piece: Piece) -> None:
        s = len(piece[2])
        h = self.level_for(s)
        if h:
            pieces = self.windows[h].pop()
            self.levels[h] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if h + s == self.capacity:
            self.emit(pieces)
            return
        self.windows[h + s].append(pieces)
        self.levels[h + s] += 1
        self.open += 1
        if self.open >= OPEN_LIMIT:
            self._settle(False)

    def _settle(self, end: bool) -> None:
        """Cut the emptiest open windows to fill the fullest, until one is left; at the end that goes out too."""
        rest = [p for h in range(self.capacity, 0, -1) for p in self.windows[h]]
        self.windows = [[] for _ in range(self.capacity + 1)]
        self.levels[:] = 0
        self.open = 0
        low = len(rest) - 1
        for at, pieces in enumerate(rest):
            if at > low:
                break
            gap = self.capacity - sum(len(p[2]) for p in pieces)
            while gap and low > at:
                doc_id, start, ids, total = rest[low].pop()
                # The piece's end is cut off; so it stays where it is unless it goes whole.
                take = min(gap, len(ids))
                if take < len(ids):
                    rest[low].append((doc_id, start, ids[: len(ids) - take], total))
                pieces.append((doc_id, start + len(ids) - take, ids[len(ids) - take :], total))
                gap -= take
                if not rest[low]:
                    low -= 1
            if not gap or end:
                self.emit(pieces)
            else:
                fill = self.capacity - gap
                self.windows[fill].append(pieces)
                self.levels[fill] += 1
                self.open += 1

    def finish(self) -> None:
        self._settle(True)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces (SCHEMA, and with_ids their ids as array<int>) of docs(doc_id, text, ...).

    A document is the ids of its whole text, then end_id; null or empty text is end_id alone. offset is
    gapless from 0 in each sequence; every sequence is full but at most one a partition. sequence_id is
    the partition's number times 2^32 plus a count. Rows with equal doc_id are documents of their own.
    Null doc_ids stay null; extra columns are ignored; an empty table gives no pieces.
    """
    prepare(docs.sparkSession)
    fields = [f.split() for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.load(tokenizer_path)
        part, count = TaskContext.get().partitionId() << 32, 0
        rows: list[tuple] = []

        def emit(pieces: list[Piece]) -> None:
            nonlocal count
            offset = 0
            for doc_id, start, ids, total in pieces:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, part + count, offset, ids.astype(np.int32) if with_ids else None))
                offset += len(ids)
            count += 1

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:7]]
            names = [f[0] for f in fields]
            if with_ids:
                columns.append(pa.array([r[7] for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        packer = Packer(capacity, emit)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), _text.plain(batch.column(1))
            for start, stop in _text.steps(texts):
                flat, bounds = tokenizer.ids(texts.slice(start, stop - start))
                for i, name in enumerate(names[start:stop]):
                    packer.add(name, np.concatenate([flat[bounds[i] : bounds[i + 1]], end]))
                if rows:
                    yield batch_of()
        packer.finish()
        if rows:
            yield batch_of()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
