"""Token ids in binary files: a concatenated id array a shard, with Elias-Fano encoded document boundaries.

Documents are dealt to ranges of doc_id and sorted there; each range is tokenized and written as shards of bounded
size by one task, through Spark's own file writer, so a lost task leaves nothing behind. A shard is one file:

    head      MAGIC, then little-endian: range, shard in the range (u4), bytes an id (u4), documents without a
              doc_id (u4), documents, ids (u8), least doc_id (i8)
    ids       the ids of all its documents one after another, padded to 8 bytes
    ends      where each document ends in the id array, Elias-Fano encoded
    names     doc_id less the least one, of each document with one, Elias-Fano encoded
    a line feed, which the writer adds

Both sequences ascend, so a document's boundaries and a doc_id's place come from select, with about 2 + log2(ids a
document) bits a document and no table of 64-bit offsets. Nothing but a shard's head tells where it stands, so a
document's place among all ids is a prefix sum over the shards' sizes.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _text, elias_fano
from ._session import keep, new_folder, prepare, stored_bytes

MAGIC = b"RCTOKEN1"
_HEAD = struct.Struct("<8sIIIIQQq")
#: Ids and documents of a shard, at most; a document of more ids is a shard of its own.
SHARD_IDS = 4_000_000
SHARD_DOCS = 1_000_000
#: Stored bytes of a range, about, and how many ranges there are at most; larger ranges only write more shards.
RANGE_BYTES = 32 << 20
MOST_RANGES = 20_000
#: Pieces whose ids a worker remembers; beyond that it forgets the half learned first, but for what the texts at hand
#: have. Longer pieces are encoded each time.
REMEMBERED_PIECES = 600_000
PIECE_CHARS = 24
#: Characters of a text that are cut into pieces at once.
STEP_CHARS = 1 << 20

SCHEMA = "range int, shard int, at int, shard_ids long, doc_id long, start long, n_tokens long, ids_crc32 long"

# White space of the pre-tokenizer; of text in ASCII alone it is the first few.
_SPACE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_PIECES = re.compile(r"[ \t-\r]*[A-Za-z]+|[ \t-\r]*[^ \t-\rA-Za-z]+[A-Za-z]*|[ \t-\r]+")
_PIECES = re.compile(rf"[{_SPACE}]*[A-Za-z]+(?=[.,;:!?])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_SAFE = re.compile(r"(?<=[A-Za-z])(?=[ \n.,;:!?])")
#: A unit of the pre-tokenizer, and what it makes of a space.
_LETTERS = re.compile(r" ?[A-Za-z]+")
_BLANK = "\u0120"
#: White space by some tables only.
_ODD = "\u180e"
_PLAIN = re.compile(rf" ?[^{_SPACE}{_ODD}]+")


class ByteTokenizer:
    """Ids of whole texts by a tokenizers file, from the ids of each distinct piece where its pre-tokenizer allows.

    The byte-level pre-tokenizer never joins a letter with the white space or sign that follows it, nor what stands
    before white space with it, so texts are cut there and pieces are encoded apart. A text with one of the file's
    added tokens, or with a character that is white space by some tables only, is encoded whole; so are all texts
    where the file has a normalizer or another pre-tokenizer.
    """

    _loaded: dict[str, ByteTokenizer] = {}

    @classmethod
    def load(cls, path: str) -> ByteTokenizer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.public = Tokenizer.from_file(path)
        own = json.loads(self.public.to_str())
        before = own["pre_tokenizer"] or {}
        self.pieces = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and own["normalizer"] is None
        self.whole = [_ODD, *(t["content"] for t in own["added_tokens"])]
        self.width = 2 if max(self.public.get_vocab().values(), default=0) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.line_end = self._encode(["\n"])[0] if self.pieces else b""
        self.known = _Known()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.public.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: Iterable[str]) -> None:
        """A space at most and letters are one unit of the pre-tokenizer, which the model itself encodes. Other pieces
        without white space inside are encoded as lines of one text: a lone line end is a token of its own."""
        code, model, others = "H" if self.width == 2 else "I", self.public.model, []
        for p in pieces:
            if _LETTERS.fullmatch(p):
                self.known[p] = array(code, [t.id for t in model.tokenize(p.replace(" ", _BLANK))]).tobytes()
            else:
                others.append(p)
        plain = [p for p in others if _PLAIN.fullmatch(p)] if len(self.line_end) == self.width else []
        if plain:
            ids = np.frombuffer(self._encode(["\n".join(plain)])[0], self.kind)
            cuts = np.flatnonzero(ids == np.frombuffer(self.line_end, self.kind)[0])
            if len(cuts) == len(plain) - 1:
                raw, bounds = ids.tobytes(), (np.concatenate([[-1], cuts, [len(ids)]]) * self.width).tolist()
                self.known.update((p, raw[a + self.width : b]) for p, a, b in zip(plain, bounds, bounds[1:], strict=False))
        rest = [p for p in others if p not in self.known]
        self.known.update(zip(rest, self._encode(rest), strict=True))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian numbers of `width` bytes."""
        full, used = len(self.known) > REMEMBERED_PIECES, set()
        out: list[list[bytes | None]] = []
        missed: list[list[str]] = []
        for text in texts:
            own: list[bytes | None] = []
            if not self.pieces or any(w in text for w in self.whole):
                own += self._encode([text])
                text = ""
            at = 0
            while at < len(text):
                cut = _SAFE.search(text, at + STEP_CHARS) if len(text) - at > STEP_CHARS else None
                end = cut.start() if cut else len(text)
                part = text[at:end]
                pieces = (_ASCII_PIECES if part.isascii() else _PIECES).findall(part)
                own += map(self.known.__getitem__, pieces)
                if full:
                    used.update(pieces)
                at = end
            out.append(own)
            missed.append(self.known.missed)
            self.known.missed = []
        new = dict.fromkeys(itertools.chain.from_iterable(missed))
        self._learn(new)
        for own, pieces in zip(out, missed, strict=True):
            at = -1
            for piece in pieces:  # in the order in which they were missed
                at = own.index(None, at + 1)
                own[at] = self.known[piece]
        for piece in new:
            if len(piece) > PIECE_CHARS:
                del self.known[piece]
        if full:
            for piece in list(itertools.islice(self.known, len(self.known) // 2)):
                if piece not in used:
                    del self.known[piece]
        return map(b"".join, out)


class _Known(dict[str, bytes]):
    """Ids by piece; a lookup that fails gives None and is written down."""

    def __init__(self) -> None:
        self.missed: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.missed.append(piece)


def shard_bytes(part: int, number: int, width: int, names: list[int | None], ids: list[bytes]) -> bytes:
    """A shard's file without the last line feed: documents of these names, those without a name first, and their ids."""
    own = [n for n in names if n is not None]
    least = own[0] if own else 0
    body = b"".join(ids)
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.uint64)
    head = _HEAD.pack(MAGIC, part, number, width, len(names) - len(own), len(names), len(body) // width, least)
    above = np.array([n - least for n in own], np.uint64)
    return b"".join([head, body, bytes(-len(body) % 8), elias_fano.encode(ends), elias_fano.encode(above)])


class Shard:
    """A shard's documents by rank or doc_id, straight from the file's bytes."""

    def __init__(self, data: bytes | memoryview):
        magic, self.part, self.number, self.width, self.unnamed, self.n_docs, self.n_ids, self.least = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no token file")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, _HEAD.size)
        at = _HEAD.size + self.n_ids * self.width
        at += -(self.n_ids * self.width) % 8
        self.ends = elias_fano.EliasFano(memoryview(data)[at:])
        self.names = elias_fano.EliasFano(memoryview(data)[at + self.ends.size :])

    def bounds(self, rank: int) -> tuple[int, int]:
        """Where the document of this rank begins and ends in the id array."""
        if rank:
            first, last = self.ends.select(np.array([rank - 1, rank])).tolist()
            return first, last
        return 0, int(self.ends.select(np.array([0]))[0])

    def document(self, rank: int) -> np.ndarray:
        first, last = self.bounds(rank)
        return self.ids[first:last]

    def find(self, doc_id: int) -> range:
        """Ranks of the documents of this doc_id."""
        if doc_id < self.least:
            return range(0)
        return range(self.unnamed + self.names.rank(doc_id - self.least), self.unnamed + self.names.rank(doc_id - self.least + 1))

    def doc_ids(self) -> list[int | None]:
        return [None] * self.unnamed + [self.least + n for n in self.names.all().tolist()]


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of docs(doc_id, text, ...) to a new folder in ascending doc_id order, each document with end_id behind it.

    Null and empty texts are end_id alone. Null doc_ids come first. Rows of equal doc_id are documents of their own,
    in the order of their texts' hash; repeated rows are written each. A very long text is tokenized in steps and may be
    a shard of its own. Extra columns are ignored, whatever their names; an empty table gives no shards.
    """
    spark = docs.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer.load(tokenizer_path)
        end = np.array([end_id], tokenizer.kind).tobytes()
        part, count, held = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        ids: list[bytes] = []

        def shard() -> pa.RecordBatch:
            nonlocal count, held
            data = shard_bytes(part, count, tokenizer.width, names, ids)
            count, held = count + 1, 0
            names.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in batches:
            texts = _text.plain(batch.column(1))
            for start, stop in _text.steps(texts):
                for name, own in zip(batch.column(0).slice(start, stop - start).to_pylist(), tokenizer.ids(texts.slice(start, stop - start).to_pylist()), strict=True):
                    own += end
                    if names and (held + len(own) // tokenizer.width > shard_ids or len(names) == SHARD_DOCS):
                        yield shard()
                    names.append(name)
                    ids.append(own)
                    held += len(own) // tokenizer.width
        if names:
            yield shard()

    n = min(MOST_RANGES, max(spark.sparkContext.defaultParallelism, -(-stored_bytes(docs) // RANGE_BYTES)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that repeat another are dealt apart by their number, as one doc_id may hold a large share of all rows.
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.select("*", *(c.alias(f"by{i}") for i, c in enumerate(order[1:])))
    rows = rows.repartitionByRange(n, "doc_id", "by0", "by1").sortWithinPartitions("doc_id", "by0", "by1").select("doc_id", "text")
    shards = rows.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value"))
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\n").text(folder)


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """A row for each document of a folder (SCHEMA, and with_ids its ids as array<int>), start counted inside its shard."""
    prepare(spark)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                own = Shard(value.as_buffer())
                ends = own.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                wide = own.ids.astype("<u4")
                raw = memoryview(wide).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = own.n_docs
                columns = [pa.array(np.full(n, x, np.int32)) for x in (own.part, own.number)] + [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, own.n_ids, np.int64))]
                columns += [pa.array(own.doc_ids(), pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([starts, ends[-1:]]), pa.int32()), pa.array(wide.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [*names, *(["ids"] if with_ids else [])])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def digest(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from files written for it.

    start counts the ids of all documents before it: shards of a range, then ranges, by prefix sums of their sizes.
    """
    spark = docs.sparkSession
    folder = new_folder(spark)
    write(docs, tokenizer_path, folder, end_id)
    rows = keep(read(spark, folder))
    shards = rows.where("at = 0").select("range", "shard", "shard_ids")
    by_range = shards.groupBy("range").agg(F.sum("shard_ids").alias("ids"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range, MOST_RANGES at most
    by_range = by_range.select("range", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before_range"))
    inside = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shards.withColumn("before", F.coalesce(F.sum("shard_ids").over(inside), F.lit(0))).join(by_range, "range")
    firsts = firsts.select("range", "shard", (F.col("before") + F.col("before_range")).alias("first"))
    return rows.join(firsts, ["range", "shard"]).select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
