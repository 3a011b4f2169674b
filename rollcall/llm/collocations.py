"""Phrases of 2 to 5 words that occur together more often than their parts would.

1. A sketch: each task counts word pairs in SKETCH_ROWS rows of cells, by hash; the rows are added up cell by cell, and of
   the sum only one bit a cell is kept, whether it reaches the least count. No pair that reaches it is lost, as a
   cell counts at least what its pairs do. A second sketch counts the longer phrases all of whose pairs pass.
2. Phrases that pass are candidates. They are dealt to automata of bounded size by their first pair and compiled
   there (Aho-Corasick over texts whose words, and only they, stand between single blanks, so no match begins or
   ends inside a word).
3. Shards of the corpus are scanned: of each text the stretches around an automaton's pairs go to it, and its
   overlapping matches are counted. Counts are exact from here on; they are summed, and thresholds and scores are SQL.

Counts of single words are a grouped sum. Everything is counted by language.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._session import keep, prepare, stored_bytes

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase goes where a longer one around it has so many percent of its count.
INSIDE_PERCENT = 100
SKETCH_ROWS = 2
#: Cells of a sketch row: the power of two that is nearest above a quarter of the stored bytes, between these. A worker
#: counts in 4 bytes a cell; the driver and each worker hold a bit of each.
LEAST_CELLS = 1 << 16
MOST_CELLS = 1 << 24
#: Cells that are added up and sent together.
SLICE = 1 << 16
#: Phrases of an automaton, about.
AUTOMATON_PHRASES = 50_000
#: Phrases of a group that is made distinct by one task, about.
GROUP_PHRASES = 100_000
#: Stored bytes of the corpus for each shard that is scanned, about.
SHARD_BYTES = 16 << 20

_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = re.compile(rb"[ \n]+")
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)


def plain(text: bytes) -> bytes:
    """A-Z in lower case, pieces between line feeds, words between single blanks."""
    text = text.translate(_TABLE)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


class Block:
    """Words of some texts: where they stand, what they hash to, which of them belong together."""

    def __init__(self, parts: list[tuple[bytes, int, str]]):
        """parts: plain texts, how many bytes of each are its own (phrases that begin later count elsewhere), languages."""
        self.raw = b"\n".join(p[0] for p in parts)
        offsets = np.array([0, len(self.raw)], np.int64)
        self.words = _text.Words(pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(offsets), pa.py_buffer(self.raw)]))
        self.starts, self.ends = self.words.starts, self.words.ends
        sizes = np.array([len(p[0]) + 1 for p in parts])
        first = np.cumsum(sizes) - sizes
        self.part = np.searchsorted(first, self.starts, "right") - 1
        self.own = self.starts - first[self.part] < np.array([p[1] for p in parts])[self.part]
        self.langs = sorted({p[2] for p in parts})
        self.lang = np.array([self.langs.index(p[2]) for p in parts])[self.part] if parts else np.zeros(0, np.int64)
        lines = np.cumsum(self.words.bytes == 10)
        #: Whether a word and the next are of one piece.
        self.near = lines[self.starts[1:]] == lines[self.ends[:-1] - 1]

    @cached_property
    def bare(self) -> np.ndarray:
        return self.words.hashes(False)

    @cached_property
    def hashes(self) -> np.ndarray:
        """By language."""
        salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], np.uint64)
        return _text.mix(self.bare ^ salt[self.lang])

    def runs(self, k: int, by_lang: bool = True) -> np.ndarray:
        """A hash of the k words from each word on."""
        n, own = max(0, len(self.starts) - k + 1), self.hashes if by_lang else self.bare
        out = own[:n].copy()
        for j in range(1, k):
            out = _text.mix(out * _MULTIPLY ^ own[j : j + n])
        return _text.mix(out + np.uint64(k))

    def together(self, pairs: np.ndarray, k: int) -> np.ndarray:
        """Where k words begin all of whose pairs are set in `pairs`."""
        n = max(0, len(self.starts) - k + 1)
        out = np.ones(n, bool)
        for j in range(k - 1):
            out &= pairs[j : j + n]
        return out

    def phrases(self, at: np.ndarray, k: int) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at + k - 1].tolist(), strict=True)]


def blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    """Blocks of a batch of (text, lang); null texts are left out, and a very long text is cut into slices."""
    parts, held = [], 0
    for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        for part, own in _text.slices(plain(raw), _GAP, LONGEST - 1, _text.STEP_BYTES):
            if held and held + len(part) > _text.STEP_BYTES:
                yield Block(parts)
                parts, held = [], 0
            parts.append((part, own, lang))
            held += len(part)
    if parts:
        yield Block(parts)


def _cells(hashes: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (_text.mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64)) & np.uint64(cells - 1)).astype(np.int64)


class Sketch:
    """Counts by hash, kept up to `least`."""

    def __init__(self, cells: int, least: int):
        self.cells, self.least = cells, least
        self.counts = np.zeros((SKETCH_ROWS, cells), np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        for row in range(SKETCH_ROWS):
            np.add.at(self.counts[row], _cells(hashes, row, self.cells), np.uint32(1))

    def slices(self) -> Iterator[tuple[int, bytes]]:
        """Number and cells of each slice that isn't empty; a count of least or more is least, in a byte where that fits."""
        kind = np.uint8 if self.least < 1 << 8 else np.uint32
        for i, own in enumerate(self.counts.reshape(-1, SLICE)):
            if own.any():
                yield i, np.minimum(own, self.least).astype(kind).tobytes()


@dataclass
class Bits:
    """Of each cell of a summed sketch whether it reaches the least count."""

    bits: np.ndarray
    cells: int

    def reach(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for row in range(SKETCH_ROWS):
            at = _cells(hashes, row, self.cells) + row * self.cells
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def _sum_up(slices: DataFrame, cells: int, least: int) -> Bits:
    """Add up the tasks' slices; a bit a cell comes to the driver, SKETCH_ROWS * MOST_CELLS / 8 bytes at most."""
    kind = np.uint8 if least < 1 << 8 else np.uint32
    spark = slices.sparkSession

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                now = sums.setdefault(number, np.zeros(SLICE, np.uint32))
                np.minimum(now + np.frombuffer(own.as_buffer(), kind), least, out=now)
        packed = [np.packbits(x >= least, bitorder="little").tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["slice", "cells"])

    summed = slices.repartition(max(spark.sparkContext.defaultParallelism, SKETCH_ROWS * cells // SLICE // 16), "slice").mapInArrow(add, "slice int, cells binary")
    bits = np.zeros(SKETCH_ROWS * cells // 8, np.uint8)
    for r in summed.collect():
        bits[r["slice"] * (SLICE // 8) : (r["slice"] + 1) * (SLICE // 8)] = np.frombuffer(r["cells"], np.uint8)
    return Bits(bits, cells)


def _first_pass(docs: DataFrame, cells: int, least: int) -> DataFrame:
    """Counts of words (lang, word, n) and slices of the sketch of pairs (slice, cells), in one reading."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(cells, least)
        for batch in batches:
            for b in blocks(batch):
                sketch.add(b.runs(2)[b.near & b.own[:-1]])
                at = np.flatnonzero(b.own)
                _, first, n = np.unique(b.hashes[at], return_index=True, return_counts=True)
                words = [w.decode() for w in b.phrases(at[first], 1)]
                langs = np.array(b.langs, object)[b.lang[at[first]]].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], ["lang", "word", "n", "slice", "cells"])
        for number, own in sketch.slices():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([number], pa.int32()), pa.array([own], pa.binary())], ["lang", "word", "n", "slice", "cells"])

    return docs.mapInArrow(run, "lang string, word string, n long, slice int, cells binary")


def _pairs(b: Block, bits: Bits) -> np.ndarray:
    return b.near & bits.reach(b.runs(2))


def _second_pass(docs: DataFrame, pairs: Broadcast, cells: int, least: int) -> DataFrame:
    """Slices of the sketch of longer phrases, of those whose pairs all reach the least count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(cells, least)
        for batch in batches:
            for b in blocks(batch):
                near = _pairs(b, pairs.value)
                for k in range(3, LONGEST + 1):
                    at = b.together(near, k)
                    sketch.add(b.runs(k)[at & b.own[: len(at)]])
        for number, own in sketch.slices():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([own], pa.binary())], ["slice", "cells"])

    return docs.mapInArrow(run, "slice int, cells binary")


def _candidates(docs: DataFrame, pairs: Broadcast, longer: Broadcast, groups: int) -> DataFrame:
    """Distinct phrases that pass both sketches in any language, and a hash of each's first pair.

    A task tells the phrases it hasn't told yet in lists, one for each group of first pairs in a block of text.
    """
    lists = pa.list_(pa.string()), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for b in blocks(batch):
                near, shorter = _pairs(b, pairs.value), None
                first = b.runs(2, by_lang=False)
                told: dict[int, tuple[list[str], list[int]]] = {}
                for k in range(2, LONGEST + 1):
                    at, hashes = b.together(near, k), b.runs(k)
                    if k > 2:  # both phrases of one word less are candidates too
                        at &= shorter[:-1] & shorter[1:] & longer.value.reach(hashes)
                    shorter = at
                    own = np.flatnonzero(at & b.own[: len(at)])
                    distinct, place = np.unique(hashes[own], return_index=True)
                    new = np.array([h not in seen for h in distinct.tolist()], bool)
                    seen.update(distinct[new].tolist())
                    where = own[place[new]]
                    pair = first[where].astype(np.int64)
                    for g, phrase, p in zip(_owner(pair, groups).tolist(), b.phrases(where, k), pair.tolist(), strict=True):
                        phrases, hashed = told.setdefault(g, ([], []))
                        phrases.append(phrase.decode())
                        hashed.append(p)
                columns = [pa.array(list(told), pa.int32()), *(pa.array([t[i] for t in told.values()], lists[i]) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, ["g", "phrases", "pairs"])
                if len(seen) > 1_000_000:  # told again, they only repeat
                    seen.clear()

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            phrases, hashed = batch.column(1).flatten().to_pylist(), batch.column(2).flatten().to_pylist()
            new = [(p, h) for p, h in dict(zip(phrases, hashed, strict=True)).items() if p not in seen]
            seen.update(p for p, _ in new)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in new], pa.string()), pa.array([h for _, h in new], pa.int64())], ["phrase", "pair"])

    told = docs.mapInArrow(run, "g int, phrases array<string>, pairs array<long>")
    return told.repartition(groups, "g").mapInArrow(once, "phrase string, pair long")


def _owner(pairs: np.ndarray, automata: int) -> np.ndarray:
    return (_text.mix(pairs.astype(np.uint64) + np.uint64(77)) % np.uint64(automata)).astype(np.int64)


def _stretches(docs: DataFrame, pairs: Broadcast, automata: int) -> DataFrame:
    """automaton, lang, weight and text: of each text the words that phrases of an automaton may cover, a stretch a line.

    A phrase that begins at a word has its first pair there, so it's counted by that pair's automaton alone, in the
    one stretch that holds it. Where a slice of a very long text ends inside a stretch, what the stretch holds of the
    next slice is listed once more with weight -1, as the next slice counts it too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch):
                near = _pairs(b, pairs.value)
                reach = sum((np.pad(b.together(near, k), (0, k - 2))[: len(near)] for k in range(3, LONGEST + 1)), near.astype(np.int64))
                at = np.flatnonzero(near & b.own[: len(near)])
                if not len(at):
                    continue
                owner = _owner(b.runs(2, by_lang=False)[at].astype(np.int64), automata) * len(b.langs) + b.lang[at]
                order = np.argsort(owner, kind="stable")
                at, owner = at[order], owner[order]
                last = at + reach[at]
                new = np.ones(len(at), bool)  # where a stretch begins that shares no word with the one before
                new[1:] = (owner[1:] != owner[:-1]) | (at[1:] > last[:-1])
                begins = np.flatnonzero(new)
                closes = np.append(begins[1:], len(at)) - 1
                rows: dict[tuple[int, int], list[bytes]] = {}
                owned = np.cumsum(b.own)
                first, end = at[begins], last[closes]
                other = first + owned[end] - owned[first] + 1  # the first word of the next slice
                for o, a, z in zip(owner[begins].tolist(), b.starts[first].tolist(), b.ends[end].tolist(), strict=True):
                    rows.setdefault((o, 1), []).append(b.raw[a:z])
                over = np.flatnonzero(other < end)
                for o, a, z in zip(owner[begins[over]].tolist(), b.starts[other[over]].tolist(), b.ends[end[over]].tolist(), strict=True):
                    rows.setdefault((o, -1), []).append(b.raw[a:z])
                automaton, lang = np.divmod([o for o, _ in rows], len(b.langs))
                texts = [(b" " + b" \n ".join(x) + b" ").decode() for x in rows.values()]
                langs = [b.langs[i] for i in lang.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(automaton, pa.int32()), pa.array(langs, pa.string()), pa.array([w for _, w in rows], pa.int32()), pa.array(texts, pa.string())], ["automaton", "lang", "weight", "text"])

    return docs.mapInArrow(run, "automaton int, lang string, weight int, text string")


def _scan(rows: DataFrame) -> DataFrame:
    """lang, phrase, n by task: rows of one automaton stand together, lists of its phrases (no lang) before its texts by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: list[str] = []
        machine, counts, now = None, np.zeros(0, np.int64), (None, None)

        def told() -> pa.RecordBatch:
            found = np.flatnonzero(counts)
            out = [pa.array([now[1]] * len(found), pa.string()), pa.array([phrases[i] for i in found.tolist()], pa.string()), pa.array(counts[found], pa.int64())]
            counts[:] = 0
            return pa.RecordBatch.from_arrays(out, ["lang", "phrase", "n"])

        for batch in batches:
            for automaton, lang, weight, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (automaton, lang) != now:
                    if counts.any():
                        yield told()
                    if automaton != now[0]:
                        phrases, machine, counts = [], None, np.zeros(0, np.int64)
                    now = (automaton, lang)
                if lang is None:
                    phrases += text.split("\n")
                    continue
                if machine is None and phrases:
                    machine, counts = ahocorasick.Automaton(), np.zeros(len(phrases), np.int64)
                    for i, phrase in enumerate(phrases):
                        machine.add_word(f" {phrase} ", i)
                    machine.make_automaton()
                if phrases:
                    counts += weight * np.bincount(np.fromiter(map(itemgetter(1), machine.iter(text)), np.int64), minlength=len(phrases))
        if counts.any():
            yield told()

    return rows.mapInArrow(run, "lang string, phrase string, n long")


def _count(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts of words (lang, phrase, f), and of all phrases that reach the least count (lang, phrase, a)."""
    spark = docs.sparkSession
    prepare(spark)
    stored = stored_bytes(docs)
    docs = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, stored // 4 - 1).bit_length()))
    first = keep(_first_pass(docs, cells, least))
    words = first.where("word is not null").groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("n").alias("f"))
    slices = ["slice", "cells"]
    pairs = spark.sparkContext.broadcast(_sum_up(first.where("slice is not null").select(slices), cells, least))
    longer = spark.sparkContext.broadcast(_sum_up(_second_pass(docs, pairs, cells, least), cells, least))
    # Set cells are about as many as candidates, or fewer.
    passed = int(np.bitwise_count(pairs.value.bits).sum() + np.bitwise_count(longer.value.bits).sum()) // SKETCH_ROWS
    found = keep(_candidates(docs, pairs, longer, max(spark.sparkContext.defaultParallelism, passed // GROUP_PHRASES)))
    automata = max(1, -(-found.count() // AUTOMATON_PHRASES))
    shards = -(-max(spark.sparkContext.defaultParallelism, -(-stored // SHARD_BYTES)) // automata)
    n = automata * shards

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: dict[int, list[str]] = {}
            for own, phrase in zip(_owner(batch.column(1).to_numpy(zero_copy_only=False), automata).tolist(), batch.column(0).to_pylist(), strict=True):
                lists.setdefault(own, []).append(phrase)
            yield pa.RecordBatch.from_arrays([pa.array(list(lists), pa.int32()), pa.array(["\n".join(x) for x in lists.values()], pa.string())], ["automaton", "text"])

    compiled = found.mapInArrow(owners, "automaton int, text string").select("automaton", F.lit(None).cast("string").alias("lang"), F.lit(0).alias("weight"), "text", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    texts = _stretches(docs, pairs, automata).withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    # One shard of one automaton a task: the phrases first, as null languages sort first, then texts.
    dealt = compiled.unionByName(texts).repartitionById(n, (F.col("automaton") * shards + F.col("shard")).cast("int"))
    dealt = dealt.sortWithinPartitions("automaton", "lang").select("automaton", "lang", "weight", "text")
    counts = _scan(dealt).groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    return keep(words), keep(counts)


def score_counts(words: DataFrame, counts: DataFrame, inside_percent: int = INSIDE_PERCENT, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score from words (lang, phrase, f) and counts (lang, phrase, a), both whole."""
    split = counts.withColumn("words", F.split("phrase", " "))
    size = F.size("words")
    # Parts of a phrase that reaches the least count reach it too.
    f = keep(words.where(F.col("f") >= least).unionByName(counts.select("lang", "phrase", F.col("a").alias("f"))))
    cut = split.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    part = lambda begin, length: F.array_join(F.slice("words", begin, length), " ")
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    cut = cut.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cut = cut.join(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang")
    score = F.expr("(cast(a as decimal(38,0)) * n * 1000) div (cast(l as decimal(38,0)) * r)")
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    around = split.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(around, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, inside_percent: int = INSIDE_PERCENT, top: int = TOP) -> DataFrame:
    """The best phrases of each language of docs(text, lang, ...): lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z; a phrase lies within a piece between stops or line ends, and blanks and tabs divide words. a is
    a phrase's count with overlaps, l and r those of its parts at the cut of lowest score (ties: the shorter first
    part), n the language's words, score = 1000 a n / (l r) rounded down, computed in decimals. A phrase inside a
    longer one that occurs inside_percent % as often goes. Equal scores are in order of a, then of the phrase's bytes.

    Null and empty texts have no words; a null language counts as "und". Repeated rows count each. A very long text is
    read in slices. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    words, counts = _count(docs, least)
    return score_counts(words, counts, inside_percent, top, least)


#: DuckDB's twin of op12.
SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), runs AS (
    SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS k))
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL
), words AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), often AS (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE a >= 100
), cuts AS (
    SELECT lang, phrase, a, k, c, array_to_string(ws[1 : c], ' ') AS one, array_to_string(ws[c + 1 : k], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS c FROM often WHERE k > 1)
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, c, x.a AS l, y.a AS r, n, ((1000::HUGEINT * cuts.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
    FROM cuts JOIN often x ON x.lang = cuts.lang AND x.phrase = one JOIN often y ON y.lang = cuts.lang AND y.phrase = rest JOIN words ON words.lang = cuts.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_parts AS (
    SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, a
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM often WHERE k > 2))
), around AS (
    SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL
)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.phrase) AS rank, best.phrase, best.a, l, r, n, score
FROM best LEFT JOIN around ON around.lang = best.lang AND around.phrase = best.phrase
WHERE longer IS NULL OR longer < best.a
QUALIFY rank <= 2000
"""
