"""Quality rules by compression bands.

A text's zstandard ratio (raw bytes over compressed bytes, level 3) rises with its length, as the
compressor has more to refer to, so its limits are functions of its length. Above the band a text
repeats itself; below it, it is noise, a key or an encoded file. Fixed chunks get a band too, as a long
sound text can hide a repeated or encoded half. Counts of words, symbols and repeats come with it.
Arrow batches, one pass to fit the limits and one to judge; no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from . import _text
from ._session import prepare

#: (bytes, least ratio, greatest ratio) of whole texts, by length; between two lengths limits run straight over the
#: logarithm of the length. CHUNK_BYTES is one length of its own.
Bands = tuple[tuple[int, float, float], ...]

#: The widest bands. Prose in European languages lies well inside; limits come closer where sound texts are known.
BANDS: Bands = (
    (96, 0.6, 2.2),
    (256, 1.05, 2.2),
    (724, 1.15, 2.3),
    (1448, 1.25, 2.4),
    (2896, 1.35, 2.5),
    (5793, 1.4, 2.6),
    (11_585, 1.45, 2.75),
    (23_170, 1.5, 2.9),
    (46_341, 1.5, 3.1),
    (92_682, 1.5, 3.4),
)
#: A text of more bytes than this is judged by chunks of so many; the last chunk ends with the text and may overlap.
CHUNK_BYTES = 2048
#: The widest band of chunks: random base64 has 1.29, a passage and its repeat more than 2.45.
CHUNK_BAND = (1.55, 2.45)
#: A text goes when at least this share of its chunks lies outside the band.
BAD_CHUNKS = 0.3
#: fit_bands: sound texts that a length takes its limits from at least, those of lengths around it included; the share
#: of them outside on either side; what is added to the limits of texts, an octave away from any, and of chunks; and the
#: steps of an octave of length and of the ratio by which it counts, up to a ratio of 4.
CLASS_ROWS = 200
OUTSIDE = 0.001
MARGIN, FAR_MARGIN, CHUNK_MARGIN = 0.03, 0.05, 0.1
OCTAVE, STEPS = 8, 500
MAX_STEP = 4 * STEPS
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "bad_chunks", "kept")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip("\x20\t\n\x0b\x0c\r"):
            if line in seen:
                n += 1
            else:
                seen.add(line)
    return n


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more."""
    triples = _text.windows(hashes, 3)
    if not len(triples):
        return 0
    _, inverse, counts = np.unique(triples, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    inside = np.zeros(len(hashes), bool)
    for j in range(3):
        inside[j : j + len(twice)] |= twice
    return int(inside.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


class Limits(NamedTuple):
    """Bands of whole texts by length, and that of chunks."""

    bands: Bands = BANDS
    chunk: tuple[float, float] = CHUNK_BAND

    def of(self, size: int) -> tuple[float, float]:
        """Least and greatest ratio of a text of so many bytes."""
        at, low, high = zip(*self.bands, strict=True)
        x = math.log2(max(size, 1))
        return float(np.interp(x, np.log2(at), low)), float(np.interp(x, np.log2(at), high))


WIDEST = Limits()


def chunk_ratios(raw: bytes, compressor: zstandard.ZstdCompressor) -> list[float]:
    """Ratios of the chunks of a text of more than one chunk."""
    n = -(-len(raw) // CHUNK_BYTES)
    starts = [min(i * CHUNK_BYTES, len(raw) - CHUNK_BYTES) for i in range(n)] if n > 1 else []
    return [CHUNK_BYTES / len(compressor.compress(raw[i : i + CHUNK_BYTES])) for i in starts]


def compression(raw: bytes, compressor: zstandard.ZstdCompressor, limits: Limits = WIDEST) -> tuple[float, float, bool]:
    """Whole-text ratio, share of chunks outside their band, and whether both bands hold."""
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    chunks = chunk_ratios(raw, compressor)
    bad = sum(not limits.chunk[0] <= c <= limits.chunk[1] for c in chunks)
    low, high = limits.of(len(raw))
    return ratio, bad / max(1, len(chunks)), low <= ratio <= high and bad < BAD_CHUNKS * max(1, len(chunks))


def _measure(batch: pa.RecordBatch, text_at: int, limits: Limits) -> dict[str, list]:
    out: dict[str, list] = {c: [] for c in COLUMNS}
    compressor = zstandard.ZstdCompressor(level=3)
    texts = _text.plain(batch.column(text_at))
    for start, stop in _text.steps(texts):
        own = texts.slice(start, stop - start)
        words = _text.Words(own)
        hashes = words.hashes(False)
        bounds = _text._offsets(own)
        bounds = bounds - bounds[0]
        chars = _sums(words.mask & ((words.bytes & 0xC0) != 0x80), bounds)
        symbols = _sums(_SYMBOL[words.bytes], bounds)
        for i, text in enumerate(own):
            raw = text.as_buffer().to_pybytes()
            n = int(words.counts[i])
            repeats = repeated_words(hashes[words.first[i] : words.first[i + 1]])
            failed = base_failed(n, repeats)
            ratio, bad, sound = compression(raw, compressor, limits)
            for c, v in zip(COLUMNS, (n, int(chars[i]), int(symbols[i]), duplicate_lines(text.as_py()), repeats, failed, ratio, bad, sound and not failed), strict=True):
                out[c].append(v)
    return out


def _sound_counts(docs: DataFrame, labels: DataFrame) -> list:
    """(size, step, n): texts of quality 1 that the base rules pass, by length and ratio in steps; and their chunks, of size -1."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType([docs.schema["doc_id"], StructField("found", ArrayType(ArrayType(LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        step = lambda ratio: min(int(STEPS * ratio), MAX_STEP)
        for batch in batches:
            at, found = [], []
            texts = _text.plain(batch.column(1))
            for start, stop in _text.steps(texts):
                own = texts.slice(start, stop - start)
                words = _text.Words(own)
                hashes = words.hashes(False)
                for i, text in enumerate(own):
                    if not base_failed(int(words.counts[i]), repeated_words(hashes[words.first[i] : words.first[i + 1]])):
                        raw = text.as_buffer().to_pybytes()
                        at.append(start + i)
                        whole = [int(OCTAVE * math.log2(len(raw))), step(len(raw) / len(compressor.compress(raw)))]
                        found.append([whole, *([-1, step(c)] for c in chunk_ratios(raw, compressor))])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.list_(pa.list_(pa.int64())))], ["doc_id", "found"])

    sound = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    found = docs.mapInArrow(run, schema).join(sound, "doc_id", "left_semi")  # after the texts are read, so that only counts move
    found = found.select(F.explode("found").alias("f")).select(F.col("f")[0].alias("size"), F.col("f")[1].alias("step"))
    return found.groupBy("size", "step").agg(F.count("*").alias("n")).collect()


def fit_bands(docs: DataFrame, labels: DataFrame) -> Limits:
    """The limits that texts which labels(doc_id, quality, ...) calls sound lie within, but for OUTSIDE of them.

    All sound ids count. Texts that the base rules reject don't. Around each length of BANDS the texts of so many
    octaves as hold CLASS_ROWS of them give a line of the ratio over the logarithm of the length; the limits are quantiles of the
    distances from these lines, taken as widely, and MARGIN. At lengths without any text, lines run on like the widest
    bands, with FAR_MARGIN more an octave. Chunks have the quantiles of all chunks. With fewer than
    CLASS_ROWS texts in all, limits lie between these and the widest ones in proportion. They never grow wider than
    those. No labels: the widest. What comes to the driver are counts, at most MAX_STEP a step of length.
    """
    rows = _sound_counts(docs, labels)
    whole = np.array(sorted((r["size"], r["step"], r["n"]) for r in rows if r["size"] >= 0), np.float64).reshape(-1, 3)
    if not len(whole):
        return WIDEST
    x, ratio, n = (whole[:, 0] + 0.5) / OCTAVE, (whole[:, 1] + 0.5) / STEPS, whole[:, 2]
    part = min(1.0, n.sum() / CLASS_ROWS)
    knots = np.log2([size for size, *_ in BANDS])

    def near(k: float) -> np.ndarray:
        radius = 0.5
        while radius < 20 and n[np.abs(x - k) <= radius].sum() < CLASS_ROWS:
            radius += 0.25
        return np.abs(x - k) <= radius

    # Heights are counted from the middle of BANDS, which goes on where no texts are.
    usual = np.array([(low + high) / 2 for _, low, high in BANDS])
    ratio = ratio - np.interp(x, knots, usual)
    middle = np.array([_height(x[m] - k, ratio[m], n[m]) for k in knots for m in [near(k)]])
    apart = ratio - np.interp(x, knots, middle)
    away = np.array([max(0.0, float(np.abs(x - k).min()) - 0.5) for k in knots])
    found = []
    for k, at, far, (size, low, high) in zip(knots, usual + middle, away, BANDS, strict=True):
        m, more = near(k), MARGIN + FAR_MARGIN * far
        below, above = (at + _quantile(apart[m], n[m], q) for q in (OUTSIDE, 1 - OUTSIDE))
        found.append((size, low + part * max(0.0, below - more - low), high + part * min(0.0, above + more - high)))
    covered = [i for i in range(len(found)) if not away[i]]
    for i, (size, low, high) in enumerate(found):  # no limit is closer where no texts are than where the nearest ones are
        _, low_there, high_there = found[min(covered, key=lambda j: abs(i - j))] if covered else (0, low, high)
        found[i] = (size, min(low, low_there), max(high, min(high_there, BANDS[i][2])))
    chunks = np.array(sorted((r["step"], r["n"]) for r in rows if r["size"] < 0), np.float64).reshape(-1, 2)
    low, high = CHUNK_BAND
    if len(chunks):
        part = min(1.0, chunks[:, 1].sum() / CLASS_ROWS)
        below, above = ((_quantile(chunks[:, 0], chunks[:, 1], q) + 0.5) / STEPS for q in (OUTSIDE, 1 - OUTSIDE))
        low, high = low + part * max(0.0, below - CHUNK_MARGIN - low), high + part * min(0.0, above + CHUNK_MARGIN - high)
    return Limits(tuple((size, float(a), float(b)) for size, a, b in found), (float(low), float(high)))


def _height(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """Where the line of least squares crosses x = 0; the mean of y if all x lie to one side, as lines run off there."""
    if not (x.min() < 0 < x.max()):
        nearest = np.abs(x) <= np.abs(x).min() + 0.5
        return float(np.average(y[nearest], weights=n[nearest]))
    return float(np.polyfit(x, y, 1, w=np.sqrt(n))[1])


def _quantile(values: np.ndarray, counts: np.ndarray, q: float) -> float:
    """The least of values that with those below it has the share q of counts."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(counts[order])
    return float(values[order[np.searchsorted(upto, max(1, math.ceil(q * upto[-1])))]])


def measure(docs: DataFrame, limits: Limits = WIDEST) -> DataFrame:
    """doc_id and COLUMNS for every row of docs(doc_id, text, ...).

    Null text counts as empty: no words, ratio 0, not kept. A very long text is judged whole and by all its chunks.
    A ratio equal to a limit is within; repeated rows and null ids are judged each on its own; extra columns are
    ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    kinds = {"base_failed": BooleanType(), "kept": BooleanType(), "ratio": DoubleType(), "bad_chunks": DoubleType()}
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType([docs.schema["doc_id"], *(StructField(c, kinds.get(c, LongType())) for c in COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _measure(batch, 1, limits)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, {"base_failed": pa.bool_(), "kept": pa.bool_(), "ratio": pa.float64(), "bad_chunks": pa.float64()}.get(c, pa.int64())) for c, v in found.items())], ["doc_id", *COLUMNS])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, limits: Limits = WIDEST) -> DataFrame:
    """The rows of docs that both bands and the base rules keep, with all their columns as they were; see measure for the rest."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_measure(batch, at, limits)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
