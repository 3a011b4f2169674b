"""Importance resampling towards a target distribution over hashed n-grams.

Features are runs of 1 to 3 words; a feature's bucket is its CRC-32 modulo the number of buckets. The corpus becomes
inverted postings (bucket, document, count), counted for each document before anything moves. Postings and the
corpora's bucket totals are shuffled by bucket and meet there: a bucket's gain is computed where its postings are,
each posting adds gain times count, and documents sum what their buckets added. Buckets are dealt in GROUPS runs, so
a document adds up at most so many numbers; a run's postings are salted into groups of bounded size. Of a bucket's
total only numbers meet: one vector of counts a task.

The draw adds Gumbel noise to the weights and takes the highest: a sample without replacement in proportion to
exp(weight / 1000). Ranks come from a range partitioning by score and a prefix sum of the ranges' sizes.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._session import keep, prepare, stored_bytes, unused

BUCKETS = 10_000
#: Runs of buckets that are dealt out together.
GROUPS = 16
#: Stored bytes of a group of postings, about.
GROUP_BYTES = 16 << 20
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_GAP = re.compile(rb"[\x00-/:-@\[-`{-\x7f]+")
_HEAD = struct.Struct("<IIII")


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


_CRC = _crc_table()
#: Words up to so many bytes are hashed in numpy, and hashes shifted by table.
_SHORT = 64


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values of each byte (4 x 256)."""
    return table[0, crc & 255] ^ table[1, crc >> 8 & 255] ^ table[2, crc >> 16 & 255] ^ table[3, crc >> 24]


def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """What zero bytes do to a CRC: by 0 to _SHORT + 1 of them, and by 2^m of them."""
    now = (np.arange(256, dtype=np.uint32)[None] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    short = [now]
    for _ in range(_SHORT + 1):
        now = _CRC[now & 255] ^ (now >> 8)
        short.append(now)
    doubled = [short[1]]
    for _ in range(31):
        doubled.append(_apply(doubled[-1], doubled[-1]))
    return np.stack(short), doubled


_SHIFT, _DOUBLED = _shifts()


def _shift(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each CRC as it enters that of a longer string in which `by` bytes follow."""
    flat, base = _SHIFT.reshape(-1), np.minimum(by, _SHORT + 1) * 1024
    out = flat[base + (crc & 255)] ^ flat[base + 256 + (crc >> 8 & 255)] ^ flat[base + 512 + (crc >> 16 & 255)] ^ flat[base + 768 + (crc >> 24)]
    for i in np.flatnonzero(by > _SHORT + 1):
        own, left = crc[i : i + 1], int(by[i])
        for table in _DOUBLED:
            own = _apply(table, own) if left & 1 else own
            left >>= 1
        out[i] = own[0]
    return out


def _word_crcs(words: _text.Words) -> np.ndarray:
    folded = _text._LOWER[words.bytes]
    lengths = words.ends - words.starts
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    todo = np.flatnonzero(lengths <= _SHORT)
    for j in range(_SHORT):
        todo = todo[lengths[todo] > j]
        if not len(todo):
            break
        crc[todo] = _CRC[(crc[todo] ^ folded[words.starts[todo] + j]) & 255] ^ (crc[todo] >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _SHORT):
        crc[i] = zlib.crc32(folded[words.starts[i] : words.ends[i]].tobytes())
    return crc


def features(texts: pa.Array, own: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and of each feature its text and CRC-32. With own, features that begin after so many bytes don't count."""
    words = _text.Words(texts, space=_BETWEEN)
    crc, lengths = _word_crcs(words), words.ends - words.starts
    n = len(words) if own is None else int(np.searchsorted(words.starts, own))
    text_of = np.repeat(np.arange(len(words.counts)), words.counts)
    after_space = _shift(np.full(len(words), zlib.crc32(b" "), np.uint32), lengths) ^ crc
    docs, out, run = [text_of[:n]], [crc[:n]], crc
    for k in range(1, LONGEST):
        run = _shift(run[:-1], lengths[k:] + 1) ^ after_space[k:] if len(run) else run
        inside = (text_of[k:] == text_of[: len(run)])[:n]
        docs.append(text_of[:n][: len(inside)][inside])
        out.append(run[:n][inside])
    counts = words.counts if own is None else np.array([n])
    return counts, np.concatenate(docs), np.concatenate(out)


def pack_postings(bucket: np.ndarray, doc: np.ndarray, count: np.ndarray, n_docs: int) -> bytes:
    """Postings in order of bucket, then document: gaps and counts of a byte each, larger ones behind."""
    gaps = np.diff(bucket.astype(np.int64) * n_docs + doc, prepend=-1) - 1
    more = count - 1
    far, many = gaps[gaps >= 255], more[more >= 255]
    small = [np.minimum(x, 255).astype(np.uint8).tobytes() for x in (gaps, more)]
    return b"".join([_HEAD.pack(n_docs, len(gaps), len(far), len(many)), *small, far.astype("<u8").tobytes(), many.astype("<u8").tobytes()])


def unpack_postings(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """bucket, doc, count, n_docs."""
    n_docs, n, n_far, n_many = _HEAD.unpack_from(data)
    at = _HEAD.size
    gaps, more = (np.frombuffer(data, np.uint8, n, at + i * n).astype(np.int64) for i in (0, 1))
    gaps[gaps == 255] = np.frombuffer(data, "<u8", n_far, at + 2 * n)
    more[more == 255] = np.frombuffer(data, "<u8", n_many, at + 2 * n + 8 * n_far)
    key = np.cumsum(gaps + 1) - 1
    return key // n_docs, key % n_docs, more + 1, n_docs


def _counted(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and its postings in order of bucket and text."""
    raw = texts[0].as_buffer().to_pybytes() if len(texts) == 1 and texts.nbytes > 2 * _text.STEP_BYTES else b""
    if raw:  # one very long text: its features are counted slice by slice
        n_words, total = 0, np.zeros(buckets, np.int64)
        for part, own in _text.slices(raw, _GAP, LONGEST - 1, _text.STEP_BYTES):
            # A slice may begin inside no word: it is cut at a gap. Bytes are all that counts, so none need decode.
            column = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(part)], np.int64)), pa.py_buffer(part)])
            counts, _, crc = features(column, own)
            n_words += int(counts[0])
            total += np.bincount(crc % buckets, minlength=buckets)
        bucket = np.flatnonzero(total)
        return np.array([n_words]), bucket, np.zeros(len(bucket), np.int64), total[bucket]
    words, doc, crc = features(texts)
    key, count = np.unique((crc % np.uint32(buckets)).astype(np.int64) * len(texts) + doc, return_counts=True)
    return words, key // len(texts), key % len(texts), count


def _postings(docs: DataFrame, buckets: int) -> DataFrame:
    """Of docs(row, doc_id, text), for each batch of texts: a row of postings for each group of buckets, one of the
    documents (g = -1); and for each task one of bucket totals (g = -2)."""
    size = -(-buckets // GROUPS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, total = TaskContext.get().partitionId() << 33, np.zeros(buckets, np.int64)
        kind = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64())]))
        made = lambda batch, g, blobs, docs, totals: pa.RecordBatch.from_arrays(
            [pa.array([batch] * len(g), pa.int64()), pa.array(g, pa.int32()), pa.array(blobs, pa.binary()), pa.array(docs, kind), pa.array(totals, pa.list_(pa.int64()))],
            ["batch", "g", "postings", "docs", "totals"],
        )
        for batch in batches:
            texts = _text.plain(batch.column(2))
            for start, stop in _text.steps(texts):
                n = stop - start
                words, bucket, doc, count = _counted(texts.slice(start, n), buckets)
                total += np.bincount(bucket, count, buckets).astype(np.int64)
                n_features = np.bincount(doc, count, n).astype(np.int64).tolist()
                names = (batch.column(i).slice(start, n).to_pylist() for i in (0, 1))
                rows = [dict(zip(("row", "doc_id", "n_words", "n_features"), x, strict=True)) for x in zip(*names, words.tolist(), n_features, strict=True)]
                cuts = np.searchsorted(bucket, np.arange(GROUPS + 1) * size)
                own = [g for g in range(GROUPS) if cuts[g] < cuts[g + 1]]
                blobs = [pack_postings(bucket[a:b] - g * size, doc[a:b], count[a:b], n) for g, a, b in ((g, cuts[g], cuts[g + 1]) for g in own)]
                yield made(base, [-1, *own], [None, *blobs], [rows, *[None] * len(own)], [None] * (len(own) + 1))
                base += n
        yield made(base, [-2], [None], [None], [total.tolist()])

    schema = "batch long, g int, postings binary, docs array<struct<row: long, doc_id: long, n_words: long, n_features: long>>, totals array<long>"
    return docs.mapInArrow(run, schema)


def _totals(postings: DataFrame, name: str) -> DataFrame:
    return postings.where("g = -2").select(F.posexplode("totals").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias(name))


def weigh(docs: DataFrame, target: DataFrame, row: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """row, doc_id, n_words, n_features and weight of every row of docs(doc_id, text, ...), towards target(text, ...).

    weight is the sum of floor(1000 ln(share of the bucket in target / its share in docs)) over a row's features, both
    counts and totals with one added a bucket. Null and texts without words have no features and weigh 0. A very long
    text is counted in slices. Rows count each, also repeated ones and those of equal or null doc_id. Without row, a
    column of docs that numbers its rows, numbers are made. Extra columns are ignored, whatever their names; an empty
    table gives no rows, an empty target the same share for each bucket.
    """
    prepare(docs.sparkSession)
    number = F.col(row) if row else F.monotonically_increasing_id()
    own = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    other = target.select(F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    postings = keep(_postings(own, buckets))
    both = keep(_totals(postings, "s").join(_totals(_postings(other, buckets), "t"), "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    all_s, all_t = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    size, salts = -(-buckets // GROUPS), max(1, -(-stored_bytes(postings) // (GROUPS * GROUP_BYTES)))

    def contribute(left: pa.Table, right: pa.Table) -> pa.Table:
        gain = np.zeros(size, np.float64)
        for counts in right["counts"].to_pylist():
            at, s, t = (np.array([c[x] for c in counts], np.float64) for x in ("bucket", "s", "t"))
            gain[at.astype(np.int64) % size] = np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))
        keys, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch, data in zip(left["batch"].to_pylist(), left["postings"], strict=True):
            bucket, doc, count, n = unpack_postings(data.as_py())
            part = np.bincount(doc, gain[bucket] * count, n).astype(np.int64)  # whole numbers below 2^53
            keys.append(batch + np.flatnonzero(part))
            parts.append(part[part != 0])
        return pa.table({"at": np.concatenate(keys), "part": np.concatenate(parts)})

    salted = postings.where("g >= 0").select("batch", "g", "postings", F.pmod(F.xxhash64("batch"), F.lit(salts)).cast("int").alias("salt"))
    counts = F.array_sort(F.collect_list(F.struct("bucket", "s", "t"))).alias("counts")  # of one group's buckets
    here = both.groupBy(F.floor(F.col("bucket") / size).cast("int").alias("g")).agg(counts).select("g", "counts", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    parts = salted.groupBy("g", "salt").cogroup(here.groupBy("g", "salt")).applyInArrow(contribute, "at long, part long")
    known = postings.where("g = -1").select("batch", F.posexplode("docs").alias("pos", "doc")).select((F.col("batch") + F.col("pos")).alias("at"), F.lit(0).cast("long").alias("part"), "doc.*")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("row", "doc_id", "n_words", "n_features")]
    found = known.unionByName(parts.select("at", "part", *nothing)).groupBy("at").agg(F.sum("part").alias("weight"), *(F.max(c).alias(c) for c in ("row", "doc_id", "n_words", "n_features")))
    return found.select("row", "doc_id", "n_words", "n_features", "weight")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, row: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """row, doc_id, n_features, weight, score and rank of every row of docs; rank is null for rows that aren't drawn.

    Of the rows with least_words or more, percent % of highest score are drawn (rounded down); ties go to the smaller
    doc_id, null last, and rows equal in both to any order of their own. The noise comes from a hash of seed and
    doc_id (null: of the seed alone), so reruns draw the same. For the rest see weigh.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = weigh(docs, target, row, buckets).withColumn("score", F.col("weight") + noise)
    key = F.when(F.col("n_words") >= least_words, F.col("score"))
    order = [F.col("key").desc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keep(rows.withColumn("key", key)).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = keep(rows.withColumn("place", F.monotonically_increasing_id()))  # the range's number and the place in it
    part = F.shiftright("place", 33).alias("part")
    sizes = keep(rows.groupBy(part).agg(F.count("*").alias("n"), F.count("key").alias("fit")))
    drawn = percent * (sizes.agg(F.sum("fit")).first()[0] or 0) // 100
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.withColumn("part", part).join(sizes, "part").select("row", "doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The rows of docs that resample draws, with all their columns."""
    name = unused(docs, "row")
    numbered = keep(docs.withColumn(name, F.monotonically_increasing_id()))  # written, so that a row's number stays
    chosen = resample(numbered, target, row=name, **options).where("rank is not null").select(F.col("row").alias(name))
    return numbered.join(chosen, name).select(*docs.columns)
