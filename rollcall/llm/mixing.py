"""Mixing sources to target weights.

Each source's documents, in a pseudorandom order, are one run of words cut into blocks of fixed length.
Output shards draw how many blocks they take of each source from a multinomial over what the sources
still owe; slot t of a source is block perm(t mod n) of its epoch t div n, with a permutation for each
source and epoch computed index by index. Documents and draws meet by block index. As targets stop at
`most` times a source's size, no block is drawn in more than `most` epochs.

A hot source is dealt into groups by hash, and blocks are numbered group by group, so no sort or running
sum ever holds a whole source.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import _text
from ._session import keep, prepare, unused

#: Weights by the sources' rank in code point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MOST = 2
BLOCK_WORDS = 256
#: Words of an output shard. The driver holds one count for each shard and source.
SHARD_WORDS = 64_000_000
#: Documents of one group of a source, about.
GROUP_DOCS = 2_000
#: Rows of a small table (sources, groups) that is broadcast; beyond, joins shuffle.
SMALL_ROWS = 10_000
SEED = 20240229


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, percent: int = TOTAL_PERCENT, most: int = MOST) -> dict[str | None, Fraction]:
    """Each source's target: its weight's share of percent % of all words, at most `most` times its size.

    What is above is shared anew by weight among the others, until none is above.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, found, active = dict(order), {}, [s for s, _ in order]
    rest = Fraction(percent * sum(size.values()), 100)
    while active:
        unit = rest / sum(weight[s] for s in active)
        above = [s for s in active if unit * weight[s] > most * size[s]]
        for s in above or active:
            found[s] = Fraction(most * size[s]) if above else unit * weight[s]
        rest -= sum(found[s] for s in above)
        active = [s for s in active if s not in found] if above else []
    return found


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), index by index: a Feistel network, walked until inside the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _text.mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(key % 2**64))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_text.mix(right ^ k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_counts(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard (shards x sources): multinomial draws over what is still owed, all owed in the end."""
    rng = np.random.Generator(np.random.PCG64(seed))
    owed = np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for r in range(shards):
        due = -(-int(owed.sum()) // (shards - r))
        while due:
            drawn = np.minimum(rng.multinomial(due, owed / owed.sum()), owed)
            out[r] += drawn
            owed -= drawn
            due -= int(drawn.sum())
    return out


def _sizes(docs: DataFrame, row: str) -> DataFrame:
    """row, key, doc_id, source and size in words of every row; key is a hash of what the row holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _text.plain(batch.column(4))
            counts = [_text.Words(texts.slice(a, b - a)).counts for a, b in _text.steps(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(np.concatenate(counts) if counts else [], pa.int64())], ["row", "key", "doc_id", "source", "size"])

    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")]
    rows = docs.select(F.col(row).alias("row"), F.xxhash64(*own).alias("key"), *own)
    return rows.mapInArrow(run, "row long, key long, doc_id long, source string, size long")


class Mix:
    """A mix of docs(doc_id, text, source, ...), drawn once; `report` and `documents` read it.

    Null and empty texts have no words and are never taken; a null source is a source of its own, the last; a very
    long text is cut into blocks like any other. Every row counts and is drawn on its own, also rows that repeat
    another in all columns or have its doc_id, or a null one. The order of a source's documents follows a hash of
    what they hold, so reruns agree. Extra columns are ignored by report and kept by documents, whatever their
    names; an empty table gives empty results. Without texts, the table isn't written and only report works.
    """

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = TOTAL_PERCENT, most: int = MOST, block_words: int = BLOCK_WORDS, seed: int = SEED, texts: bool = True):
        spark = docs.sparkSession
        prepare(spark)
        self.columns, self.row = docs.columns, unused(docs, "row")
        self.numbered = docs.withColumn(self.row, F.monotonically_increasing_id())
        if texts:
            self.numbered = keep(self.numbered)  # written, so that a row's number stays
        self.rows = keep(_sizes(self.numbered, self.row))
        totals = self.rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        totals = sorted(totals.collect(), key=lambda r: (r.source is None, r.source or ""))
        goal = targets([(r.source, r.words) for r in totals], weights, percent, most)
        self.sources = spark.createDataFrame(
            [(r.source, i, r.words, -(-r.n // GROUP_DOCS), float(goal[r.source])) for i, r in enumerate(totals)],
            "source string, source_at int, source_size long, groups long, target double",
        )
        self.small = F.broadcast if len(totals) <= SMALL_ROWS else lambda df: df
        group = F.pmod(F.xxhash64("key", F.lit(seed)), F.col("groups")).alias("group")
        dealt = self.rows.join(self.small(self.sources), self.rows["source"].eqNullSafe(self.sources["source"])).select("row", "key", "source_at", group, "size")
        run = Window.partitionBy("source_at", "group").orderBy(F.xxhash64("key", F.lit(seed + 1)), "key", "row")
        placed = keep(dealt.where("size > 0").withColumn("end", F.sum("size").over(run)).withColumn("begin", F.col("end") - F.col("size")))
        by_group = placed.groupBy("source_at", "group").agg(F.ceil(F.max("end") / block_words).alias("blocks"))
        before = Window.partitionBy("source_at").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
        by_group = keep(by_group.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0))))
        n_blocks = {r.source_at: r.n for r in by_group.groupBy("source_at").agg(F.sum("blocks").alias("n")).collect()}
        slots = [round(goal[r.source] * n_blocks.get(i, 0) / r.words) if r.words else 0 for i, r in enumerate(totals)]
        words = float(sum(goal.values()))
        counts = shard_counts(slots, max(1, -(-int(words) // SHARD_WORDS)), seed)
        firsts = np.cumsum(counts, axis=0) - counts
        plan = [(i, shard, int(firsts[shard, i]), int(counts[shard, i]), n_blocks[i]) for shard in range(len(counts)) for i in range(len(slots)) if counts[shard, i]]

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for source_at, shard, first, count, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for at in range(first, first + count, 1 << 18):
                        t = np.arange(at, min(at + (1 << 18), first + count))
                        epoch, block = t // n, np.empty(len(t), np.int64)
                        for e in np.unique(epoch):
                            block[epoch == e] = permute(t[epoch == e] % n, n, seed * 1_000_003 + source_at * 1009 + int(e))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), source_at, np.int32)), pa.array(block), pa.array(epoch), pa.array(np.full(len(t), shard, np.int64))], ["source_at", "at", "epoch", "shard"])

        plan = spark.createDataFrame(plan, "source_at int, shard long, first long, count long, n long").repartition(max(1, len(plan) // 4))
        draws = plan.mapInArrow(draw, "source_at int, at long, epoch long, shard long")
        span = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))
        pieces = placed.join(F.broadcast(by_group) if by_group.count() <= SMALL_ROWS else by_group, ["source_at", "group"])
        pieces = pieces.select("row", "source_at", "first", "begin", "end", F.explode(span).alias("k")).select(
            "row",
            "source_at",
            (F.col("first") + F.col("k")).alias("at"),
            (F.greatest(F.col("k") * block_words, "begin") - F.col("begin")).alias("from_word"),
            (F.least((F.col("k") + 1) * block_words, "end") - F.col("begin")).alias("to_word"),
        )
        #: Word ranges taken of each row, by epoch.
        self.taken = pieces.join(draws.hint("merge"), ["source_at", "at"])  # no statistics tell how large it is

    def report(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every row; taken counts words as often as they are drawn."""
        taken = self.taken.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
        rows = self.rows.join(self.small(self.sources.withColumnRenamed("source", "named")), self.rows["source"].eqNullSafe(F.col("named")))
        return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def documents(self) -> DataFrame:
        """The mix as rows of docs: one a document and epoch with any block drawn, its text the words drawn.

        A text drawn whole stays as it is; of others, runs of words drawn keep their white space inside, and
        runs that don't touch are joined by a line end.
        """
        at, width = self.columns.index("text"), len(self.columns)
        row, spans_at = self.row, unused(self.numbered, "spans")
        spans = self.taken.groupBy("row", "epoch").agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias(spans_at))
        drawn = self.numbered.join(spans.select(F.col("row").alias(row), spans_at), row).select(*[self.numbered[c] for c in self.columns], spans_at)
        schema = StructType(drawn.schema.fields[:width])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = _text.plain(batch.column(at))
                out = []
                for text, spans in zip(texts, batch.column(width), strict=True):
                    words = _text.Words(pa.array([text.as_py()], texts.type))
                    raw, runs = text.as_buffer().to_pybytes(), []
                    for s in spans.as_py():
                        if runs and runs[-1][1] == s["from_word"]:
                            runs[-1][1] = s["to_word"]
                        else:
                            runs.append([s["from_word"], s["to_word"]])
                    if runs == [[0, len(words)]]:
                        out.append(raw)
                    else:
                        out.append(b"\n".join(raw[words.starts[a] : words.ends[b - 1]] for a, b in runs))
                columns = [*batch.columns[:width]]
                columns[at] = pa.array([o.decode() for o in out], batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

        return drawn.mapInArrow(cut, schema)
