"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when their sets of distinct k-word shingles have a Jaccard similarity of at least
`percent` / 100. A partner of a document of n shingles must share at least T = ceil(n * percent / 100)
of them, so the search is for the documents that occur on T of its n inverted lists.

1. Shingles are hashed and dealt to buckets, packed as binary blobs. A bucket finds the shingles that
   occur in two or more documents, with their document frequency, and sends those alone back to the
   block of documents they came from. A document whose shared shingles are fewer than T links with
   nothing and is done.
2. Documents of equal sets are one class, searched once.
3. Of each class, the lists beyond the T - 1 longest are its short ones: any partner is on at least
   one of them. Classes that meet on short lists fall into one cell (connected components over one
   edge per list entry, not per pair).
4. Each cell runs DivideSkip: it heap-merges the short lists of each class and binary-probes the long
   ones for what the merge found. Classes already connected with the query are not probed again, since
   the result is connectivity; every pair of classes in different components is.
   A cell beyond CELL_SHINGLES is dealt into blocks. A class then visits the blocks where a short list of
   its has members that nothing connects with it yet; see `_large_cells` for how that stays exact.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._session import buckets, keep, prepare, unused
from .components import components

#: Stored bytes of input for each bucket of shingles.
BUCKET_BYTES = 8 << 20
#: Shingles of one task of step 4.
CELL_SHINGLES = 400_000
#: Shingles of one task that searches small cells, and such tasks at most.
TASK_SHINGLES, MOST_TASKS = 400_000, 50_000
#: Ids that the heap merge takes at once.
WINDOW = 256
#: Members of each component that stand for it where the blocks of a large cell meet first.
STANDINS = 8

_BLOB = "bucket long, block long, kind string, payload binary"
_SETS = "doc_id long, n long, sig_a long, sig_b long, n_shared long, vals binary, dfs binary"


def _need(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _shingle_blobs(n_buckets: int, k: int):
    """Map side of step 1: for each block of documents a blob for each bucket, and one with what the documents are.

    A blob is the document's place in the block (16 bits) and the hash within the bucket (32 bits) of each shingle,
    so it costs 6 bytes a shingle at most, and 2^32 hashes a bucket of constant size at any scale.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, step = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal step, size
            block = (part << 32) + step
            ids = np.array([d or 0 for d, _ in held], np.int64)
            known = np.array([d is not None for d, _ in held], np.int64)
            lengths = np.array([len(s) for _, s in held], np.int64)
            sums = np.array([[s.sum(dtype=np.uint64), _text.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)] for _, s in held], np.uint64).reshape(-1, 2)
            values = np.concatenate([s for _, s in held]) if held else np.zeros(0, np.uint64)
            at = np.repeat(np.arange(len(held), dtype=np.uint16), lengths)
            held.clear()
            low = values.astype(np.uint32)
            values >>= np.uint64(32)
            values %= np.uint64(n_buckets)
            where = values.astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32)
            del values
            order = np.argsort(where, kind="stable")
            low, at, where = low[order], at[order], where[order]
            del order
            cuts = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1, [len(where)]]) if len(where) else np.zeros(1, np.int64)
            present = where[cuts[:-1]]
            rows: list[tuple[int, bytes]] = [(int(b), at[lo:hi].tobytes() + low[lo:hi].tobytes()) for b, lo, hi in zip(present, cuts[:-1], cuts[1:], strict=True)]
            about = ids.tobytes() + known.tobytes() + lengths.tobytes() + sums[:, 0].tobytes() + sums[:, 1].tobytes()
            rows.append((-1 - block % n_buckets, about))
            out = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array(["blob"] * (len(rows) - 1) + ["about"]), pa.array([r[1] for r in rows], pa.binary())],
                ["bucket", "block", "kind", "payload"],
            )
            step, size = step + 1, 0
            return out

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), _text.plain(batch.column(1))
            for start, stop in _text.steps(texts):
                for i, own in zip(ids[start:stop], _text.shingle_sets(texts.slice(start, stop - start), k), strict=True):
                    held.append((i, own))
                    size += len(own)
                    if size >= 1_500_000 or len(held) == 1 << 16:
                        yield flush()
        if held:
            yield flush()

    return run


def _shared_in_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """Reduce side of step 1: keep of each blob the values that two or more documents have."""
    if key[0].as_py() < 0:
        return table.select(["bucket", "block", "kind", "payload"])
    docs, values = [], []
    for payload in table.column("payload"):
        raw = payload.as_buffer()
        n = len(raw) // 6
        docs.append(np.frombuffer(raw, np.uint16, n))
        values.append(np.frombuffer(raw, np.uint32, n, 2 * n))
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    run = np.cumsum(new) - 1
    freq = np.bincount(run)[run]
    df = np.empty(len(every), np.uint32)
    df[order] = freq
    payloads, kept, at = [], [], 0
    for i, (d, v) in enumerate(zip(docs, values, strict=True)):
        own = df[at : at + len(v)]
        at += len(v)
        good = own > 1
        if good.any():
            kept.append(i)
            payloads.append(d[good].tobytes() + v[good].tobytes() + own[good].tobytes())
    rows = table.select(["bucket", "block", "kind"]).take(pa.array(kept, pa.int64()))
    return rows.append_column("payload", pa.array(payloads, pa.binary()))


def _documents_of_block(percent: int):
    """Put the shared shingles of a block's documents together again."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        docs_of, values_of, df_of = [], [], []
        ids = known = n = sig_a = sig_b = np.zeros(0, np.int64)
        for bucket, kind, payload in zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(), table.column("payload"), strict=True):
            raw = payload.as_buffer()
            if kind == "about":
                ids, known, n, sig_a, sig_b = np.frombuffer(raw, np.int64).reshape(5, -1)
                continue
            size = len(raw) // 10
            docs_of.append(np.frombuffer(raw, np.uint16, size).astype(np.int64))
            values_of.append(np.uint64(bucket) << np.uint64(32) | np.frombuffer(raw, np.uint32, size, 2 * size).astype(np.uint64))
            df_of.append(np.frombuffer(raw, np.uint32, size, 6 * size))
        docs = np.concatenate(docs_of) if docs_of else np.zeros(0, np.int64)
        values = np.concatenate(values_of) if docs_of else np.zeros(0, np.uint64)
        dfs = np.concatenate(df_of) if docs_of else np.zeros(0, np.uint32)
        order = np.lexsort((values, docs))
        docs, values, dfs = docs[order], values[order], dfs[order]
        cuts = np.searchsorted(docs, np.arange(len(ids) + 1))
        shared = np.diff(cuts)
        linked = [shared[i] > 0 and shared[i] >= _need(int(n[i]), percent) for i in range(len(ids))]
        cut = lambda a: pa.array([a[cuts[i] : cuts[i + 1]].tobytes() if linked[i] else None for i in range(len(ids))], pa.binary())
        return pa.table([pa.array(ids, mask=known == 0), pa.array(n), pa.array(sig_a), pa.array(sig_b), pa.array(shared, pa.int64()), cut(values), cut(dfs)], ["doc_id", "n", "sig_a", "sig_b", "n_shared", "vals", "dfs"])

    return run


def _short_lists(percent: int):
    """Step 3's list entries of each row: the shingles of its n - T + 1 shortest lists that others are on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for n, vals, dfs in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                vals, dfs = np.frombuffer(vals.as_buffer(), np.uint64), np.frombuffer(dfs.as_buffer(), np.uint32)
                short = np.lexsort((vals, dfs))[: len(vals) - _need(n, percent) + 1]
                lists.append(vals[short].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64()))], ["row", "lists"])

    return run


def heap_merge(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids on at least `least` of the sorted lists, and on how many each is, by a heap of the lists' heads.

    The lists whose heads lie within WINDOW ids of the smallest are popped together and their ids there counted.
    Where these are fewer than `least`, no id of theirs can be on enough lists before the head that makes up the
    number, so they skip to it.
    """
    heads = [(int(own[0]), i) for i, own in enumerate(lists) if len(own)]
    heapq.heapify(heads)
    at = [0] * len(lists)
    found, counts = [], []
    while len(heads) >= least:
        top, popped = heads[0][0], []
        target = top + WINDOW
        while heads and heads[0][0] < target:
            popped.append(heapq.heappop(heads)[1])
        enough = len(popped) >= least
        while not enough and len(popped) < least - 1:
            popped.append(heapq.heappop(heads)[1])
        if not enough:
            target = heads[0][0]
        here = []
        for i in popped:
            own, before = lists[i], at[i]
            at[i] = before + int(np.searchsorted(own[before:], target))
            here.append(own[before : at[i]])
            if at[i] < len(own):
                heapq.heappush(heads, (int(own[at[i]]), i))
        if enough:
            n = np.bincount(np.concatenate(here) - top)
            hits = np.flatnonzero(n >= least)
            found.append(hits + top)
            counts.append(n[hits])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found), np.concatenate(counts)) if found else (none, none)


def links(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int, known: np.ndarray | None = None, guest: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of links over distinct sets: pairs of ids, enough for the same components as all links.

    Sets hold shared shingles; sizes are those of the whole sets. Sets are queried in order of size, each
    against the smaller ones, so that T = ceil(percent * size / 100) lists must hold a partner. Sets of one
    `known` component count as connected; two sets marked in `guest` aren't compared.
    """
    order = np.lexsort((ids, sizes))
    ids, sizes, sets = ids[order], sizes[order], [sets[i] for i in order]
    guest = np.zeros(len(sets), bool) if guest is None else guest[order]
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    entry_order = np.argsort(inverse, kind="stable")
    entries, cuts = owner[entry_order], np.searchsorted(inverse[entry_order], np.arange(len(values) + 1))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    comp = np.arange(len(sets)) if known is None else np.unique(known[order], return_inverse=True)[1]
    found: list[tuple[int, int]] = []
    for q in range(1, len(sets)):
        mine = inverse[bounds[q] : bounds[q + 1]]
        need = _need(int(sizes[q]), percent)
        least_size = int(np.searchsorted(sizes[:q], need))  # a smaller set can't hold T of them
        if least_size >= q or len(mine) < need:
            continue
        ranked = mine[np.argsort(cuts[mine + 1] - cuts[mine], kind="stable")]
        n_long = min(need - 1, len(mine))
        longest = int((cuts[ranked[-1] + 1] - cuts[ranked[-1]])) if len(ranked) else 1
        n_long = min(n_long, max(0, int(need / (0.01 * math.log2(longest + 1) + 1))))
        short, long_lists = ranked[: len(ranked) - n_long], ranked[len(ranked) - n_long :]
        least = need - n_long

        def overlap(c: int) -> int:
            own = inverse[bounds[c] : bounds[c + 1]]
            at = np.searchsorted(own, mine)
            at[at == len(own)] = 0
            return int((own[at] == mine).sum()) if len(own) else 0

        def linked(c: int, shared: int) -> bool:
            return 100 * shared >= percent * (int(sizes[q]) + int(sizes[c]) - shared)

        def unite(c: int) -> None:
            found.append((int(ids[q]), int(ids[c])))
            comp[comp == comp[c]] = comp[q]

        # First the head of a list each: in a group of near copies that connects q at once.
        heads: dict[int, int] = {}
        for s in ranked[: len(ranked) - need + 1]:
            lo = cuts[s] + int(np.searchsorted(entries[cuts[s] : cuts[s + 1]], least_size))
            if lo < cuts[s + 1] and entries[lo] < q and not (guest[q] and guest[entries[lo]]):
                heads[int(entries[lo])] = heads.get(int(entries[lo]), 0) + 1
        for c in sorted(heads, key=lambda c: -heads[c])[:4]:
            if comp[c] != comp[q] and linked(c, overlap(c)):
                unite(c)
        # Then all that isn't connected with q: merge the short lists, probe the long ones.
        lists = []
        for s in short:
            own = entries[cuts[s] : cuts[s + 1]]
            own = own[np.searchsorted(own, least_size) : np.searchsorted(own, q)]
            own = own[comp[own] != comp[q]]
            if guest[q]:
                own = own[~guest[own]]
            if len(own):
                lists.append(own)
        candidates, shared = heap_merge(lists, least)
        wanted = -(-percent * (sizes[q] + sizes[candidates]) // (100 + percent))
        for left in range(n_long, 0, -1):
            alive = shared + left >= wanted
            if not alive.all():
                candidates, shared, wanted = candidates[alive], shared[alive], wanted[alive]
            if not len(candidates):
                break
            own = entries[cuts[long_lists[left - 1]] : cuts[long_lists[left - 1] + 1]]
            at = np.searchsorted(own, candidates)
            at[at == len(own)] = 0
            shared = shared + (own[at] == candidates)
        for c, both in zip(candidates.tolist(), shared.tolist(), strict=True):
            if comp[c] != comp[q] and linked(c, both):
                unite(c)
    return found


def _links_of_group(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("row").to_numpy()
        ids, first = np.unique(ids, return_index=True)
        sets = [np.frombuffer(table.column("vals")[int(i)].as_buffer(), np.uint64) for i in first]
        known = table.column("component").to_numpy()[first] if "component" in table.column_names else None
        guest = table.column("guest").to_numpy(zero_copy_only=False)[first] if known is not None else None
        pairs = links(ids, table.column("n").to_numpy()[first], sets, percent, known, guest) if len(ids) > 1 else []
        return pa.table([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    return run


def _large_cells(members: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Links of cells beyond CELL_SHINGLES, exact up to connectivity, no task above a few times that size.

    The cell's classes are dealt into blocks by hash, and each block is searched. Stand-ins of each component
    meet next, which joins the blocks' parts of one group. A linked pair that isn't connected by then has a
    short list in common and lies in two blocks. Of each short list one component, that of most entries,
    stays where it is; a class of any other visits the blocks where the list has members of other components
    and of a size that can link. Visitors meet a block in chunks, against its own classes only. So a large
    linked group doesn't move, and classes that merely share passages visit as many blocks as these have.
    """
    run, out = _links_of_group(percent), "a long, b long"
    size = members.groupBy("cell").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("blocks"))
    members = keep(members.join(size, "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))))
    first = keep(members.groupBy("cell", "block").applyInArrow(run, out))

    def labelled(edges: DataFrame) -> DataFrame:
        comp = components(edges)
        return members.join(comp.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))

    rank = F.row_number().over(Window.partitionBy("component", "block").orderBy(F.xxhash64("row")))
    stand = keep(labelled(first).withColumn("rank", rank).where(F.col("rank") <= STANDINS).drop("component", "rank"))
    groups = stand.groupBy("cell").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("chunks"))
    second = keep(first.unionByName(stand.join(groups, "cell").groupBy("cell", F.pmod(F.xxhash64("row"), F.col("chunks"))).applyInArrow(run, out)))
    part = keep(labelled(second))

    at = keep(entries.join(part.select("row", "cell", "block", "component", "n"), "row"))
    counts = at.groupBy("list", "component").agg(F.count("*").alias("m"))
    top = counts.groupBy("list").agg(F.max_by("component", F.struct("m", F.negative("component"))).alias("top"), F.count("*").alias("parts"))
    loose = keep(at.join(keep(top.where("parts > 1").drop("parts")), "list"))
    homes = loose.groupBy("list", F.col("block").alias("to")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    able = (F.col("most") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("least") * percent)
    other = (F.col("low") != F.col("component")) | (F.col("high") != F.col("component"))
    visits = loose.where("component <> top").join(keep(homes), "list").where((F.col("to") != F.col("block")) & other & able)
    visits = keep(visits.select("row", "cell", F.col("to").alias("block"), "n").distinct())
    chunks = keep(visits.groupBy("cell", "block").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("chunks")))
    columns = ["cell", "block", "chunk", "row", "n", "vals", "component", "guest"]
    guests = visits.join(chunks, ["cell", "block"]).withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(7)), F.col("chunks")))
    guests = guests.join(part.select("row", "vals", "component"), "row").withColumn("guest", F.lit(True)).select(columns)
    inside = part.join(chunks, ["cell", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    third = inside.withColumn("guest", F.lit(False)).select(columns).unionByName(guests).groupBy("cell", "block", "chunk").applyInArrow(run, out)
    return second.unionByName(third)


def _row_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(row, doc_id, n_shingles, component) of every row of docs(doc_id long, text string); row numbers the result."""
    spark = docs.sparkSession
    prepare(spark)
    n_buckets = buckets(docs, BUCKET_BYTES, 4)
    blobs = docs.mapInArrow(_shingle_blobs(n_buckets, k), _BLOB)
    shared = blobs.groupBy("bucket").applyInArrow(_shared_in_bucket, _BLOB)
    sets = shared.groupBy("block").applyInArrow(_documents_of_block(percent), _SETS)
    sets = keep(sets.withColumn("row", F.monotonically_increasing_id()))  # written, so it stays
    signature = ["n", "sig_a", "sig_b"]
    able = sets.where("vals is not null")
    classes = keep(able.groupBy(signature).agg(F.min("row").alias("first")))
    # Of each class one row's sets are searched. Rows are looked up by number, so a large group of copies is no hot
    # key, and the sets themselves move once, to their cells.
    firsts = classes.select(F.col("first").alias("row"))
    short = able.select("row", "n", "vals", "dfs").mapInArrow(_short_lists(percent), "row long, lists array<long>")
    entries = keep(short.join(firsts, "row", "left_semi").select("row", F.explode("lists").alias("list")))
    heads = keep(entries.groupBy("list").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a < b").select("list", "a"))
    cells = components(entries.join(heads, "list").select("a", F.col("row").alias("b"))).withColumnRenamed("node", "row")
    members = keep(able.select("row", "n", "vals").join(cells.hint("merge"), "row").select(F.col("component").alias("cell"), "row", "n", "vals"))
    size = keep(members.groupBy("cell").agg(F.sum("n").alias("total")))
    small = size.where(F.col("total") <= CELL_SHINGLES)
    # By its shingles, as adaptive execution knows bytes only, of which few make much work.
    total = small.agg(F.sum("total")).first()[0] or 0
    tasks = min(max(8, math.ceil(total / TASK_SHINGLES)), MOST_TASKS)
    found = members.join(small.select("cell"), "cell").repartition(tasks, "cell").groupBy("cell").applyInArrow(_links_of_group(percent), "a long, b long")
    large = size.where(F.col("total") > CELL_SHINGLES).select("cell")
    if not large.isEmpty():
        found = found.unionByName(_large_cells(members.join(large, "cell"), entries, percent))
    joined = components(found).withColumnRenamed("node", "first")
    copies = able.select("row", *signature).join(classes, signature).select("row", "first")
    of_row = copies.join(joined, "first", "left").select("row", F.coalesce("component", "first").alias("component"))
    return keep(sets.select("row", "doc_id", F.col("n").alias("n_shingles")).join(of_row, "row", "left").withColumn("component", F.coalesce("component", "row")))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id long, text string, ...).

    Links are those of the module's head; component_id is the smallest doc_id reachable by them.
    Null or empty text, or one of white space only: an empty set, linked with nothing. Very long texts count whole.
    Rows of equal texts link, and so do pairs exactly at the threshold. Rows with equal doc_id are documents of
    their own; one with a null doc_id is too, and its component_id is null where no linked row has an id. Extra
    columns are ignored; an empty table gives an empty result.
    """
    every = _row_components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), k, percent)
    # Written, as adaptive execution splits a hot component only where both sides of the join come straight from a shuffle.
    smallest = keep(every.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return every.join(smallest, "component").select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """One row of docs for each component of jaccard_components, with all its columns: that of the smallest doc_id.

    A null doc_id comes after all others; of rows with equal doc_id in a component the first stays. Rows without
    words link with nothing, so they stay. Other columns stay, whatever their names; an empty table gives an empty
    result.
    """
    row = unused(docs, "row")
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()))  # written, so a row's number stays
    rows = numbered.select(F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
    component = _row_components(rows, k, percent).select(F.col("doc_id").alias(row), "component")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"))
    best = numbered.select(row, rank.alias("rank")).join(component, row).groupBy("component").agg(F.min("rank").alias("rank"))
    return numbered.join(best.select(F.col("rank.row").alias(row)), row, "left_semi").select(docs.columns)


#: DuckDB's twin of jaccard_components(documents).
SQL = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT r, s FROM (
    SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                          ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM doc)
), size AS (
  SELECT r, count(*) AS n FROM shingle GROUP BY r
), link AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS m FROM shingle x JOIN shingle y ON x.s = y.s AND x.r <> y.r GROUP BY ALL)
  JOIN size p ON p.r = a JOIN size q ON q.r = b WHERE 100 * m >= 75 * (p.n + q.n - m)
), reach AS (
  SELECT r, r AS other FROM doc UNION SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM doc d LEFT JOIN size USING (r) JOIN reach ON reach.r = d.r JOIN doc o ON o.r = reach.other
GROUP BY d.r, d.doc_id
"""
