"""Embedding near-dedup: an exact metric range join with pivots.

Vectors are scaled to length 1, where cosine >= c is distance <= r = sqrt(2 - 2c). A label is a cell; a cell of
more than CHUNK vectors is split by pivots drawn from it, and so are the parts, until all are small, so the
number of pivots grows with the data. A vector's home is the part of its nearest pivot p; it also visits the part
of pivot q unless the triangle inequality shows no partner there: a partner at home with q lies on q's side of the
plane between p and q, so the vector is at most r from that plane. Visitors are split like home vectors, so each
split is another chance to exclude them. Cells join independently, and each pair is counted at the home of its
other member.

- Equal vectors of a label are one class with a weight, compared once; they are known by two 64-bit hashes.
- Two members within r / 2 of their pivot link by the triangle inequality; this core of a part is counted, not
  compared, and isn't split, so a group of near copies costs time in proportion to its size. Of the others only
  those at most 1.5 r from the pivot are compared with the core.
- No task holds more than CHUNK home vectors and GUESTS visitors.

Where distances concentrate (directions at random in many dimensions) the bound prunes little, and an exact
join visits most cells: work then grows with the square of a label's size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ._session import keep, prepare
from .components import components

#: Vectors that a pivot stands for, and pivots that a cell is split by at most.
CELL, SPLIT = 1000, 64
#: Home vectors and visitors of one task, and vectors of one block that finds its cells.
CHUNK, GUESTS = 2048, 16_384
#: Slack of distances against rounding.
EPS = 1e-6

_ASSIGNED = "cell string, dim int, id long, w long, vec binary, home boolean, core boolean, near boolean"
_FOUND = "a long, b long, links long"


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of bytes of float32 or float64, scaled to length 1 in double precision; the largest component first, against overflow."""
    rows = [x.as_buffer() for x in column]
    kind = np.float64 if rows and len(rows[0]) == 8 * dim else np.float32
    raw = np.stack([np.frombuffer(x, kind) for x in rows]).astype(np.float64).reshape(-1, dim)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ y.T)))


def _assign(radius: float):
    """Vectors of a block and the pivots of their cell: for each vector its home among the parts, and those it visits."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        if not left.num_rows:
            return pa.table({"cell": pa.array([], pa.string()), "dim": pa.array([], pa.int32()), "id": pa.array([], pa.int64()), "w": pa.array([], pa.int64()), "vec": pa.array([], pa.binary()), **{c: pa.array([], pa.bool_()) for c in ("home", "core", "near")}})
        dim = left.column("dim")[0].as_py()
        right = right.sort_by("id")
        x, p = _matrix(left.column("vec"), dim), _matrix(right.column("vec"), dim)
        d, between = _distances(x, p), _distances(p, p)
        nearest, every = d.argmin(axis=1), np.arange(len(x))
        own, apart = d[every, nearest], between[nearest]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d**2 - own[:, None] ** 2) / (2 * apart)
        visit = (plane <= radius + EPS) | (apart <= EPS)
        visit[every, nearest] = True
        row, part = np.nonzero(visit)
        home = left.column("home").to_numpy(zero_copy_only=False)[row] & (part == nearest[row])
        take, away = pa.array(row), d[row, part]
        return pa.table(
            {
                "cell": pa.array([f"{cell}/{i}" for i in part.tolist()], pa.string()),
                "dim": left.column("dim").take(take),
                "id": left.column("id").take(take),
                "w": left.column("w").take(take),
                "vec": left.column("vec").take(take),
                "home": pa.array(home),
                "core": pa.array(home & (away <= radius / 2 - EPS)),
                "near": pa.array(away <= 1.5 * radius + EPS),
            }
        )

    return run


def _join_chunk(cosine: float):
    """Links of one chunk: of each vector with the chunk's home vectors; a forest of edges and weighted counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        core, part = key[1].as_py(), key[3].as_py()
        ids, w = table.column("id").to_numpy(), table.column("w").to_numpy()
        at_home, here = (table.column(c).to_numpy(zero_copy_only=False) for c in ("at_home", "here"))
        x = _matrix(table.column("vec"), table.column("dim")[0].as_py())
        homes = np.flatnonzero(at_home)
        # The home vectors of a cell that is no core are compared with each other too, where its first visitors are.
        guests = np.arange(len(ids)) if not core and part == 0 else np.flatnonzero(~at_home)
        links, up = np.zeros(len(ids), np.int64), np.arange(len(ids))
        edges: list[tuple[int, int]] = []

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for a in range(0, len(guests), 1024):
            g = guests[a : a + 1024]
            near = x[g] @ x[homes].T >= cosine
            near &= g[:, None] != homes[None, :]
            links[g] += near @ w[homes]
            if core:  # the core doesn't visit the rest of its own cell, so it is counted here
                links[homes] += (w[g] * here[g]) @ near
            for i in np.flatnonzero(near.any(axis=1)):
                partners = homes[near[i]]
                r = root(int(g[i]))
                for other in np.unique([root(int(q)) for q in partners]) if len(partners) < 64 else _roots(up, partners):
                    other = root(int(other))
                    if other != r:
                        edges.append((int(ids[g[i]]), int(ids[other])))
                        up[other] = r
        seen = np.flatnonzero(links)
        none = [None] * len(edges)
        return pa.table(
            {
                "a": pa.array([*ids[seen].tolist(), *(e[0] for e in edges)], pa.int64()),
                "b": pa.array([*[None] * len(seen), *(e[1] for e in edges)], pa.int64()),
                "links": pa.array([*links[seen].tolist(), *none], pa.int64()),
            }
        )

    return run


def _roots(up: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    out = up[nodes]
    while not np.array_equal(out, up[out]):
        out = up[out]
    return np.unique(out)


def near_duplicates(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors(vec_id, embedding, label int, ...).

    embedding is array<float> or array<double>. Rows link when their labels are equal and not null, their vectors
    have equal lengths and a cosine of at least `cosine` in double precision. A vector that is null, empty, zero, or
    holds null or non-finite components links with nothing. n_links counts other rows; component_id is the smallest
    vec_id reachable, null where no row reached has one. Rows with equal vec_id, a null one too, are vectors of their
    own. Ties, as several pivots at one distance, change no link. Extra columns are ignored; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    radius = math.sqrt(2 - 2 * cosine)
    kind = "array<double>" if vectors.schema["embedding"].dataType == ArrayType(DoubleType(), vectors.schema["embedding"].dataType.containsNull) else "array<float>"
    rows = keep(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.col("label").cast("int").alias("label")))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    known = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    hashed = sound.select("row", "label", *known)
    same = ["label", "h1", "h2"]
    classes = keep(hashed.groupBy(same).agg(F.min("row").alias("id"), F.count("*").alias("w")))
    members = hashed.join(classes, same).select("row", "id", "w")
    firsts = sound.join(classes.select(F.col("id").alias("row"), "w"), "row").select("label", F.col("row").alias("id"), "w", "embedding")
    cells = keep(_packed(firsts, kind).select(F.concat_ws("/", "label", "dim").alias("cell"), "dim", "id", "w", "vec", F.lit(True).alias("home")))
    by, joins, cores = ["cell", "block"], [], []
    while True:
        sizes = keep(cells.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests")).where("homes > 0"))
        joins.append(_dealt(cells.where("home"), cells.where("not home").withColumn("here", F.lit(False)), sizes.where(F.col("homes") <= CHUNK), False))
        large = sizes.where(F.col("homes") > CHUNK)
        if large.isEmpty():
            break
        large = keep(large.withColumn("pivots", F.least(F.lit(SPLIT), F.ceil(F.col("homes") / CELL) + 1)).withColumn("blocks", F.ceil((F.col("homes") + F.col("guests")) / CHUNK)))
        dealt = cells.join(large, "cell")
        # A few times the pivots needed, by hash; of these the first.
        lot = F.pmod(F.xxhash64("id", "cell"), F.lit(1 << 30))
        drawn = dealt.where("home").withColumn("lot", lot).where(F.col("lot") * F.col("homes") < (4 * F.col("pivots") + 40) * (1 << 30))
        rank = F.row_number().over(Window.partitionBy("cell").orderBy("lot", "id"))
        pivots = keep(drawn.withColumn("rank", rank).where(F.col("rank") <= F.col("pivots")).select("cell", "blocks", "id", "vec"))
        pivots = pivots.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "id", "vec")
        blocks = dealt.select("cell", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "dim", "id", "w", "vec", "home")
        assigned = keep(blocks.groupBy(by).cogroup(pivots.groupBy(by)).applyInArrow(_assign(radius), _ASSIGNED))
        core = assigned.where("core")
        about = keep(core.groupBy("cell").agg(F.count("*").alias("homes"), F.sum("w").alias("w_core"), F.min("id").alias("hub")))
        cores.append(core.select("cell", "id", "w").join(about, "cell"))
        # The rest of a core's own cell and vectors from elsewhere, where they can reach it.
        others = assigned.where("near and not core").withColumn("here", F.col("home"))
        reached = others.groupBy("cell").agg(F.count("*").alias("guests")).join(about, "cell")
        joins.append(_dealt(core, others, keep(reached.select("cell", "homes", "guests")), True))
        cells = assigned.where("not core").drop("core", "near")
    sent, in_core = joins[0], cores[0] if cores else None
    for other in joins[1:]:
        sent = sent.unionByName(other)
    for other in cores[1:]:
        in_core = in_core.unionByName(other)
    found = keep(sent.groupBy("cell", "core", "chunk", "part").applyInArrow(_join_chunk(cosine), _FOUND))
    counted = found.where("links is not null").select(F.col("a").alias("id"), "links")
    edges = found.where("b is not null").select("a", "b")
    if in_core is not None:
        counted = counted.unionByName(in_core.select("id", (F.col("w_core") - F.col("w")).alias("links")))
        edges = edges.unionByName(in_core.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    counted = keep(counted.groupBy("id").agg(F.sum("links").alias("links")))
    comps = components(edges).withColumnRenamed("node", "id")
    linked = members.join(counted, "id", "left").join(comps, "id", "left")
    linked = linked.select("row", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    all_rows = keep(rows.select("row", "vec_id").join(linked, "row", "left").select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component")))
    # Written, as adaptive execution splits a hot component only where both sides of the join come straight from a shuffle.
    smallest = keep(all_rows.groupBy("component").agg(F.min("vec_id").alias("component_id")))
    return all_rows.join(smallest, "component").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _dealt(homes: DataFrame, guests: DataFrame, sizes: DataFrame, core: bool) -> DataFrame:
    """Rows of the tasks that join cells of sizes(cell, homes, guests): each chunk of home vectors with each part of the guests."""
    chunks, parts = F.ceil(F.col("homes") / CHUNK), F.greatest(F.ceil(F.col("guests") / GUESTS), F.lit(1))
    sizes = sizes.select("cell", chunks.alias("chunks"), parts.alias("parts"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    columns = ["cell", "chunk", "part", "dim", "id", "w", "vec"]
    at_home = homes.join(sizes, "cell").withColumn("chunk", own("chunks", 0)).withColumn("part", every("parts"))
    visiting = guests.join(sizes, "cell").withColumn("part", own("parts", 1)).withColumn("chunk", every("chunks"))
    at_home = at_home.select(*columns, F.lit(True).alias("at_home"), F.lit(True).alias("here"))
    return at_home.unionByName(visiting.select(*columns, F.lit(False).alias("at_home"), "here")).withColumn("core", F.lit(core))


def _packed(classes: DataFrame, kind: str) -> DataFrame:
    """Classes with their vector as bytes of its numbers."""
    number = np.float64 if kind == "array<double>" else np.float32

    def run(batches):
        for batch in batches:
            vectors = batch.column(3)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(v) for v in vectors], pa.int32()), pa.array([np.asarray(v.values, number).tobytes() for v in vectors], pa.binary())],
                ["label", "id", "w", "dim", "vec"],
            )

    return classes.mapInArrow(run, "label int, id long, w long, dim int, vec binary")


#: DuckDB's twin of near_duplicates(embeddings, 0.93).
SQL = """
WITH RECURSIVE vec AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
  SELECT r, label, list_transform(e, lambda x: x / list_aggregate(list_transform(e, lambda y: abs(y)), 'max')) AS e FROM vec
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT x.r AS a, y.r AS b FROM sound x JOIN sound y ON x.label = y.label AND x.r <> y.r AND len(x.e) = len(y.e)
  WHERE CASE WHEN len(x.e) = len(y.e) THEN list_cosine_similarity(x.e, y.e) ELSE 0 END >= 0.93
), reach AS (
  SELECT r, r AS other FROM vec UNION SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.other
), links AS (
  SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(any_value(n), 0) AS n_links, min(o.vec_id) AS component_id, v.vec_id IS NOT DISTINCT FROM min(o.vec_id) AS kept
FROM vec v LEFT JOIN links ON links.a = v.r JOIN reach ON reach.r = v.r JOIN vec o ON o.r = reach.other
GROUP BY v.r, v.vec_id
"""
