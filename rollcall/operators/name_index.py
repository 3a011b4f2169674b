"""An index for approximate substrings: names by the three characters from each place on, and a search that verifies few.

A query with at most e edits, cut into e + 1 pieces, leaves one piece unchanged: a near name holds it. So the names
that hold any piece are all that need a distance. Pieces are cut where the index says they are rare. A search for
the k nearest tries 0, 1, 2, 4, .. edits and stops once k rows lie within them, as every other row is farther.

Postings are stored sorted by gram, so a lookup reads the row groups of its grams only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.similarity import substring_score
from ..session import importable, stored

#: Characters of a gram. Names are padded, so a shorter piece is the beginning of some gram.
SIZE = 3
_PAD = "\0" * (SIZE - 1)


def _lowered(column: Column) -> Column:
    return F.lower(column)


def _postings(names: DataFrame) -> DataFrame:
    """(gram, low, name): each gram of a name once."""
    padded = F.concat("low", F.lit(_PAD))
    places = F.sequence(F.lit(1), F.length("low"))
    own = F.array_distinct(F.transform(places, lambda i: F.substring(padded, i, F.lit(SIZE))))
    return names.where("low <> ''").select(F.explode(own).alias("gram"), "low", "name")


def _frequencies(postings: DataFrame) -> DataFrame:
    """(prefix, n): postings whose gram begins so, for beginnings of 1 to SIZE characters."""
    beginnings = F.array(*[F.substring("gram", 1, i) for i in range(1, SIZE + 1)])
    counts = postings.groupBy("gram").agg(F.count("*").alias("n"))
    return counts.select(F.explode(F.array_distinct(beginnings)).alias("prefix"), "n").groupBy("prefix").agg(F.sum("n").alias("n"))


def cut_pieces(query: str, pieces: int, frequency: dict[str, int]) -> tuple[int, list[str]]:
    """query in so many parts, of least sum of frequencies; a part costs what its rarest gram does. And that sum."""
    m = len(query)
    cost = [[0] * (m + 1) for _ in range(m)]
    for i in range(m):
        for j in range(i + 1, m + 1):
            gram = query[max(i, j - SIZE) : j]
            own = frequency.get(gram, 0)
            cost[i][j] = min(cost[i][j - 1], own) if j - i > SIZE else own
    best: list[tuple[int, list[int]]] = [(cost[0][j], [j]) if j else (0, []) for j in range(m + 1)]
    for done in range(1, pieces):
        best = [min((best[k][0] + cost[k][j], [*best[k][1], j]) for k in range(done, j)) if j > done else (0, []) for j in range(m + 1)]
    total, ends = best[m]
    return total, [query[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def rarest(piece: str, frequency: dict[str, int]) -> str:
    return min((piece[i : i + SIZE] for i in range(max(1, len(piece) - SIZE + 1))), key=lambda g: frequency.get(g, 0))


@dataclass
class NameIndex:
    """Stored names (name, low), postings (gram, low, name) and frequencies (prefix, n)."""

    names: DataFrame
    postings: DataFrame
    frequencies: DataFrame

    @staticmethod
    def _tables(names: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        own = names.select(F.col(column).alias("name")).where("name is not null").distinct().withColumn("low", _lowered(F.col("name")))
        return own, _postings(own).repartitionByRange("gram", "low").sortWithinPartitions("gram", "low")

    @classmethod
    def build(cls, names: DataFrame, column: str) -> NameIndex:
        """Of the distinct values of a column, in the session's shared folder."""
        own, postings = cls._tables(names, column)
        own = stored(own)
        postings = stored(_postings(own).repartitionByRange("gram", "low").sortWithinPartitions("gram", "low"))
        return cls(own, postings, stored(_frequencies(postings)))

    @classmethod
    def write(cls, names: DataFrame, column: str, folder: str) -> None:
        own, _ = cls._tables(names, column)
        own.write.mode("overwrite").parquet(f"{folder}/names")
        own = names.sparkSession.read.parquet(f"{folder}/names")
        _postings(own).repartitionByRange("gram", "low").sortWithinPartitions("gram", "low").write.mode("overwrite").parquet(f"{folder}/postings")
        _frequencies(names.sparkSession.read.parquet(f"{folder}/postings")).write.mode("overwrite").parquet(f"{folder}/frequencies")

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> NameIndex:
        return cls(*(spark.read.parquet(f"{folder}/{t}") for t in ("names", "postings", "frequencies")))

    def _known(self, query: str) -> dict[str, int]:
        """How often each gram of the query, and each shorter piece, begins a gram of a name."""
        wanted = sorted({query[i : i + n] for n in range(1, SIZE + 1) for i in range(len(query) - n + 1)})
        return {r.prefix: r.n for r in self.frequencies.where(F.col("prefix").isin(wanted)).collect()}

    def candidates(self, query: str, edits: int) -> DataFrame:
        """(name): a superset of the names within so many edits of a part of theirs; all names where none can be left out."""
        own = query.lower()
        if edits >= len(own):
            return self.names.select("name")
        known = self._known(own)
        total, pieces = cut_pieces(own, edits + 1, known)
        if any("\0" in p for p in pieces) or total >= sum(known.get(c, 0) for c in set(own)):
            return self.names.select("name")
        held = F.lit(False)
        for piece in pieces:
            gram = rarest(piece, known)
            if known.get(gram):
                at = F.col("gram") == gram if len(gram) == SIZE else F.col("gram").startswith(gram)
                held = held | (at & F.col("low").contains(piece) if len(piece) > SIZE else at)
        return self.postings.where(held).select("name").distinct()

    def near(self, query: str, edits: int) -> DataFrame:
        """(name, score) of all names within so many edits."""
        importable(self.names.sparkSession)
        own = self.candidates(query, edits)
        # Nondeterministic to the optimizer, which would evaluate it in the filter and again above.
        scored = own.withColumn("score", substring_score.asNondeterministic()(F.lit(query), F.col("name")))
        return scored.where(F.col("score") * len(query.lower()) <= edits + 0.5)

    def nearest(self, query: str, distance: float, k: int, rows: DataFrame | None = None, column: str = "name") -> DataFrame:
        """(name, score) of all names that the k nearest rows within `distance` may have; rows (column, ..) or the names themselves."""
        most = int(distance * len(query.lower()) + 1e-9)
        edits = 0
        while True:
            found = self.near(query, edits)
            if edits >= most:
                return found
            found = stored(found)
            held = found if rows is None else rows.select(F.col(column).alias("name")).join(found, "name")
            if held.limit(k).count() >= k:
                return found
            edits = min(most, max(1, 2 * edits))
