"""Searches over the serving tables: a player, a map, a name as it was read, and completion of either."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import substring_score
from ..session import importable
from .name_index import NameIndex

#: Greatest distance, in shares of the query's length, and rows of each search.
OCR_DISTANCE, OCR_ROWS = 0.4, 20
NAME_DISTANCE, NAME_ROWS = 0.3, 10
LIST_ROWS = 100
#: Fewest characters that complete.
MIN_CHARS = {"player": 2, "map": 0}


def search_player(index: DataFrame, matches: DataFrame, name: str) -> DataFrame:
    """A player's videos, newest first; dates that are no number last."""
    own = index.where(F.col("player_name") == name).select("battle_id").distinct()
    found = matches.join(own, "battle_id", "left_semi")
    return found.orderBy(T.upload_number(F.col("upload_date")).desc_nulls_last(), "battle_id", "video_id")


def search_map(index: DataFrame, name: str) -> DataFrame:
    """A map's videos in the export's order."""
    return index.where(F.col("map_name") == name).orderBy(F.col("upload_date").desc_nulls_last(), "video_id", "battle_id")


def _nearest(rows: DataFrame, column: str, query: str, distance: float, k: int, order: list[str], index: NameIndex | None) -> DataFrame:
    """Names are scored once each, of an index only those that may be near; the near ones' rows are joined and ordered."""
    importable(rows.sparkSession)
    if index is None or not query:
        names = rows.select(column).distinct()
        # Nondeterministic to the optimizer, which would evaluate it in the filter and again above.
        near = names.withColumn("score", substring_score.asNondeterministic()(F.lit(query), F.col(column)))
    else:
        near = index.nearest(query, distance, k, None if rows.columns == [column] else rows, column).withColumnRenamed("name", column)
    near = near.where(F.col("score") <= distance)
    found = near if rows.columns == [column] else rows.join(near, column).select(*rows.columns, "score")
    return found.orderBy("score", *order).limit(k)


def search_ocr(index: DataFrame, query: str, k: int = OCR_ROWS, distance: float = OCR_DISTANCE, names: NameIndex | None = None) -> DataFrame:
    """Rows whose name is nearest to the query, best first; a name read in several screenshots takes several rows.

    names: an index of the names that index has; without one every name is scored.
    """
    return _nearest(index, "ocr_name", query, distance, k, ["ocr_name", "video_id", "timestamp"], names)


def autocomplete(names: DataFrame, column: str, query: str, kind: str = "player", k: int = NAME_ROWS, distance: float = NAME_DISTANCE, index: NameIndex | None = None) -> DataFrame:
    """Names nearest to the query, from an index of theirs if there is one. Below MIN_CHARS nothing; an empty query where that is allowed lists the first names."""
    if len(query.strip()) < MIN_CHARS[kind]:
        return names.select(column, F.lit(0.0).alias("score")).where(F.lit(False))
    if not query.strip():
        return first_items(names, column).select(column, F.lit(0.0).alias("score"))
    return _nearest(names.select(column), column, query, distance, k, [column], index)


def first_items(names: DataFrame, column: str, k: int = LIST_ROWS) -> DataFrame:
    return names.select(column).orderBy(column).limit(k)


def player_outcomes(names: DataFrame, index: DataFrame, matches: DataFrame) -> DataFrame:
    """(player_name, outcome) of names(player_name): 'unknown_player', 'no_videos' or 'found'."""
    own = index.join(names, "player_name", "left_semi")
    shown = own.join(matches.select("battle_id").distinct().withColumn("shown", F.lit(True)), "battle_id", "left")
    told = shown.groupBy("player_name").agg(F.count_if("shown").alias("shown"))
    outcome = F.when(F.col("shown").isNull(), "unknown_player").when(F.col("shown") == 0, "no_videos").otherwise("found")
    return names.join(told, "player_name", "left").select("player_name", outcome.alias("outcome"))


def player_outcome(index: DataFrame, matches: DataFrame, name: str) -> DataFrame:
    """(outcome) of one name, in one row."""
    names = index.sparkSession.createDataFrame([(name,)], "player_name string")
    return player_outcomes(names, index, matches).select("outcome")


def map_outcomes(names: DataFrame, index: DataFrame) -> DataFrame:
    """(map_name, outcome) of names(map_name): 'no_videos' or 'found'."""
    known = index.select("map_name").distinct().withColumn("known", F.lit(True))
    return names.join(known, "map_name", "left").select("map_name", F.when(F.col("known"), "found").otherwise("no_videos").alias("outcome"))


def search_outcome(found: DataFrame, query: str) -> DataFrame:
    """(outcome) of a fuzzy search's rows: 'no_query' for an empty one, 'no_matches' or 'found'."""
    many = F.when(F.count("*") > 0, "found").otherwise("no_matches")
    return found.agg((many if query else F.lit("no_query")).alias("outcome"))


def query_name(url: str) -> str | None:
    """The player that a page's address asks for (?playerName=), or None."""
    from urllib.parse import parse_qs, urlsplit

    return next(iter(parse_qs(urlsplit(url).query).get("playerName", [])), None)


def with_links(rows: DataFrame, replay_base: str, seconds: str = "timestamp") -> DataFrame:
    """Rows with watch_url, thumbnail_url, time as M:SS, display_date, and replay_url where there is a battle."""
    columns = {
        "watch_url": T.watch_url(F.col("video_id"), F.col(seconds)),
        "thumbnail_url": T.thumbnail_url(F.col("video_id")),
        "time": T.minutes_seconds(F.col(seconds)),
        "display_date": T.display_date(F.col("upload_date")),
    }
    if "battle_id" in rows.columns:
        columns["replay_url"] = T.replay_url(F.col("battle_id"), replay_base)
    return rows.withColumns(columns)
