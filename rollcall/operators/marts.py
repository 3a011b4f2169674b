"""Serving tables: who is in which battle with a video, a battle's and a map's videos, names read in videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored

_DEFAULTS = {"title": "Unknown Title", "upload_date": "N/A", "uploader": "N/A"}


def _with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({c: T.or_default(F.col(c), d) for c, d in _DEFAULTS.items()})


def player_index(participants: DataFrame, battle_videos: DataFrame) -> DataFrame:
    """(player_name, battle_id): players of battles that have a video. A semi join; no video column is read."""
    named = participants.where(F.col("player_name").isNotNull())
    return named.join(battle_videos.select("battle_id"), "battle_id", "left_semi").select("player_name", "battle_id").distinct()


def battle_matches(battle_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """(battle_id, video_id, timestamp, title, upload_date, uploader): the first second a video shows a battle.

    The minimum is taken before the join, so the video's columns are joined to one row a pair.
    """
    first = battle_videos.groupBy("battle_id", "video_id").agg(F.min("video_timestamp_sec").alias("timestamp"))
    return _with_defaults(first.join(videos, "video_id").select("battle_id", "video_id", "timestamp", "title", "upload_date", "uploader"))


def map_index(battles: DataFrame, battle_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """battle_matches with the battle's map, where it has one; in an export ordered by map_name, upload_date descending."""
    mapped = battles.where(F.col("map_name").isNotNull()).select("battle_id", "map_name")
    return mapped.join(battle_matches(battle_videos, videos), "battle_id").select("map_name", "video_id", "timestamp", "title", "upload_date", "uploader", "battle_id")


def ordered_map_index(index: DataFrame) -> DataFrame:
    return index.orderBy("map_name", F.col("upload_date").desc_nulls_last(), "video_id", "battle_id")


def ocr_index(observations: DataFrame, videos: DataFrame) -> DataFrame:
    """(ocr_name, video_id, timestamp, title, upload_date, uploader): one row for each name of each screenshot; repeated names stay."""
    names = observations.select("video_id", F.col("video_timestamp_sec").alias("timestamp"), F.explode("players").alias("ocr_name")).where("ocr_name is not null and ocr_name <> ''")
    return names.join(videos, "video_id").select("ocr_name", "video_id", "timestamp", "title", "upload_date", "uploader")


def player_names(index: DataFrame) -> DataFrame:
    return index.select("player_name").distinct()


def map_names(index: DataFrame) -> DataFrame:
    return index.select("map_name").distinct().orderBy("map_name")


def last_upload(videos: DataFrame) -> DataFrame:
    """(last_battle): the greatest upload date as a number, 0 without one; dates that are no number don't count."""
    return videos.agg(F.coalesce(F.max(T.upload_number(F.col("upload_date"))), F.lit(0)).alias("last_battle"))


def index_totals(players: DataFrame, battles: DataFrame, ocr: DataFrame, maps: DataFrame) -> DataFrame:
    """(players, battles, ocr_names, maps): how many keys each index has, in one row."""
    parts = {"players": players.select("player_name"), "battles": battles.select("battle_id"), "ocr_names": ocr.select("ocr_name"), "maps": maps.select("map_name")}
    keys = None
    for name, df in parts.items():
        own = df.toDF("key").distinct().select(F.lit(name).alias("kind"), "key")
        keys = own if keys is None else keys.unionByName(own)
    return keys.agg(*[F.count_if((F.col("kind") == name) & F.col("key").isNotNull()).alias(name) for name in parts])


#: Rows of a list's page.
PAGE_ROWS = 1000


def paged_lists(rows: DataFrame, key: str, name: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, page, name): the other columns of a key's rows as structs, in order, in pages numbered from 0.

    Rows are dealt to ranges by key and their other columns and sorted there, so a key with most rows takes many
    tasks; a row's place in its list is its place in its range, plus what the ranges before hold of the key.
    """
    others = [c for c in rows.columns if c != key]
    spread = rows.repartitionByRange(key, *others).sortWithinPartitions(key, *others)
    placed = stored(spread.withColumn("_at", F.monotonically_increasing_id()))  # the range's number and the place in it
    part = F.shiftright("_at", 33)  # of the range
    own = placed.groupBy(key, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    own = own.select(F.col(key).alias("_key"), F.col("_part").alias("_own"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = placed.join(own, F.col(key).eqNullSafe(F.col("_key")) & (part == F.col("_own")))
    page = F.floor((F.col("_at") + F.col("_shift")) / page_rows).alias("page")
    return joined.groupBy(key, page).agg(F.sort_array(F.collect_list(F.struct(*others))).alias(name))


def player_lists(index: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(player_name, page, battle_ids): for the serving document."""
    lists = paged_lists(index.select("player_name", "battle_id"), "player_name", "items", page_rows)
    return lists.select("player_name", "page", F.col("items.battle_id").alias("battle_ids"))


def match_lists(matches: DataFrame, key: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, page, matches): the other columns of a battle's or map's rows as sorted structs."""
    return paged_lists(matches, key, "matches", page_rows)


def serving_tables(battles: DataFrame, participants: DataFrame, battle_videos: DataFrame, videos: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    """All serving tables by name."""
    players, maps = player_index(participants, battle_videos), map_index(battles, battle_videos, videos)
    return {
        "player_index": players,
        "all_player_names": player_names(players),
        "battle_matches": battle_matches(battle_videos, videos),
        "ocr_index": ocr_index(observations, videos),
        "map_index": maps,
        "all_map_names": map_names(maps),
        "last_battle": last_upload(videos),
    }


def serving_document(tables: dict[str, DataFrame]) -> DataFrame:
    """(value): the serving document as JSON lines, {table: {key: rows}} a line, for clients that want text.

    A line holds a key's page, so lines stay small; a reader merges the objects of equal table names and joins a key's
    lists in the order of their pages.
    """
    keys = {"player_index": "player_name", "battle_matches": "battle_id", "map_index": "map_name"}
    line = lambda name, value: F.to_json(F.create_map(F.lit(name), value)).alias("value")
    out = tables["last_battle"].select(F.to_json(F.struct("last_battle")).alias("value"))
    for name, rows in tables.items():
        if name in keys:
            out = out.unionByName(match_lists(rows, keys[name]).orderBy(keys[name], "page").select(line(name, F.create_map(F.col(keys[name]), F.col("matches")))))
        elif name != "last_battle":
            out = out.unionByName(rows.select(line(name, F.struct("*"))))
    return out
