"""Schemas of source documents and tables; readers declare these and never infer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, MapType, StringType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D = StringType(), IntegerType(), DoubleType()

#: One battle of the replay API.
API_BATTLE = _struct(id=_S, startTime=_S, Map=_struct(scriptName=_S), AllyTeams=ArrayType(_struct(Players=ArrayType(_struct(name=_S)))))

#: What a video's document holds besides its screenshots.
VIDEO_METADATA = {"title": _S, "upload_date": _S, "duration": _D, "uploader": _S, "tags": ArrayType(_S), "thumbnail": _S}
#: video_id -> metadata and screenshots: second -> names read.
SCREENSHOT_DOCUMENT = MapType(_S, _struct(**VIDEO_METADATA, screenshots=MapType(_S, ArrayType(_S))))
#: The same after matching.
MATCH = _struct(players_ocr=ArrayType(_S), matched_battle_id=_S, match_score=_D)
MATCH_DOCUMENT = MapType(_S, _struct(**VIDEO_METADATA, screenshots=MapType(_S, MATCH)))
DETECTIONS_DOCUMENT = MapType(_S, _struct(box=ArrayType(_I), confidence=_D))

BATTLES = _struct(battle_id=_S, timestamp=_S, map_name=_S)
PLAYERS = _struct(player_name=_S)
PARTICIPANTS = _struct(battle_id=_S, player_name=_S)
VIDEOS = _struct(video_id=_S, upload_date=_S, title=_S, uploader=_S)
BATTLE_VIDEOS = _struct(battle_id=_S, video_id=_S, video_timestamp_sec=_I, match_score=_D, ocr_player_count=_I, battle_player_count=_I)
#: One row a screenshot, before matching.
OBSERVATIONS = _struct(video_id=_S, video_timestamp_sec=_I, players=ArrayType(_S), upload_date=_S)
OCR_HIT = _struct(box=ArrayType(ArrayType(_D)), text=_S, score=_D)

KEYS = {"battles": ["battle_id"], "players": ["player_name"], "participants": ["battle_id", "player_name"], "videos": ["video_id"], "battle_videos": ["battle_id", "video_id", "video_timestamp_sec"]}
TABLES = {"battles": BATTLES, "players": PLAYERS, "participants": PARTICIPANTS, "videos": VIDEOS, "battle_videos": BATTLE_VIDEOS}


def create_tables(spark, database: str = "default") -> None:
    """CREATE TABLE IF NOT EXISTS for every table, as Parquet in a catalog database, with its key as a property.

    Parquet tables can't enforce keys; insert_or_ignore and insert_or_replace keep them, and repeated_keys tells.
    """
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet TBLPROPERTIES ('key' = '{','.join(KEYS[name])}')")


def repeated_keys(rows: DataFrame, name: str) -> DataFrame:
    """(key columns, rows): keys of the table that stand on more than one row, or hold a null."""
    counts = rows.groupBy(KEYS[name]).agg(F.count("*").alias("rows"))
    null = F.lit(False)
    for k in KEYS[name]:
        null = null | F.col(k).isNull()
    return counts.where((F.col("rows") > 1) | null)
