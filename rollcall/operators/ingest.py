"""Replay ingest: nested battle records to tables, behind a high-water mark, each row once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stored

#: Battles before this are never fetched.
EARLIEST = "2024-01-01T00:00:00.000Z"


def high_water_mark(battles: DataFrame) -> str | None:
    """The greatest timestamp as text, None for an empty table. ISO text of one format orders as time."""
    return battles.agg(F.max("timestamp")).first()[0]


def newer_than(records: DataFrame, since: str | None, earliest: str = EARLIEST, column: str = "startTime") -> DataFrame:
    """Records after the mark and not before the historical bound; both reach the scan as filters."""
    kept = records.where(F.col(column) >= earliest)
    return kept if since is None else kept.where(F.col(column) > since)


def usable(records: DataFrame) -> DataFrame:
    """Records with id, time and teams."""
    return records.where("id is not null and startTime is not null and AllyTeams is not null").where(F.size("AllyTeams") > 0)


def battle_rows(records: DataFrame) -> DataFrame:
    """(battle_id, timestamp, map_name); a null Map gives a null map_name."""
    return usable(records).select(F.col("id").alias("battle_id"), F.col("startTime").alias("timestamp"), F.col("Map.scriptName").alias("map_name"))


def _distinct_names() -> Column:
    """Distinct names of a record's teams, without null or empty ones."""
    teams = F.filter("AllyTeams", lambda t: t["Players"].isNotNull())
    names = F.transform(F.flatten(F.transform(teams, lambda t: t["Players"])), lambda p: p["name"])
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))


def _together(names: str) -> Column:
    """Distinct names of a group's arrays."""
    return F.array_distinct(F.flatten(F.collect_list(names)))


def participant_rows(records: DataFrame) -> DataFrame:
    """(battle_id, player_name), distinct, without null or empty names. Records of one id are put together as arrays, so no table of names is held."""
    named = usable(records).select(F.col("id").alias("battle_id"), _distinct_names().alias("_names"))
    return named.groupBy("battle_id").agg(_together("_names").alias("_names")).select("battle_id", F.explode("_names").alias("player_name"))


def player_rows(participants: DataFrame) -> DataFrame:
    return participants.select("player_name").distinct()


def new_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is new, one for each key (the least row): insert or ignore."""
    others = [c for c in incoming.columns if c not in keys]
    once = incoming.distinct() if not others else incoming.groupBy(keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
    return once.join(existing.select(keys), keys, "left_anti").select(incoming.columns)


def replaced(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key is not incoming, and all incoming rows: insert or replace."""
    return existing.join(incoming.select(keys), keys, "left_anti").select(existing.columns).unionByName(incoming.select(existing.columns))


def upsert_counts(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """(additions, updates) in one row."""
    known = existing.select(*keys, F.lit(True).alias("_known")).distinct()
    joined = incoming.select(keys).distinct().join(known, keys, "left")
    return joined.agg(F.count_if(F.col("_known").isNull()).alias("additions"), F.count_if(F.col("_known").isNotNull()).alias("updates"))


COUNTS = "records long, skipped long, battles long, players long, links long"


def _compared(records: DataFrame, battles: DataFrame, participants: DataFrame) -> DataFrame:
    """(battle_id, timestamp, map_name, _known, _new, _old), a row for each id of usable records: its least row, whether battles have it,
    and its distinct names that participants lack and have. All is dealt by battle_id alone, so what is dealt by it already isn't again."""
    row = F.struct(F.col("startTime").alias("timestamp"), F.col("Map.scriptName").alias("map_name"))
    rows = records.select(F.col("id").alias("battle_id"), row.alias("_row"), _distinct_names().alias("_names"))
    whole = rows.groupBy("battle_id").agg(F.min("_row").alias("_row"), _together("_names").alias("_names"))
    known = battles.select("battle_id").distinct().withColumn("_known", F.lit(True))
    rosters = participants.groupBy("battle_id").agg(F.collect_set("player_name").alias("_roster"))
    both = whole.join(known, "battle_id", "left").join(rosters, "battle_id", "left").withColumn("_roster", F.coalesce("_roster", F.array().cast("array<string>")))
    return both.select("battle_id", "_row.*", F.col("_known").isNotNull().alias("_known"), F.array_except("_names", "_roster").alias("_new"), F.array_intersect("_names", "_roster").alias("_old"))


def ingest_counted(records: DataFrame, battles: DataFrame, participants: DataFrame, players: DataFrame, since: str | None = None, earliest: str = "") -> tuple[dict[str, DataFrame], DataFrame]:
    """New rows of the three tables, written once, and COUNTS in one row: records read, those without id, time or teams, and rows added. Records not after the mark or before the bound add none.

    Records meet both known tables at once, by battle_id, and are written as a row a battle, which new battles and
    participants are read from; new players are the second table written. The counters ride along with the writes.
    """
    spark = records.sparkSession
    seen, added, met = Observation(), Observation(), Observation()
    sound = F.coalesce(F.col("id").isNotNull() & F.col("startTime").isNotNull() & (F.size("AllyTeams") > 0), F.lit(False))
    narrow = records.select("id", "startTime", "Map", "AllyTeams").observe(seen, F.count(F.lit(1)).alias("records"), F.count_if(~sound).alias("skipped"))
    pulled = _compared(newer_than(usable(narrow), since, earliest), battles, participants)
    fresh = stored(pulled.observe(added, F.count_if(~F.col("_known")).alias("battles"), F.coalesce(F.sum(F.size("_new")), F.lit(0)).alias("links")))
    named = fresh.select(F.explode(F.concat("_new", "_old")).alias("player_name"))
    out = {
        "battles": fresh.where(~F.col("_known")).select("battle_id", "timestamp", "map_name"),
        "participants": fresh.select("battle_id", F.explode("_new").alias("player_name")),
        "players": stored(new_rows(named, players, ["player_name"]).observe(met, F.count(F.lit(1)).alias("n"))),
    }
    row = (seen.get["records"], seen.get["skipped"], added.get["battles"], met.get["n"], added.get["links"])
    return out, spark.createDataFrame([row], COUNTS)


def ingest(records: DataFrame, battles: DataFrame, participants: DataFrame, players: DataFrame, complete: bool = True) -> tuple[dict[str, DataFrame], str | None]:
    """New rows of the three tables, and the mark to go on from.

    The mark advances only after a complete pull: records arrive newest first, so a part of them leaves a gap
    below, which a mark taken from the tables would hide.
    """
    mark = high_water_mark(battles)
    fresh = newer_than(records, mark)
    parts = participant_rows(fresh)
    new = {
        "battles": new_rows(battle_rows(fresh), battles, ["battle_id"]),
        "participants": new_rows(parts, participants, ["battle_id", "player_name"]),
        "players": new_rows(player_rows(parts), players, ["player_name"]),
    }
    return new, (high_water_mark(new["battles"]) or mark) if complete else mark
