"""EXTENSION, beyond batch runs: file-source streams over ingest and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators import ingest, match
from ..schemas import API_BATTLE, KEYS, OBSERVATIONS
from ..sources.io import PartitionedTable, Table, write_together


def record_stream(spark: SparkSession, folder: str, schema: StructType = API_BATTLE) -> DataFrame:
    """JSON records as they land in a folder."""
    return spark.readStream.schema(schema).json(folder)


def once(records: DataFrame, delay: str = "1 day") -> DataFrame:
    """Records without repeats of an id within a delay of its time: state is bounded by the watermark."""
    timed = records.withColumn("event_time", F.try_to_timestamp("startTime")).where("event_time is not null")
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["id"]).drop("event_time")


def ingest_stream(records: DataFrame, battles: Table, participants: Table, checkpoint: str) -> StreamingQuery:
    """Each micro-batch into both tables at once, new rows appended; a batch that runs again adds nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        new = ((battles, ingest.battle_rows(rows), KEYS["battles"]), (participants, ingest.participant_rows(rows), KEYS["participants"]))
        write_together([(table, ingest.new_rows(own, table.read(), keys)) for table, own, keys in new], append=True)

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def match_stream(spark: SparkSession, folder: str, battles: Table, participants: Table, found: Table | PartitionedTable, checkpoint: str) -> StreamingQuery:
    """Observations as they land, matched against the tables of that moment. A partitioned table rewrites no more than a batch touches."""

    def batch(rows: DataFrame, _: int) -> None:
        matches = match.matched(rows, participants.read(), battles.read())
        found.insert_or_replace(match.battle_videos(matches), KEYS["battle_videos"])

    stream = spark.readStream.schema(OBSERVATIONS).json(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def battles_per_window(records: DataFrame, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """(start, map_name, battles): a tumbling count by map, final once the watermark passed."""
    timed = records.select(F.try_to_timestamp("startTime").alias("event_time"), T.or_default(F.col("Map.scriptName"), "N/A").alias("map_name"))
    counts = timed.withWatermark("event_time", delay).groupBy(F.window("event_time", window), "map_name").agg(F.count("*").alias("battles"))
    return counts.select(F.col("window.start").alias("start"), "map_name", "battles")
