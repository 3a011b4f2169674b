"""Edges to video services: channel listing, metadata and frames, behind protocols; errors stay with their rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import repair, sampling
from ..session import importable, stored

METADATA = "video_id string, title string, upload_date string, duration double, uploader string, tags array<string>, thumbnail string, url string, error string"


class MediaService(Protocol):
    """What reaches a video service. Made in each Python worker by a factory."""

    def listing(self, channel: str, after: str) -> list[dict]:
        """Stubs (video_id, upload_date) of a channel's videos from a date (yyyymmdd) on."""

    def metadata(self, video_id: str) -> dict:
        """A video's metadata; raises where it can't be read."""

    def frame(self, url: str, second: int) -> bytes:
        """One picture; raises where it can't be taken."""


def list_channels(channels: DataFrame, factory: Callable[[], MediaService], after: str, skips: DataFrame) -> DataFrame:
    """(video_id, upload_date) of the channels' videos from the date on, without skipped ones."""
    importable(channels.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = factory()
        for batch in batches:
            rows = [s for c in batch["url"] for s in service.listing(c, after)]
            yield pd.DataFrame({"video_id": [r["video_id"] for r in rows], "upload_date": [r.get("upload_date") for r in rows]}, dtype=object)

    found = channels.mapInPandas(run, "video_id string, upload_date string").where(F.col("upload_date").isNull() | (F.col("upload_date") >= after))
    return repair.not_skipped(found.dropDuplicates(["video_id"]), skips)


def fetch_metadata(ids: DataFrame, factory: Callable[[], MediaService]) -> DataFrame:
    """METADATA of ids(video_id); a failure gives a row with its error and nothing else."""
    importable(ids.sparkSession)
    names = [f.split()[0] for f in METADATA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = factory()
        for batch in batches:
            rows = []
            for video_id in batch["video_id"]:
                try:
                    rows.append({**service.metadata(video_id), "video_id": video_id, "error": None})
                except Exception as e:  # noqa: BLE001  one video's failure is that video's
                    rows.append({"video_id": video_id, "error": str(e) or type(e).__name__})
            yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names, dtype=object)

    return ids.select("video_id").mapInPandas(run, METADATA)


def take_frames(videos: DataFrame, have: DataFrame, factory: Callable[[], MediaService], tag: str | None = None) -> DataFrame:
    """(video_id, video_timestamp_sec, content, error) of the frames that videos(video_id, url, duration, tags) still miss."""
    importable(videos.sparkSession)
    planned = sampling.frames_to_take(videos.where(F.col("url").isNotNull()), have, tag)
    wanted = planned.select("video_id", "url", F.explode("expected").alias("video_timestamp_sec")).join(have, ["video_id", "video_timestamp_sec"], "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = factory()
        for batch in batches:
            out = []
            for video_id, url, second in zip(batch["video_id"], batch["url"], batch["video_timestamp_sec"], strict=True):
                try:
                    out.append((video_id, second, service.frame(url, int(second)), None))
                except Exception as e:  # noqa: BLE001
                    out.append((video_id, second, None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=["video_id", "video_timestamp_sec", "content", "error"])

    # Each frame is a request of its own, so they're spread evenly.
    return wanted.select("video_id", "url", "video_timestamp_sec").repartition("video_id", "video_timestamp_sec").mapInPandas(run, "video_id string, video_timestamp_sec int, content binary, error string")


def channel_frames(channels: DataFrame, factory: Callable[[], MediaService], after: str, skips: DataFrame, have: DataFrame, tag: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All of a channel run: (metadata of the videos listed, frames taken of those that could be read); each request is made once."""
    metadata = stored(fetch_metadata(list_channels(channels, factory, after, skips), factory))
    return metadata, stored(take_frames(metadata.where(F.col("error").isNull()), have, factory, tag))


#: Levels of lists that one pass over the rows opens.
LEVELS = 8


def flatten_playlist(entries: DataFrame, column: str = "entries") -> DataFrame:
    """(entry): the videos of nested playlists, as JSON text, however deep; entries(.., column: JSON array of objects).

    An object of _type playlist with entries is a list, and what it holds is read in its place; any other object with
    an id is a video. Nulls and objects without an id are left out. A pass opens LEVELS levels of every row, where the rows are;
    it is stored, and lists that are left go through another.
    """
    rows, done = _opened(entries.select(F.from_json(column, "array<string>").alias("_held"))), []
    while True:
        for _ in range(LEVELS):
            held = F.when(F.col("_list"), F.from_json("_inner", "array<string>")).otherwise(F.array("entry"))
            rows = _opened(_looked_at(rows).select(held.alias("_held")))
        found = stored(_looked_at(rows).select("entry", "_list").where(F.col("_list") | (F.coalesce(F.get_json_object("entry", "$.id"), F.lit("")) != "")), all_tasks=True)
        done.append(found.where(~F.col("_list")).select("entry"))
        rows = found.where("_list").select("entry")
        if rows.isEmpty():
            return reduce(DataFrame.unionAll, done)


def _looked_at(rows: DataFrame) -> DataFrame:
    """(entry, _list, _inner): whether it is a list, and what it holds as JSON text. Only entries that may name the field are parsed, once for both fields."""
    may_be = F.contains(F.col("entry"), F.lit("entries")) | F.contains(F.col("entry"), F.lit("\\"))
    told = rows.select("entry", F.json_tuple(F.when(may_be, F.col("entry")), "_type", "entries").alias("_type", "_inner"))
    return told.select("entry", F.coalesce((F.col("_type") == "playlist") & F.col("_inner").isNotNull(), F.lit(False)).alias("_list"), "_inner")


def _opened(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("_held").alias("entry")).where(F.col("entry").isNotNull())
