"""Screenshots to observations: which are new, what the recogniser read, which lines are names."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import OCR_HIT
from ..session import importable, once_a_worker

#: Least detector confidence (exclusive), least side of the region, least confidence of a line.
PANEL_CONFIDENCE = 0.80
REGION_SIDE = 30
LINE_CONFIDENCE = 0.35


def frames(files: DataFrame) -> DataFrame:
    """files(path, ...) whose names are frames, with video_id and video_timestamp_sec from the name."""
    name = T.base_name(F.col("path"))
    return files.where(T.is_frame(name)).withColumns({"video_id": T.frame_video(name), "video_timestamp_sec": T.frame_second(name)})


def unprocessed(screenshots: DataFrame, done: DataFrame) -> DataFrame:
    """Screenshots not in done, by video and second."""
    keys = ["video_id", "video_timestamp_sec"]
    return screenshots.join(done.select(keys), keys, "left_anti")


def clamped(box: Column, width: Column, height: Column) -> Column:
    """A box [x1, y1, x2, y2] inside the picture."""
    inside = lambda v, most: F.greatest(F.lit(0), F.least(v, most - 1))
    return F.array(inside(box[0], width), inside(box[1], height), inside(box[2], width), inside(box[3], height))


def best_panel(detections: DataFrame) -> DataFrame:
    """(path, box): of detections(path, pos, box, conf, width, height) the most confident, first of equals.

    Null where none is above PANEL_CONFIDENCE, starts in the right half and has sides of REGION_SIDE.
    """
    box = clamped(F.col("box"), F.col("width"), F.col("height"))
    top = detections.where(F.col("conf") > PANEL_CONFIDENCE).groupBy("path").agg(F.max_by(F.struct(box.alias("box"), "width"), F.struct("conf", F.negative("pos"))).alias("top"))
    b = F.col("top.box")
    good = (b[0] > F.col("top.width") * 0.5) & (b[2] - b[0] >= REGION_SIDE) & (b[3] - b[1] >= REGION_SIDE)
    return detections.select("path").distinct().join(top.where(good).select("path", b.alias("box")), "path", "left")


def zip_hits(boxes: Column, texts: Column, scores: Column) -> Column:
    """A recogniser's parallel lists as an array of hits."""
    return F.transform(F.arrays_zip(boxes.alias("box"), texts.alias("text"), scores.alias("score")), lambda h: F.struct(h["box"].alias("box"), h["text"].alias("text"), h["score"].alias("score")))


def is_line(score: Column) -> Column:
    return score.isNull() | (score >= LINE_CONFIDENCE)


def names_of(hits: Column) -> Column:
    """Names among an array of hits: confident name-like lines, top to bottom, then left to right, junk in front cut off."""
    numbered = F.transform(hits, lambda h, i: F.struct(h["box"][0][1].cast("int").alias("y"), h["box"][0][0].cast("int").alias("x"), i.alias("pos"), h["text"].alias("text"), h["score"].alias("score")))
    lines = F.filter(numbered, lambda h: is_line(h["score"]) & T.is_gamertag(h["text"]))
    return F.transform(F.array_sort(lines), lambda h: T.strip_leading_junk(T.strip(h["text"])))


class OcrBackend(Protocol):
    """A recogniser; made once in each Python worker by the factory that `recognise` gets."""

    def hits(self, content: bytes) -> list[dict]:
        """Hits of one picture: dicts of box (four corners from top left), text and score."""


class PanelBackend(Protocol):
    """A detector of the panel that holds the names; made once in each Python worker."""

    def panels(self, content: bytes) -> tuple[int, int, list[tuple[list[int], float]]]:
        """Width and height of a picture, and (box [x1, y1, x2, y2], confidence) of each panel found."""

    def crop(self, content: bytes, box: list[int]) -> bytes:
        """The part of the picture inside the box."""


def panel_of(width: int, height: int, found: list[tuple[list[int], float]]) -> list[int] | None:
    """best_panel's rule for one picture."""
    if not found:
        return None
    box, confidence = max(found, key=lambda f: f[1])
    x1, y1, x2, y2 = (max(0, min(int(v), most - 1)) for v, most in zip(box, (width, height) * 2, strict=True))
    good = confidence > PANEL_CONFIDENCE and x1 > width * 0.5 and x2 - x1 >= REGION_SIDE and y2 - y1 >= REGION_SIDE
    return [x1, y1, x2, y2] if good else None


def recognise(screenshots: DataFrame, factory, panel_factory=None) -> DataFrame:
    """(video_id, video_timestamp_sec, players) of screenshots(video_id, video_timestamp_sec, content).

    With panel_factory, each picture's panel is found and only that part of it is read; without a panel nothing
    is. Both run by batch; what follows them is column expressions. A picture without names gives an empty
    array, so that it counts as processed; one that either can't read (an exception) does, too.
    """
    importable(screenshots.sparkSession)
    reader, finder = once_a_worker(factory), panel_factory and once_a_worker(panel_factory)

    def read(content: bytes) -> list[dict]:
        try:
            if finder:
                box = panel_of(*finder().panels(content))
                if box is None:
                    return []
                content = finder().crop(content, box)
            return reader().hits(content)
        except Exception:  # noqa: BLE001  one picture's failure is that picture's
            return []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"video_id": batch["video_id"], "video_timestamp_sec": batch["video_timestamp_sec"], "hits": [read(c) for c in batch["content"]]})

    raw = screenshots.select("video_id", "video_timestamp_sec", "content").mapInPandas(run, f"video_id string, video_timestamp_sec int, hits array<{OCR_HIT.simpleString()}>")
    return raw.select("video_id", "video_timestamp_sec", F.coalesce(names_of(F.col("hits")), F.array().cast("array<string>")).alias("players"))


def merged(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Observations with the new ones in place of those of the same video and second."""
    from .ingest import replaced

    return replaced(existing, new, ["video_id", "video_timestamp_sec"])


def documents(metadata: DataFrame, observations: DataFrame) -> DataFrame:
    """(video_id, document): the screenshot document of each video, metadata null where only pictures are known."""
    entry = F.struct(F.col("video_timestamp_sec").cast("string").alias("key"), F.col("players").alias("value"))
    shots = observations.groupBy("video_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("screenshots"))
    fields = ["title", "upload_date", "duration", "uploader", "tags", "thumbnail", "screenshots"]
    return metadata.join(shots, "video_id", "full").select("video_id", F.struct(*fields).alias("document"))
