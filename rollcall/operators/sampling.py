"""Which videos to take frames of, at which seconds; splits of a labelled set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: First second, step, and least duration of a video.
FIRST, STEP, LEAST = 90, 720, 90


def schedule(duration: Column, first: int = FIRST, step: int = STEP) -> Column:
    """Seconds first, first + step, ... below the duration's whole seconds; an empty array for null."""
    end = F.floor(duration).cast("int")
    empty = F.array().cast("array<int>")
    return F.coalesce(F.when(end > first, F.sequence(F.lit(first), end - 1, F.lit(step))).otherwise(empty), empty)


def long_enough(duration: Column, least: int = LEAST) -> Column:
    return F.coalesce(duration >= least, F.lit(False))


def has_tag(tags: Column, tag: str | None) -> Column:
    """Whether the tags hold the tag, by lower case; no tag asked for: always; null tags: never."""
    if tag is None:
        return F.lit(True)
    return F.coalesce(F.exists(tags, lambda t: F.lower(t) == tag.lower()), F.lit(False))


def all_exist(expected: Column, have: Column) -> Column:
    """Whether every expected second is there; true for an empty expectation."""
    return F.size(F.array_except(expected, F.coalesce(have, F.array().cast("array<int>")))) == 0


def frames_to_take(videos: DataFrame, frames: DataFrame, tag: str | None = None) -> DataFrame:
    """videos(video_id, duration, tags, ...) that still miss frames, with `expected` seconds."""
    have = frames.groupBy("video_id").agg(F.collect_set("video_timestamp_sec").alias("_have"))
    planned = videos.where(long_enough(F.col("duration")) & has_tag(F.col("tags"), tag)).withColumn("expected", schedule(F.col("duration")))
    return planned.join(have, "video_id", "left").where(~all_exist(F.col("expected"), F.col("_have"))).drop("_have")


def stream_url(requested_formats: Column, url: Column) -> Column:
    """The first requested format's address, else the video's own."""
    return F.coalesce(F.try_element_at(requested_formats, F.lit(1))["url"], url)


def exact_split(rows: DataFrame, key: str, share: float = 0.8, seed: int = 0) -> DataFrame:
    """rows with split 'train' or 'val': exactly floor(share * n) train rows, drawn by a seeded hash of the key.

    The hash is the MD5 of 'seed:key', which other systems have too. Ranks come from counts of hash ranges, so no
    task sorts all rows.
    """
    lot = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    drawn = rows.withColumns({"_lot": lot, "_bucket": F.substring(lot, 1, 3)})
    counts = drawn.groupBy("_bucket").agg(F.count("*").alias("_n"))
    order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))  # both over 4096 rows at most
    before = counts.select("_bucket", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_total"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_lot", key)) + F.col("_before")
    ranked = drawn.join(F.broadcast(before), "_bucket").withColumn("_rank", rank)
    return ranked.withColumn("split", F.when(F.col("_rank") <= F.floor(F.col("_total") * share), "train").otherwise("val")).drop("_lot", "_bucket", "_before", "_total", "_rank")
