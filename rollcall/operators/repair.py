"""Keeps video metadata complete: what is missing or incomplete, refetch, upsert, placeholders, skip lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored
from .ingest import replaced


def is_incomplete(title: Column, upload_date: Column, uploader: Column) -> Column:
    """Title, upload date or uploader null or empty."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return blank(title) | blank(upload_date) | blank(uploader)


def video_ids_of_files(files: DataFrame, any_file: bool = False) -> DataFrame:
    """(video_id): distinct ids of files(path), frame suffix and white space cut off; of .png files, or of any."""
    name = T.base_name(F.col("path"))
    named = files if any_file else files.where(name.endswith(".png"))
    return named.select(T.strip_frame_suffix(name).alias("video_id")).distinct()


def missing(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(video_id) with files but no metadata."""
    return video_ids_of_files(files).join(metadata.select("video_id"), "video_id", "left_anti")


def incomplete(metadata: DataFrame) -> DataFrame:
    return metadata.where(is_incomplete(F.col("title"), F.col("upload_date"), F.col("uploader"))).select("video_id")


def to_refetch(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(video_id): missing and incomplete ones, once each."""
    return missing(files, metadata).union(incomplete(metadata)).distinct()


def placeholders(failed: DataFrame, metadata: DataFrame) -> DataFrame:
    """Entries for failed(video_id) that have none or no title, in metadata's columns."""
    titled = metadata.where(F.coalesce("title", F.lit("")) != "").select("video_id")
    values = {"title": F.lit("N/A"), "upload_date": F.lit("N/A"), "duration": F.lit(0.0), "uploader": F.lit("N/A"), "tags": F.array().cast("array<string>"), "thumbnail": F.lit(None).cast("string")}
    return failed.join(titled, "video_id", "left_anti").select(*[F.col("video_id") if c == "video_id" else values[c].alias(c) for c in metadata.columns])


def synced(files: DataFrame, metadata: DataFrame, fetch) -> DataFrame:
    """Metadata after a repair. fetch(ids) gives rows of metadata's columns and `error` (null where it worked).

    What was fetched is written once, so no request is made twice and both parts speak of the same replies.
    """
    fetched = stored(fetch(to_refetch(files, metadata)))
    good = fetched.where(F.col("error").isNull()).select(metadata.columns)
    after = replaced(metadata, good, ["video_id"])
    return replaced(after, placeholders(fetched.where(F.col("error").isNotNull()).select("video_id"), metadata), ["video_id"])


def skip_list(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(value): 'youtube <id>' lines of all ids with files of any kind or metadata, white space cut off, in order."""
    ids = video_ids_of_files(files, any_file=True).union(metadata.select(T.strip(F.col("video_id")))).distinct()
    return ids.select(F.concat(F.lit("youtube "), "video_id").alias("value")).orderBy("value")


def not_skipped(listing: DataFrame, skips: DataFrame) -> DataFrame:
    """listing(video_id, ...) without the ids of skip lines."""
    ids = skips.select(F.regexp_extract("value", r"^\S+ (.*)$", 1).alias("video_id"))
    return listing.join(ids, "video_id", "left_anti")
