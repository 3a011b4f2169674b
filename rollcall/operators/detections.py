"""Detector labels and results: the text codec of boxes, label status, data set, inference."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import importable, once_a_worker
from .ingest import replaced
from .sampling import exact_split


@F.pandas_udf(StringType())
def _label_text(xc: pd.Series, yc: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    """Six decimals of the double itself; the JVM's formatter rounds its shortest decimal text instead."""
    return pd.Series([None if pd.isna(v[0] + v[1] + v[2] + v[3]) else "0 %.6f %.6f %.6f %.6f" % v for v in zip(xc, yc, w, h, strict=True)], dtype=object)


def encode_label(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """'0 xc yc w h': centre and size in shares of the picture, six decimals; null if any part is."""
    share = lambda v, whole: v / whole.cast("double")
    return _label_text(share((x1 + x2) / 2.0, width), share((y1 + y2) / 2.0, height), share(x2 - x1, width), share(y2 - y1, height))


def decode_label(line: Column, width: Column, height: Column) -> Column:
    """struct<x1, y1, x2, y2> of a label line in pixels, truncated; null for a line that isn't five numbers."""
    parts = F.split(F.trim(line), r"\s+")
    n = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("double")
    low = lambda c, s, whole: ((n(c) - n(s) / 2) * whole).cast("int")
    high = lambda c, s, whole: ((n(c) + n(s) / 2) * whole).cast("int")
    box = F.struct(low(2, 4, width).alias("x1"), low(3, 5, height).alias("y1"), high(2, 4, width).alias("x2"), high(3, 5, height).alias("y2"))
    numbers = F.lit(True)
    for i in range(1, 6):
        numbers = numbers & n(i).isNotNull()
    return F.when((F.size(parts) == 5) & numbers, box)


def label_status(has_label: Column, is_skipped: Column) -> Column:
    return F.when(is_skipped, "skipped").when(has_label, "labeled").otherwise("unlabeled")


def labelled(labels: DataFrame, new: DataFrame) -> DataFrame:
    """labels(stem, line) after a round of labelling, one row a picture: new(stem, line) rows take the place of those of their stem.

    A null line is the mark of a picture that was skipped: its label goes, and the mark stays until it gets one.
    """
    return replaced(labels, new, ["stem"])


def label_counts(labels: DataFrame) -> DataFrame:
    """(labeled, skipped) in one row."""
    return labels.agg(F.count("line").alias("labeled"), F.count_if(F.col("line").isNull()).alias("skipped"))


def detections_document(found: DataFrame) -> DataFrame:
    """(name, detection) of infer's rows by picture name, for io.write_document: null where nothing was found."""
    from ..functions.text import base_name

    return found.select(base_name(F.col("path")).alias("name"), "detection")


def dataset(labels: DataFrame, images: DataFrame, share: float = 0.8, seed: int = 0) -> DataFrame:
    """Labels whose image exists, by stem, with an exact train/val split."""
    return exact_split(labels.join(images, "stem"), "stem", share, seed)


def write_dataset(rows: DataFrame, folder: str) -> None:
    """rows(stem, line, split, and content where the pictures are to lie beside the labels): a folder for each split, and data.yaml."""
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/data")
    rows.sparkSession.createDataFrame([(f"train: data/split=train\nval: data/split=val\nnc: 1\nnames: ['panel']\n",)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/data.yaml")


def first_detection(boxes: Column) -> Column:
    """The first of an array of struct<box, confidence>, or null: inference takes the first, not the best."""
    return F.try_element_at(boxes, F.lit(1))


def infer(images: DataFrame, factory) -> DataFrame:
    """(path, detection) of images(path, content): factory() makes a detector whose detect(bytes) lists (box, confidence)."""
    importable(images.sparkSession)
    detector = once_a_worker(factory)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"box": [int(v) for v in b], "confidence": float(c)} for b, c in detector().detect(x)] for x in batch["content"]]
            yield pd.DataFrame({"path": batch["path"], "found": found})

    raw = images.select("path", "content").mapInPandas(run, "path string, found array<struct<box:array<int>,confidence:double>>")
    return raw.select("path", first_detection(F.col("found")).alias("detection"))
