"""A corpus from documents to packed sequences: quality, lines, near duplicates, mix, packing.

Each stage is one of the operators of rollcall.llm with production parameters. All but the last return the
columns of documents; `run` writes each stage to the shared folder and reads it again for the next.

Extra columns stay through all stages but the last, whatever their names, and rows with equal or null ids are
documents of their own; very long texts are read whole everywhere. An empty table gives an empty one at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from rollcall.llm._session import keep, spread
from rollcall.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go; sound labelled texts give the bands.

    Null and empty texts go, as they have too few words. Without labels the widest bands hold. A ratio at a limit stays.
    """
    return quality_rules.keep_good(docs, quality_rules.fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text.

    Every row stays: a text all of whose lines are boilerplate becomes empty, a null text stays null. A null source is
    a source of its own. Repeated rows are one page of their source; a line exactly at the ratio stays.
    """
    return _counted(line_dedup.drop_boilerplate(docs, host="source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of smallest doc_id; null comes after all others.

    Of repeated rows one stays. Rows without words link with nothing, so they stay. A pair at the threshold links.
    """
    return ngram_join.keep_one(docs, k=5, percent=75)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each document and epoch, its text the words drawn; n_chars follows.

    Rows without words are never drawn, so they go. Each repeated row is drawn on its own. A null source comes last.
    """
    return _counted(mixing.Mix(docs).documents())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids. A null or empty text is its end id alone."""
    return packing.pack(docs, tokenizer_path(), capacity=4096, end_id=2)


def _counted(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    columns = docs.columns
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else docs


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: The tokenizer can't be expressed in SQL; tests/llm/test_pipeline.py holds a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
