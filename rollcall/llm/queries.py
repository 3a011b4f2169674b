"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, collocations, embedding_dedup, html_extract, importance, license_scan, line_dedup, mixing, ngram_join, packing, quality_rules, secret_scan, token_files
from ._session import spread


def tokenizer_path() -> str:
    """The public tokenizer that op4 and the pipeline pack with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer_path() -> str:
    """The public tokenizer whose ids op11 writes."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; links by 5-word shingles at 0.75."""
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), k=5, percent=75)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector; links by label and cosine at 0.93."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a piece of the documents' ids in sequences of at most 4096."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines, and how many lines it had and lost."""
    out = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), host="source", counts=True)
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the secrets' spans of every document."""
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return license_scan.digest(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, compression figures and the verdict of every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.measure(docs, quality_rules.fit_bands(docs, _table(spark, sf_dir, "labels")))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output, and of conversation -1."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digest(turns.unionByName(spark.sql(chat_format.EXTRA)))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix at weights 5, 2, 1 takes of every document."""
    return mixing.Mix(_table(spark, sf_dir, "documents"), texts=False).report()


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document's ids stand in the files written for this, and their checksum."""
    return token_files.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_tokenizer_path(), end_id=0)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of every language of documents."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the texts of benchmark."""
    out = importance.resample(_table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_html_extraction": op2_html_extraction,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scans": op6_secret_scans,
    "op7_license_scans": op7_license_scans,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_mixing": op10_mixing,
    "op11_token_files": op11_token_files,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_importance_resampling": op13_importance_resampling,
}

#: DuckDB's twins where SQL can express the operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": ngram_join.SQL,
    "op3_embedding_near_dedup": embedding_dedup.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op9_chat_formatting": chat_format.SQL,
    "op12_phrase_collocations": collocations.SQL,
}
