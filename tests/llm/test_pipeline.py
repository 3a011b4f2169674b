"""The pipeline against brute-force versions of its stages, each on what the stage before it kept."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_ngram_join import brute as brute_near
from test_packing import brute as brute_ids
from test_quality_rules import brute as brute_quality

import corpus_pipeline
from rollcall.llm import mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, SF))
        if name != "pack":
            assert docs.columns == columns
        out.append(docs.collect())
    return out


def test_quality_keeps_no_failed_document_and_no_change(stages):
    before, kept = {r.doc_id: r for r in stages[0]}, {r.doc_id: r for r in stages[1]}
    assert all(before[i] == r and not brute_quality(r.text)[5] for i, r in kept.items())
    assert len(kept) > 0.6 * len(before)


def test_lines(stages):
    want = {i: text for i, _, text, _, _ in brute_lines([(r.doc_id, r.text, r.source) for r in stages[1]])}
    assert {r.doc_id: r.text for r in stages[2]} == want
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_one_of_each_group_stays(stages):
    want = {i for i, _, c in brute_near([(r.doc_id, r.text) for r in stages[2]]) if i == c}
    assert {r.doc_id for r in stages[3]} == want


def test_mix_nears_the_targets(stages):
    size, taken, own = defaultdict(int), defaultdict(int), {r.doc_id: r.text.split() for r in stages[3]}
    for r in stages[3]:
        size[r.source] += len(r.text.split())
    words = defaultdict(int)
    for r in stages[4]:
        n = len(r.text.split())
        taken[r.source] += n
        words[r.doc_id] += n
        assert n and set(r.text.split()) <= set(own[r.doc_id]) and r.n_chars == len(r.text)
    assert all(n <= 2 * len(own[i]) for i, n in words.items())
    for s, t in mixing.targets(list(size.items())).items():
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS + t / 50


def test_pack_holds_every_id_once(stages):
    ids = brute_ids([r.text for r in stages[4]])
    want = sorted((stages[4][i].doc_id, len(x)) for i, x in ids.items())
    starts = [(r.doc_id, r.doc_tokens) for r in stages[5] if r.start == 0]
    assert sorted(starts) == want
    assert sum(r.length for r in stages[5]) == sum(len(x) for x in ids.values())


def test_run(spark, stages):
    made = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in made) == sum(r.length for r in stages[5])


@pytest.mark.parametrize("empty", [True, False])
def test_empty_tables_and_clashing_columns(spark, empty):
    """Columns named as the stages name their own stay, with their values; an empty table stays empty."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = ["row", "Size", "told", "known", "h", "epoch", "shard", "spans", "component_id", "n_words", "kept", "cell", "key"]
    docs = docs.select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in more))
    docs = docs.limit(0) if empty else docs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, SF))
        assert docs.columns == columns, name
        assert docs.where(" or ".join(f"`{c}` <> concat('{c} ', doc_id)" for c in more)).isEmpty(), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.isEmpty() == empty and len(packed.columns) == 7
