import math
import random
import re
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from rollcall.llm import quality_rules as qr


SYLLABLES = [a + b + c for a in "bdfgklmnprstv" for b in "aeiou" for c in ["", "n", "st"]] + ["é", "über"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i, t in enumerate(zip(words, words[1:], words[2:])) if triples[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words)


def prose(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def rows():
    r = random.Random(3)
    texts = [None, "", " \n\n ", "a b c a b c", "# | é\n# | é\n\n \n", "word " * 3000, "x" * 200_000, prose(r, 30)]
    texts += [prose(r, n) for n in (60, 200, 900, 4000)]
    texts += ["\n".join([prose(r, 80)] * 2), "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ") for _ in range(9000))]
    return texts


def test_counts_equal_brute_force_and_bands_judge(spark):
    texts = rows()
    docs = spark.createDataFrame([(i, t, "x", True) for i, t in enumerate(texts)], "doc_id long, text string, source string, kept boolean")
    found = {r.doc_id: r for r in qr.measure(docs).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), i
    assert [found[i].kept for i in range(len(texts))] == [False] * 8 + [True] * 4 + [False] * 2
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [8, 9, 10, 11]


def test_empty_and_null_columns(spark):
    assert qr.measure(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert qr.measure(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()[0].kept is False


def test_bands_follow_sound_texts(spark, monkeypatch):
    monkeypatch.setattr(qr, "CLASS_ROWS", 30)
    r = random.Random(5)
    texts = [prose(r, r.randint(60, 150)) for _ in range(120)] + [None, "short"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))] + [(None, 1, 0), (500, 0, 1)], "doc_id long, quality int, toxic int")
    bands = qr.fit_bands(docs, labels)
    assert [b[0] for b in bands.bands] == [b[0] for b in qr.BANDS] and any(a != b for a, b in zip(bands.bands, qr.BANDS))
    assert all(low >= base_low and high <= base_high for (_, low, high), (_, base_low, base_high) in zip(bands.bands, qr.BANDS))
    assert qr.measure(docs, bands).where("not base_failed and not kept").isEmpty()
    assert qr.fit_bands(docs, labels.limit(0)) == qr.WIDEST
    assert qr.fit_bands(docs.repartition(5), labels) == bands


def test_chunks_catch_an_encoded_and_a_repeated_part(spark):
    r = random.Random(8)
    encoded = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    passage = prose(r, 130)
    sound = [prose(r, n) for n in (250, 310, 350, 450, 2000, 4000)]
    junk = [t + " " + encoded(len(t)) for t in sound] + [prose(r, 2000) + "\n" + " ".join([passage] * 9)]
    docs = spark.createDataFrame(list(enumerate(sound + junk)), "doc_id long, text string")
    found = {x.doc_id: x for x in qr.measure(docs).collect()}
    assert not any(x.base_failed for x in found.values())
    assert [found[i].kept for i in range(len(found))] == [True] * len(sound) + [False] * len(junk)
    assert all(found[i].bad_chunks >= qr.BAD_CHUNKS for i in range(len(sound), len(found)))


def test_sparse_and_absent_classes_follow_their_neighbours(spark):
    r = random.Random(9)
    texts = [prose(r, r.randint(60, 150)) for _ in range(250)] + [prose(r, 2500) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id long, quality int")
    bands = qr.fit_bands(docs, labels)
    width = [high - low for _, low, high in bands.bands]
    assert all(w < high - low - 0.3 for w, (_, low, high) in zip(width[1:], qr.BANDS[1:]))  # the 3 long texts' lengths and those without any too
    assert qr.measure(docs, bands).where("not kept").count() <= 2
    few = qr.fit_bands(docs, labels.where("doc_id < 20")).bands
    assert all(base_low <= low <= fit_low and fit_high <= high <= base_high for (_, low, high), (_, fit_low, fit_high), (_, base_low, base_high) in zip(few[2:3], bands.bands[2:3], qr.BANDS[2:3]))
    assert few[2] != qr.BANDS[2]


def brute_verdict(text, limits):
    """Both bands again, with limits found by a loop."""
    raw = text.encode()
    ratio = lambda b: len(b) / len(zstandard.compress(b, 3))
    low, high = limits.bands[0][1:] if len(raw) < limits.bands[0][0] else limits.bands[-1][1:]
    for (a, la, ha), (b, lb, hb) in zip(limits.bands, limits.bands[1:]):
        if a <= len(raw) <= b:
            f = math.log(len(raw) / a) / math.log(b / a)
            low, high = la + f * (lb - la), ha + f * (hb - ha)
    bad = [False]
    if len(raw) > 2048:
        parts = [raw[i : i + 2048] if i + 2048 <= len(raw) else raw[-2048:] for i in range(0, len(raw), 2048)]
        bad = [not limits.chunk[0] <= ratio(c) <= limits.chunk[1] for c in parts]
    return not brute(text)[5] and low - 1e-9 <= ratio(raw) <= high + 1e-9 and sum(bad) < 0.3 * len(bad)


def test_verdicts_equal_brute_force(spark):
    """On the documents of the smallest test table, with limits fitted there."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    limits = qr.fit_bands(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = qr.measure(docs, limits).collect()
    assert all(r.kept == (texts[r.doc_id] is not None and brute_verdict(texts[r.doc_id], limits)) for r in found)
    assert {r.kept for r in found} == {True, False}


def test_limits_come_from_all_sound_texts(spark):
    """More sound ids than any sample held: each counts, and those of repeated ids and labels once a row."""
    n = 100_300
    words = F.concat_ws(" ", *[F.substring(F.sha1(F.concat("id", F.lit(f" {j}"))), 1, 6) for j in range(50)])
    docs = spark.range(n, numPartitions=8).select(F.col("id").alias("doc_id"), words.alias("text"))
    docs = docs.unionByName(docs.where("doc_id < 2")).unionByName(spark.createDataFrame([(n, "short"), (None, "short"), (n + 1, prose(random.Random(4), 90))], "doc_id long, text string"))
    labels = spark.range(n + 1).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels = labels.unionByName(labels.where("doc_id < 5")).unionByName(spark.createDataFrame([(n + 1, 0), (None, 1)], "doc_id long, quality int"))
    rows = qr._sound_counts(docs, labels)
    assert sum(r["n"] for r in rows) == n + 2 and all(r["size"] >= 0 for r in rows)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, prose(random.Random(4), 90), "k", 3, 4.0), (2, None, "k", 3, 4.0)], "doc_id long, text string, kept string, n_words int, ratio double")
    labels = spark.createDataFrame([(1, 1, "x")], "doc_id long, quality int, size string")
    limits = qr.fit_bands(docs, labels)
    assert sorted((r.doc_id, r.n_words, r.kept) for r in qr.measure(docs, limits).select("doc_id", "n_words", "kept").collect()) == [(1, 90, True), (2, 0, False)]
    kept = qr.keep_good(docs, limits).collect()
    assert [(r.doc_id, r.kept, r.n_words, r.ratio) for r in kept] == [(1, "k", 3, 4.0)]
