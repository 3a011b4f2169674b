import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import _text, importance
from rollcall.llm.importance import draw, features, pack_postings, resample, unpack_postings

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(rows, target, percent=5, least=20, seed=42, buckets=10000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    own = [(i, *grams(t)) for i, t in rows]
    s, t = Counter(bucket(g) for _, _, gs in own for g in gs), Counter(bucket(g) for x in target for g in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, n, gs in own:
        weight = sum(gain(bucket(g)) for g in gs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranked = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted(((r[0], r[2], r[3], r[4], ranked.get(id(r))) for r in out), key=str)


def rows_of(frame):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect()), key=str)


def texts():
    r = random.Random(11)
    words = ["the", "The", "THE", "café", "É", "x1", "42", "don't", "a-b", "中文", "😀", "q" * 63, "q" * 64, "Q" * 65, "z" * 300, "_", "...", "\x00", "foo_bar"]
    return [None, "", " ", "...", "one", "one two", "a"] + [" ".join(r.choice(words[: r.choice([5, 19])]) for _ in range(r.choice([3, 19, 20, 21, 200]))) for _ in range(150)]


def test_crc_of_every_run():
    own = [t or "" for t in texts()]
    words, doc, crc = features(pa.array(own))
    got = Counter(zip(doc.tolist(), crc.tolist(), strict=True))
    assert got == Counter((i, zlib.crc32(g.encode())) for i, t in enumerate(own) for g in grams(t)[1])
    assert words.tolist() == [grams(t)[0] for t in own]


@pytest.mark.parametrize("big", [1, 300, 10**7])
def test_postings_round_trip(big):
    r = random.Random(big)
    for n_docs in (1, 7, 500):
        keys = sorted(r.sample(range(n_docs * 625), min(n_docs * 625, r.choice([1, 30, 600]))))
        bucket, doc = (np.array(x) for x in zip(*(divmod(k, n_docs) for k in keys), strict=True))
        count = np.array([r.randint(1, big) for _ in keys])
        got = unpack_postings(pack_postings(bucket, doc, count, n_docs))
        assert [x.tolist() for x in got[:3]] == [bucket.tolist(), doc.tolist(), count.tolist()] and got[3] == n_docs


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr(_text, "STEP_BYTES", 50)
    for text in [t for t in texts() if t and len(t.encode()) > 200]:
        words, bucket, doc, count = importance._counted(pa.array([text]), 1000)
        n, gs = grams(text)
        assert words.tolist() == [n] and not doc.any()
        assert dict(zip(bucket.tolist(), count.tolist(), strict=True)) == Counter(zlib.crc32(g.encode()) % 1000 for g in gs)


@pytest.mark.parametrize("group_bytes", [16 << 20, 3000])
def test_brute_force(spark, monkeypatch, group_bytes):
    """Null and repeated doc_ids and rows, a very long text, clashing columns; small groups are salted."""
    monkeypatch.setattr(importance, "GROUP_BYTES", group_bytes)
    own = [*texts(), "the café is 42 x1 " * 260_000]
    rows = [(None if i % 50 == 7 else i, t, 1, 2) for i, t in enumerate(own)] + [(500, own[-2], 1, 2)] * 3
    target = ["The cafe café the x1", None, "", "the the the 42 foo"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, g int, part int").repartition(3)
    other = spark.createDataFrame([(t, 3) for t in target], "text string, bucket int")
    assert rows_of(resample(docs, other, percent=30)) == brute([r[:2] for r in rows], target, percent=30)


def test_draw_keeps_columns(spark):
    rows = [(i, f"{w} " * 30, i) for i, w in enumerate(["good"] * 5 + ["bad"] * 95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Row long")
    got = draw(docs, spark.createDataFrame([("good good good good",)], "text string"))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_empty(spark):
    docs, none = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, docs).collect() == [] and rows_of(resample(none, none)) == []
    assert rows_of(resample(docs, none)) == brute([(1, "a b c")], [])
