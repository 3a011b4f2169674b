import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import _text, collocations
from rollcall.llm.collocations import Bits, Block, Sketch, blocks, collocations as mine, plain, score_counts


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", low)]


def counted(rows):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        for ws in pieces(text):
            n[lang or "und"] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang or "und"][tuple(ws[i : i + k])] += 1
    return n, f


def brute(rows, least, top=2000):
    n, f = counted(rows)
    out = []
    for lang, own in f.items():
        often = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + m] for p, a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 100 * often[p[i : i + m]]}
        best = []
        for p, a in often.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def texts():
    r = random.Random(8)
    words = ["the", "The", "of", "a", "New", "York", "é", "É", "中文", "x\x00y", "\xa0", " b", "don't", "😀", "q" * 90]
    out = [(None, "en"), ("", "en"), (" \t\n", None), ("one", "fr"), ("a a a a a a a a a", "en"), ("new york city hall. " * 9, None), ("new\tyork  city\rhall\x0bx\x0c", "und")]
    for _ in range(200):
        n = r.choice([1, 4, 30, 90])
        out.append(("".join(r.choice(words[: r.choice([4, 9, 15])]) + r.choice([" ", " ", "  ", "\t", ", ", ".", " ; "]) for _ in range(n)), r.choice(["en", "en", "fr", None])))
    return out + [("of the New York " * 20 + "\n", "en")] * 7


@pytest.mark.parametrize(("least", "phrases"), [(3, 50_000), (3, 40), (12, 7), (300, 50)])
def test_brute_force(spark, monkeypatch, least, phrases):
    """Many automata; repeated rows; null languages; clashing columns."""
    monkeypatch.setattr(collocations, "AUTOMATON_PHRASES", phrases)
    own = texts()
    docs = spark.createDataFrame([(t, x, 1, "w") for t, x in own], "text string, lang string, a int, word string").repartition(3)
    got = mine(docs, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(own, least)


def test_long_text(spark):
    own = [("the cat sat on the mat " * 210_000, "en"), ("the cat", "en")]
    docs = spark.createDataFrame(own, "text string, lang string")
    assert sorted(tuple(r) for r in mine(docs).collect()) == brute(own, 100)


def test_slices_count_each_phrase_once(monkeypatch):
    monkeypatch.setattr(_text, "STEP_BYTES", 40)
    own = [t for t in texts() if t[0]]
    n = Counter()
    for b in blocks(pa.RecordBatch.from_arrays([pa.array([t[0] for t in own]), pa.array([t[1] or "und" for t in own])], ["text", "lang"])):
        for k in range(1, 6):
            whole = b.together(b.near, k)
            at = np.flatnonzero(whole & b.own[: len(whole)])
            n.update((b.langs[x], tuple(p.decode().split(" "))) for x, p in zip(b.lang[at].tolist(), b.phrases(at, k), strict=True))
    _, f = counted(own)
    assert n == Counter({(lang, p): a for lang, x in f.items() for p, a in x.items()})


def test_sketch_loses_nothing():
    r = np.random.default_rng(1)
    keys = (r.random(200_000) ** 3 * 3000).astype(np.uint64) ** np.uint64(2)
    sketch = Sketch(1 << 16, 70)
    for part in np.array_split(keys, 7):
        sketch.add(part)
    bits = Bits(np.packbits(sketch.counts.reshape(-1) >= 70, bitorder="little"), 1 << 16)
    distinct, n = np.unique(keys, return_counts=True)
    assert bits.reach(distinct[n >= 70]).all() and not bits.reach(distinct[n < 40]).all()
    assert sum(len(c) for _, c in sketch.slices()) == 2 << 16


def test_plain_and_block():
    assert plain(b"A  B\t\tc.D\r\nE") == b"a b c\nd\n\ne"
    b = Block([(b"a b\nc", 5, "en"), (b"", 0, "en"), (b"d e f", 3, "fr")])
    assert b.near.tolist() == [True, False, False, True, True] and b.own.tolist() == [True] * 5 + [False]


def test_large_numbers(spark):
    """Products of more than 64 bits are exact."""
    a, x, n = 10**13 + 7, 10**14 + 39, 3 * 10**14 + 1
    words = spark.createDataFrame([("en", "p", x), ("en", "q", x + 2), ("en", "r", n - 2 * x - 2)], "lang string, phrase string, f long")
    counts = spark.createDataFrame([("en", "p q", a)], "lang string, phrase string, a long")
    (row,) = score_counts(words, counts).collect()
    assert row.score == 1000 * a * n // (x * (x + 2)) and row.n == n


def test_empty(spark):
    assert mine(spark.createDataFrame([], "text string, lang string")).collect() == []
