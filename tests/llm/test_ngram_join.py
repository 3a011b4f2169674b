import random
import re

import numpy as np
import pytest

from rollcall.llm import components
from rollcall.llm import ngram_join as nj
from rollcall.llm.ngram_join import heap_merge, jaccard_components, keep_one, links


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((root(i), root(j)))
                up[q] = p
    return sorted((i, len(a), root(i)) for i, a in sets)


def corpus(seed, n=120):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(3, 90))] for _ in range(n // 4)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(n):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        if r.random() < 0.2:
            words += passage
        rows.append(" ".join(words))
    rows += [None, "", " \n\t", "one", "ONE", "one two", "É é x y z é", "é É x y z é", "x" * 50_000, "y " * 20_000]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("cap", [400_000, 3_000])
def test_equals_brute_force(spark, cap, monkeypatch):
    monkeypatch.setattr(components, "LAST_EDGES", 5 if cap == 3_000 else 16_000)
    monkeypatch.setattr(nj, "CELL_SHINGLES", cap)
    rows = corpus(cap)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, cell string").repartition(3)
    assert sorted(map(tuple, jaccard_components(docs).collect())) == brute(rows)


def test_group_of_near_copies_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "CELL_SHINGLES", 2_000)
    r = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        words[r.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[i : i + 48])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs).collect())) == brute(rows)


def test_empty_repeated_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(empty).collect() == []
    docs = spark.createDataFrame([(2, "a b c d e f"), (2, "zz"), (1, "A b c d e f"), (None, "a b c d e f"), (7, "zz")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == [(1, 2, 1), (2, 1, 2), (2, 2, 1), (7, 1, 2), (None, 2, 1)]
    assert sorted(map(tuple, keep_one(docs).collect())) == [(1, "A b c d e f"), (2, "zz")]
    rows = [(None, "a b c d e f", 1, "c"), (None, "a b c d e f", 1, "c"), (3, None, 2, "c"), (3, None, 2, "c"), (4, "q r s t u", 3, "c"), (4, "q r s t u", 3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ROW int, component string")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(3, None, 2, "c"), (3, None, 2, "c"), (4, "q r s t u", 3, "c"), (None, "a b c d e f", 1, "c")]
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == [(3, 0, 3), (3, 0, 3), (4, 1, 4), (4, 1, 4), (None, 2, None), (None, 2, None)]


def passages(n, seed, near=0):
    """Documents of ten passages that about five documents share each: one large cell, next to no links."""
    r = random.Random(seed)
    made = [" ".join(f"p{i}x{r.randrange(10**6)}" for _ in range(30)) for i in range(2 * n)]
    rows = [(i, " ".join(r.sample(made, 10))) for i in range(n)]
    return rows + [(n + i, rows[i][1].replace("x1", f"y{i}", 3)) for i in range(near)]


def test_shared_passages_without_near_copies(spark, monkeypatch):
    monkeypatch.setattr(nj, "CELL_SHINGLES", 20_000)
    rows = passages(200, 3, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs).collect())) == brute(rows)


def test_heap_merge(monkeypatch):
    r = random.Random(1)
    for _ in range(200):
        lists = [sorted(r.sample(range(40), r.randint(0, 20))) for _ in range(r.randint(1, 8))]
        for least in (1, 2, 4):
            expected = [(v, n) for v in range(40) if (n := sum(v in own for own in lists)) >= least]
            for window in (1, 7, 256):
                monkeypatch.setattr(nj, "WINDOW", window)
                found, counts = heap_merge([np.array(x, np.int64) for x in lists], least)
                assert list(zip(found.tolist(), counts.tolist(), strict=True)) == expected


def test_links_give_the_components_of_all_pairs():
    r = random.Random(2)
    for _ in range(30):
        sets = [np.array(sorted(r.sample(range(30), r.randint(4, 20))), np.uint64) for _ in range(40)]
        pairs = links(np.arange(40), np.array([len(s) for s in sets]), sets, 75)
        up = list(range(40))

        def root(i, up=up):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in pairs:
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            assert 100 * len(x & y) >= 75 * len(x | y)
            up[max(root(a), root(b))] = min(root(a), root(b))
        for a in range(40):
            for b in range(a):
                x, y = set(sets[a].tolist()), set(sets[b].tolist())
                if 100 * len(x & y) >= 75 * len(x | y):
                    assert root(a) == root(b)
