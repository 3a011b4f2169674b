import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

from rollcall.llm import mixing
from rollcall.llm.mixing import Mix, permute, shard_counts, targets


def test_targets_share_the_excess_until_none_is_above():
    sizes = [("b", 10), ("a", 1000), (None, 7), ("c", 500), ("é", 0)]
    found = targets(sizes)
    # order a b c é null, weights 5 2 1 5 2; b, null and é stop at twice their size
    assert found["b"] == 20 and found[None] == 14 and found["é"] == 0
    assert sum(found.values()) == Fraction(3, 2) * 1517
    assert found["a"] == 5 * found["c"]
    assert all(found[s] <= 2 * n for s, n in sizes)
    assert targets([]) == {}


def test_permutation_and_counts():
    for n in (1, 2, 3, 17, 256, 1000):
        assert sorted(permute(np.arange(n), n, 99)) == list(range(n))
    assert permute(np.arange(1000), 1000, 1).tolist() != permute(np.arange(1000), 1000, 2).tolist()
    counts = shard_counts([1000, 50, 0, 3], 7, 1)
    assert counts.sum(axis=0).tolist() == [1000, 50, 0, 3] and set(counts.sum(axis=1)) <= {150, 151}
    assert counts.tolist() == shard_counts([1000, 50, 0, 3], 7, 1).tolist()


def corpus():
    r = random.Random(8)
    rows = [(i, None if i % 11 == 0 else " \n".join(f"d{i}w{j}" for j in range(r.choice([0, 1, 5, 40, 300, 2000]))), r.choice(["a", "a", "a", "b", "c", "D", None])) for i in range(150)]
    return [*rows, (7, "other text here", "a"), (7, "other text here", "a"), (None, "no id at all", "b")]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_DOCS", 20)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 10_000)
    rows = corpus()
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, source string, size int").repartition(3)
    m = Mix(docs, block_words=16)
    report = m.report().collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in report) == sorted((i is None, i or 0, len((t or "").split())) for i, t, _ in rows)
    assert sorted(report, key=str) == sorted(Mix(docs.repartition(2), block_words=16).report().collect(), key=str)
    sums = Counter()
    for _, t, s in rows:
        sums[s] += len((t or "").split())
    want = targets(list(sums.items()))
    # What a row says is that of its source; the three rows of doc_id 7 aren't of one source each.
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    taken = defaultdict(int)
    for r in report:
        s = source[r.doc_id, r.size]
        assert r.taken <= 2 * r.size and r.target == float(want[s]) and r.source_size == sums[s]
        taken[s] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= 60 + want[s] / 100  # tails of groups are short blocks
    made = m.documents()
    assert made.columns == docs.columns
    own = {(i, w) for i, t, _ in rows for w in (t or "").split()}
    words, told = Counter(), Counter()
    for r in made.collect():
        words[r.doc_id] += len(r.text.split())
        assert all((r.doc_id, w) in own for w in r.text.split())
    for r in report:
        told[r.doc_id] += r.taken
    assert +words == +told


def test_repeated_rows_count_and_are_drawn_each(spark):
    rows = [(1, "a b c d", "s")] * 3 + [(2, "e f", "s")]
    docs = spark.createDataFrame([(*x, 4, "z") for x in rows], "doc_id long, text string, source string, row int, spans string")
    m = Mix(docs, block_words=1)
    report = sorted(map(tuple, m.report().collect()))
    assert [(r[0], r[1], r[2], r[3]) for r in report] == [(1, 4, 14, 21.0)] * 3 + [(2, 2, 14, 21.0)]
    assert sum(r[4] for r in report) == 21 and all(r[1] <= r[4] <= 2 * r[1] for r in report)  # 1.5 times: every word once, half of them twice
    made = m.documents()
    assert made.columns == docs.columns
    words = Counter(w for r in made.collect() for w in r.text.split())
    assert sum(words.values()) == 21 and all(3 <= words[w] <= 6 for w in "abcd") and all(1 <= words[w] <= 2 for w in "ef")
    assert all(r.row == 4 and r.spans == "z" for r in made.collect())


def test_every_block_is_drawn_as_often_as_its_epochs(spark):
    """Brute force over blocks: with one word a block, all words are drawn floor or ceil of target / size times."""
    r = random.Random(3)
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(r.randint(1, 30))), r.choice("abcd")) for i in range(60)]
    m = Mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), block_words=1)
    sums = Counter()
    for _, t, s in rows:
        sums[s] += len(t.split())
    goal = targets(list(sums.items()))
    words = Counter(w for x in m.documents().collect() for w in x.text.split())
    for s in "abcd":
        own = [words[w] for _, t, s2 in rows if s2 == s for w in t.split()]
        assert sum(own) == round(goal[s]) and max(own) - min(own) <= 1


def test_empty(spark):
    m = Mix(spark.createDataFrame([], "doc_id long, text string, source string"))
    assert m.report().collect() == [] and m.documents().collect() == []
    m = Mix(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string"))
    assert [tuple(r) for r in m.report().collect()] == [(1, 0, 0, 0.0, 0)]
