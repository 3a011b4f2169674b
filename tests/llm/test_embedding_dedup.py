import math

import numpy as np
import pytest

from rollcall.llm import embedding_dedup as ed


def corpus(seed):
    r = np.random.default_rng(seed)
    rows = []
    base = r.normal(size=(12, 16))
    for i in range(220):
        kind = r.integers(5)
        v = r.normal(size=16) if kind == 0 else base[r.integers(12)] + r.normal(size=16) * r.choice([0, 0.02, 0.08, 0.15])
        if kind == 4:
            v = base[0] + r.normal(size=16) * 0.01
        rows.append((i, [float(np.float32(x * r.choice([1, 3]))) for x in v], int(r.choice([1, 1, 2]))))
    rows += [(300 + i, rows[0][1], 1) for i in range(9)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [float("nan")] * 16, 1), (404, [None] * 16, 1), (405, [float("inf"), *[1.0] * 15], 1), (406, rows[0][1], None), (407, [1.0] * 8, 1), (408, [1.0] * 8, 1), (409, [1e30] * 16, 2), (410, [2e30] * 16, 2)]
    rows += [(5, rows[6][1], rows[6][2]), (5, rows[6][1], rows[6][2])]
    return rows


def brute(rows, cosine):
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    up, links = list(range(n)), [0] * n

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if sound(v) else None for _, v, _ in rows]
    for i in range(n):
        for j in range(i):
            if rows[i][2] is not None and rows[i][2] == rows[j][2] and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    small = {}
    for i in range(n):
        small[root(i)] = min(small.get(root(i), 10**9), rows[i][0])
    return sorted((rows[i][0], links[i], small[root(i)], rows[i][0] == small[root(i)]) for i in range(n))


@pytest.mark.parametrize(("cell", "chunk", "kind"), [(2000, 2048, "float"), (20, 7, "float"), (9, 20, "double")])
def test_equals_brute_force(spark, cell, chunk, kind, monkeypatch):
    monkeypatch.setattr(ed, "CELL", cell)
    monkeypatch.setattr(ed, "SPLIT", 5)
    monkeypatch.setattr(ed, "CHUNK", chunk)
    monkeypatch.setattr(ed, "GUESTS", 2 * chunk)
    rows = corpus(cell)
    vectors = spark.createDataFrame([(*x, "x", 3) for x in rows], f"vec_id long, embedding array<{kind}>, label int, home string, id int").repartition(3)
    out = ed.near_duplicates(vectors, 0.93)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, out.collect())) == brute(rows, 0.93)


def test_empty(spark):
    assert ed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_doubles_aren_t_rounded_and_null_ids_stay(spark):
    """Two cosines that float32 can't tell from the threshold, and rows without an id."""
    c = 0.93
    near, far = c + 1e-12, c - 1e-12
    rows = [(i, [k, math.sqrt(1 - k * k), 0.0] if i % 2 else [1.0, 0.0, 0.0], label) for i, k, label in [(0, 0, 1), (1, near, 1), (2, 0, 2), (3, far, 2), (None, 0, 3)] for i in [i if i is not None else 4]]
    rows[4] = (None, [1.0, 0.0, 0.0], 3)
    out = ed.near_duplicates(spark.createDataFrame([*rows, (None, [2.0, 0.0, 0.0], 3)], "vec_id long, embedding array<double>, label int"), c)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True), (3, 0, 3, True), (None, 1, None, True), (None, 1, None, True)], key=str)
