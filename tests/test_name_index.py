"""The index of names against the distance of every name."""

import random

import numpy as np
import pytest

from rollcall.functions.similarity import substring_distance, substring_distances
from rollcall.operators import search
from rollcall.operators.name_index import NameIndex, cut_pieces


def words(r, n, letters="abcAB1 é"):
    return ["".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 9, 14]))) for _ in range(n)]


def test_distances_of_a_batch():
    r = random.Random(2)
    letters = "abAB \0é😀İ"
    pairs = [("".join(r.choice(letters) for _ in range(r.choice([0, 1, 5, 63, 64, 65, 130]))), "".join(r.choice(letters) for _ in range(r.choice([0, 1, 7, 64, 200])))) for _ in range(400)]
    pairs += [(pairs[0][0], p[1]) for p in pairs]
    got = substring_distances([p[0] for p in pairs], [p[1] for p in pairs])
    assert got == pytest.approx(np.array([substring_distance(*p) for p in pairs]), abs=1e-12)


def test_pieces_cover_the_query():
    r = random.Random(5)
    for _ in range(200):
        query = "".join(r.choice("abcd") for _ in range(r.randint(1, 15)))
        n = r.randint(1, len(query))
        total, pieces = cut_pieces(query, n, {g: r.randint(0, 9) for g in words(r, 40, "abcd")})
        assert "".join(pieces) == query and len(pieces) == n and all(pieces) and total >= 0


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    r = random.Random(9)
    names = sorted({*words(r, 900), *("common-prefix-" + w for w in words(r, 300))})
    frame = spark.createDataFrame([(n,) for n in [*names, None, ""]] * 2, "player_name string")
    folder = str(tmp_path_factory.mktemp("index"))
    NameIndex.write(frame, "player_name", folder)
    return names, frame, NameIndex.read(spark, folder)


@pytest.mark.parametrize("query", ["abc", "common-prefix-ab1", "AB1 é", "zzzz", "a", "common-prefiy-", "cab\0a"])
def test_no_near_name_is_lost(world, query):
    names, _, index = world
    for edits in (0, 1, 2, 4):
        want = {n for n in [*names, ""] if round(substring_distance(query, n) * len(query)) <= edits}
        assert {r.name for r in index.near(query, edits).collect()} == want


def test_rare_pieces_leave_names_out(world):
    names, _, index = world
    assert index.candidates("common-prefix-ab1", 0).count() < len(names) / 10
    assert index.candidates("common-prefix-ab1", 1).count() < len(names) / 3


@pytest.mark.parametrize("query", ["abc", "common-prefix-ab1", "AB1 é", "zzzz", "ab"])
def test_searches_are_as_without(world, query):
    _, frame, index = world
    one = frame.where("player_name is not null").distinct()
    rows = lambda df: [tuple(r) for r in df.collect()]
    assert rows(search.autocomplete(one, "player_name", query, index=index)) == rows(search.autocomplete(one, "player_name", query))
    seen = frame.where("player_name is not null").selectExpr("player_name as ocr_name", "'v' as video_id", "90 as timestamp", "1 as score_")
    assert rows(search.search_ocr(seen, query, names=index)) == rows(search.search_ocr(seen, query))


def test_built_in_the_session(spark):
    names = spark.createDataFrame([("Anna",), ("Hanna",), ("Otto",)], "n string")
    assert sorted(r.name for r in NameIndex.build(names, "n").near("anna", 0).collect()) == ["Anna", "Hanna"]
    empty = NameIndex.build(names.limit(0), "n")
    assert empty.nearest("anna", 0.4, 3).collect() == []
