"""Scalar rules against plain Python versions."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions import text as T


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def gamertag(text):
    if not text:
        return False
    text = text.strip()
    if any(w in text.lower() for w in T.STOP_WORDS):
        return False
    clean = re.sub(r"[^A-Za-z0-9_\-\[\]()]", "", text)
    return 3 <= len(clean) <= 24 and not clean.isdigit() and not clean[:-1].isdigit()


NAMES = {"abc": True, "ab": False, "a" * 24: True, "a" * 25: False, "Spectators: 4": False, "MyUnits1": False, "59": False, "123": False, "123k": False, "12ab": True, "___": True, "中中中": False, None: False, "": False, " abc ": True}


def test_gamertag_fixtures(spark):
    assert column(spark, list(NAMES), T.is_gamertag) == list(NAMES.values()) == [gamertag(n) for n in NAMES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=200, max_size=200))
def test_gamertag_and_strips_equal_python(spark, values):
    spaces = re.compile(r"^\s+|\s+$")
    ascii_only = [re.sub(r"[\x1c-\x1f\x85]", "", v) for v in values]  # Python counts these as white space, Unicode's property doesn't
    assert column(spark, ascii_only, T.is_gamertag) == [gamertag(v) for v in ascii_only]
    assert column(spark, ascii_only, T.strip) == [spaces.sub("", v) for v in ascii_only]


def test_leading_junk(spark):
    assert column(spark, ["12 中abc", "7 x", "abc", "123", None], T.strip_leading_junk) == ["abc", "x", "abc", "", None]


def test_frame_names(spark):
    names = ["bO4_D_90s.png", "x.png", "a_1s.png", "_5s.png", "a_90s.jpg"]
    assert column(spark, names, T.is_frame) == [True, False, True, True, False]
    assert column(spark, names[:1], T.frame_video) == ["bO4_D"]
    assert column(spark, names, T.frame_second) == [90, None, 1, 5, None]
    assert column(spark, [" a_b_90s.png", "plain"], T.strip_frame_suffix) == ["a_b", "plain"]


def test_clan_tag(spark):
    out = column(spark, ["[ABC] name", "{x)y*", "none", "[]x", "(t)  a b"], T.split_clan_tag)
    assert [(r.name, r.tag) for r in out] == [("name", "[ABC]"), ("y", "[x]"), ("none", None), ("[]x", None), ("a b", "[t]")]


def test_dates(spark):
    assert [str(d) for d in column(spark, ["20240105", "2024115", "N/A", None, "20241399", ""], T.upload_day)] == ["2024-01-05", "None", "None", "None", "None", "None"]
    assert [str(d) for d in column(spark, ["2024-06-01T10:00:00.000Z", "2024-06-01T10:00:00Z", "bad", None], T.battle_day)] == ["2024-06-01", "2024-06-01", "None", "None"]
    assert column(spark, ["20240105", "N/A", None], T.display_date) == ["Fri Jan 05 2024", "N/A", None]
    assert column(spark, [90, 4505, 0], T.minutes_seconds, "int") == ["1:30", "75:05", "0:00"]


@pytest.mark.parametrize(("raw", "want"), [(" a b+c~!'()/é ", "a%20b%2Bc~!'()%2F%C3%A9"), ("x*y", "x*y")])
def test_encode_component(spark, raw, want):
    assert column(spark, [raw], T.encode_component) == [want]


def test_defaults_and_marks(spark):
    assert column(spark, ["", None, "x"], lambda c: T.or_default(c, "d")) == ["d", "d", "x"]
    assert column(spark, [["a"], ["x(AI)"], ["x(Al)", None], [None], [], None], T.has_ai_mark, "array<string>") == [False, True, True, False, False, False]
    assert column(spark, [["a", "", None, "a"], None], lambda c: F.size(T.distinct_names(c)), "array<string>") == [1, 0]
    assert column(spark, [{"a": "1"}, {}], T.header_text, "map<string,string>") == ["a: 1\r\n", ""]
    assert column(spark, [0.125, 92.855], T.rounded_score, "double") == [0.12, 92.86]
