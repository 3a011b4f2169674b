from collections import Counter, defaultdict

import duckdb
import pandas as pd

from rollcall.llm import line_dedup
from rollcall.llm.line_dedup import SQL, drop_boilerplate


def brute(rows, ratio=0.1, least=5):
    pages, on = Counter(), defaultdict(Counter)
    strip = lambda x: x.strip(" \t\r\x0b\x0c")
    for s, t in {(s, t) for _, t, s in rows}:
        pages[s] += 1
        for x in {strip(x) for x in (t or "").split("\n")} - {""}:
            on[s][x] += 1
    out = []
    for i, t, s in rows:
        lines = (t or "").split("\n")
        gone = [on[s][strip(x)] >= least and on[s][strip(x)] > ratio * pages[s] for x in lines]
        n = sum(strip(x) != "" for x in lines)
        out.append((i, s, None if t is None else "\n".join(x for x, g in zip(lines, gone) if not g), n, sum(gone)))
    return sorted(out, key=str)


def corpus():
    rows = []
    for i in range(60):
        s = ["a", "b", None][i % 3]
        lines = [f"own {i}", " menu ", "", f"own {i}", "menu"] if i % 2 else [f"x {i}", "   ", "rare" if i < 3 else "y"]
        rows.append((i, "\n".join(lines), s))
    return [*rows, (60, None, "a"), (60, None, "a"), (61, "", "b"), (62, "\n\n", None), (63, "menu", "a"), (64, "z" * 100_000 + "\nmenu\n", "a"), (65, "menu", "single"), (66, "a\r\nmenu\r\n", "a"), *[(70 + i, f"copy one\ncopy two {i % 2}\ncopy three", "a") for i in range(12)]]


def test_equals_brute_force_and_sql(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, s, 9, 8) for i, t, s in rows], "doc_id long, text string, source string, n_dropped int, lines int")
    out = drop_boilerplate(docs, counts=True)
    assert out.columns == ["doc_id", "text", "source", "n_dropped", "lines", "n_lines"]
    got = sorted(map(tuple, out.select("doc_id", "source", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == brute(rows)
    assert drop_boilerplate(docs).columns == docs.columns
    c = duckdb.connect()
    c.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype(object).where(lambda d: d.notna(), None))
    assert sorted(c.execute(SQL).fetchall(), key=str) == brute(rows)


def test_native_plan_and_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    out = drop_boilerplate(docs)
    assert out.collect() == []
    assert not any(k in out._jdf.queryExecution().toString() for k in ("Python", "Pandas", "Arrow"))


def test_every_line_above_the_ratio_goes(spark):
    """However much of a page its boilerplate is: 20 pages that are mostly one long shared line lose it."""
    rows = [(i, "the long line that all pages of this host have in common with each other\n%d" % i, "h") for i in range(20)]
    out = drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), counts=True).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out) == [(i, str(i), 2, 1) for i in range(20)]


def test_copies_are_one_page_and_clashing_columns_stay(spark, monkeypatch):
    rows = [(i, "same one\nsame two", "h", i, "a", "b", "c", "d") for i in range(30)] + [(100 + i, f"own {i}", "h", 0, "a", "b", "c", "d") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, told int, known string, h string, SALT string, host string")
    for limit in (1_000_000, -1):
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
        out = drop_boilerplate(docs)
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(rows)
        got = sorted(map(tuple, drop_boilerplate(spark.createDataFrame(corpus(), "doc_id long, text string, source string"), counts=True).select("doc_id", "source", "text", "n_lines", "n_dropped").collect()), key=str)
        assert got == brute(corpus())
