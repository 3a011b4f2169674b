"""The registry, with and without the optional part; every query of the engine against its SQL twin."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from rollcall.plans.queries import ORACLE_SQL, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def told(v):
    return f"{v:.6g}" if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    if name not in ORACLE_SQL:
        assert got
        return
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(told(r[c]) for c in columns) for r in got) == sorted(tuple(map(told, r)) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_optional_part(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.plans.QUERIES), set(e.oracle_sql()) <= set(e.queries()))"], cwd=copy, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.stdout.split() == ["True", "True"], said.stderr


def test_nothing_else_imports_the_optional_part():
    for top, _, files in os.walk(os.path.join(ROOT, "rollcall")):
        if os.sep + "llm" not in top:
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(top, f)) as own:
                        assert "llm" not in own.read(), f
