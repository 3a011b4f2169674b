"""Every query with a SQL twin against DuckDB on the smallest test tables."""

import duckdb
import pytest

from rollcall.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_twin(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str) == sorted(want.fetchall(), key=str)
