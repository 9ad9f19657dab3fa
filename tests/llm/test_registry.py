import duckdb
import pytest

from colloquy.llm import registry

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    assert got == sorted(con.sql(f"select {', '.join(cols)} from ({registry.SQL[name]})").fetchall())
    assert sorted(con.sql(registry.SQL[name]).columns) == cols


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
