"""Every registered query with an oracle gives the rows that DuckDB gives."""
import math
import os
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLE = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("op", "pipeline"))}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in pathlib.Path(DIR).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(([tuple(plain(r[c]) for c in cols) for r in df.collect()]), key=repr)
    rel = duck.sql(f"select {', '.join(cols)} from ({ORACLE[name]})")
    want = sorted(([tuple(map(plain, r)) for r in rel.fetchall()]), key=repr)
    assert sorted(duck.sql(ORACLE[name]).columns) == cols
    assert len(got) == len(want) and got == want, [(a, b) for a, b in zip(got, want) if a != b][:3]
    assert got
