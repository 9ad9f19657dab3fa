import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

#: 100 times these floats lies just below a whole number, to which a product in floats is rounded.
EDGES = np.array([0.36, -0.37], np.float32)
EDGES = np.where(np.floor(EDGES * np.float32(100)) == np.floor(EDGES.astype(float) * 100), np.nextafter(EDGES, np.float32(-1)), EDGES)


@pytest.mark.parametrize("name", ["assemble_codes", "pad_streams"])
def test_codes_of_edges_equal_the_sql(spark, tmp_path, name):
    assert (np.floor(EDGES * np.float32(100)) != np.floor(EDGES.astype(float) * 100)).all()
    spark.createDataFrame([(k, EDGES.tolist(), 0) for k in range(4)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = entry.queries()[name](spark, str(tmp_path))
    got = sorted(tuple(r) for r in rows.collect())
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == sorted(con.sql(f"select {', '.join(rows.columns)} from ({entry.oracle_sql()[name]})").fetchall()) and got
