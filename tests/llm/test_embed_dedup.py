import math

import numpy as np
import pyarrow as pa

from colloquy.llm import embed_dedup as E

VEC = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    n = len(rows)
    x = [None if v is None or l is None or any(c is None for c in v) else np.array(v, np.float32).astype(float) for _, v, l in rows]
    x = [None if v is None or not np.isfinite(v).all() or not v.any() else v for v in x]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if x[i] is None or x[j] is None or rows[i][2] != rows[j][2] or len(x[i]) != len(x[j]):
                continue
            if x[i] @ x[j] / math.sqrt(x[i] @ x[i]) / math.sqrt(x[j] @ x[j]) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], low[find(i)], low[find(i)] == rows[i][0]) for i in range(n))


def test_against_brute(spark):
    rnd = np.random.default_rng(4)
    rows = []
    for g in range(60):
        base = rnd.normal(size=24)
        for _ in range(int(rnd.integers(1, 5)) if g else 90):
            rows.append([(base + rnd.normal(size=24) * rnd.choice([0.0, 0.1, 0.25])).tolist(), int(g % 3)])
    rows += [[None, 1], [[0.0] * 24, 1], [[float("nan")] * 24, 1], [[None] + [1.0] * 23, 1], [rows[5][0], None], [[1e-30] * 24, 1], [[1e30] * 24, 1], [[1.0] * 8, 1], [[], 1]]
    rows = [(i * 3, v, l) for i, (v, l) in enumerate(rows)]
    got = E.dedup(spark.createDataFrame([(*r, 0) for r in rows] + [(None, rows[0][1], 0, 0)], VEC + ", bucket int"), tile=16).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = {r[0]: r for r in brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])}
    got = {r.vec_id: r for r in E.dedup(df).collect()}
    assert all(got[k].n_links <= want[k][1] for k in want)
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(w[1] for w in want.values())


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = E.hadamard(x)
    assert np.allclose(E.hadamard(y), x) and np.allclose((y**2).sum(1), (x**2).sum(1))
    b = E.buckets(x / np.linalg.norm(x, axis=1, keepdims=True), 8, 2)
    assert (E.buckets(-x / np.linalg.norm(x, axis=1, keepdims=True), 8, 2)[:, :, 0] != b[:, :, 0]).all()


def test_plan_keeps_recall():
    small, large = E.plan(1000, 64, 0.93), E.plan(10**7, 64, 0.93)
    assert small[0] == 2 and large[0] == 4 and large[1] > small[1]
    rnd = np.random.default_rng(11)
    a, b = rnd.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for hashes, tables in (small, E.plan(10**5, 64, 0.93)):
        p, q = E.buckets(a, tables, hashes), E.buckets(b, tables, hashes)
        assert (p[:, :, :, None] == q[:, :, None, :]).any((1, 2, 3)).mean() >= 0.99


def test_repeated_ids_with_unlike_vectors(spark):
    v, w = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    rows = [(1, v, 0), (1, w, 0), (2, [1.0, 2.0, 3.0, 4.1], 0), (3, [4.0, -3.0, 2.0, -1.1], 0), (3, [4.0, -3.0, 2.0, -1.1], 0)]
    got = sorted(map(tuple, E.dedup(spark.createDataFrame(rows, VEC)).collect()))
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]


def test_empty(spark):
    assert E.dedup(spark.createDataFrame([], VEC)).collect() == []


def test_low_cosines_and_long_vectors(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.normal(size=64).tolist(), i % 2) for i in range(240)]
    for cosine in (0.3, 0.05):
        assert E.plan(240, 64, cosine)[1] <= E.MOST_TABLES
    got = E.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=0.3).collect()
    want = brute(rows, 0.3)
    assert sum(r.n_links for r in got) >= 0.99 * sum(w[1] for w in want) > 0
    # a batch that one 32-bit array could not hold is cut
    plans = {1536: (2, 9)}
    x = rnd.normal(size=(300, 1536))
    batch = pa.RecordBatch.from_pydict({"uid": range(300), "label": ["a"] * 300, "n_vecs": [1] * 300, "vector": [v.tobytes() for v in x]})
    parts = list(E._in_buckets(np.float64, plans)([batch]))
    assert len(parts) > 3 and max(p.nbytes for p in parts) <= 2 * E.BATCH_BYTES and len({u for p in parts for u in p.column("uid").to_pylist()}) == 300
