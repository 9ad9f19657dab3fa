import random
import re

import numpy as np

from colloquy.llm import common as C
from colloquy.llm import jaccard as J
from colloquy.llm import pairs

DOC = "doc_id long, text string"


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    s = [sets(t) for _, t in docs]
    n = len(docs)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        r = find(i)
        low[r] = min(low.get(r, docs[i][0]), docs[i][0])
    return sorted((docs[i][0], low[find(i)], links[i]) for i in range(n))


def corpus():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for g in range(30):
        base = rnd.choices(words, k=rnd.randint(20, 200))
        for _ in range(rnd.choice([1, 1, 2, 3, 40 if g == 4 else 1])):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            docs.append(" ".join(w))
            if rnd.random() < 0.3:
                docs.append("\n".join(w))
    docs += ["one two", "one  two", "one two three", "", " ", None, "a a a a a a a", "a a a a a"]
    rnd.shuffle(docs)
    return [(i * 2 + 1, t) for i, t in enumerate(docs)]


def test_against_brute(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, "x") for d in docs] + [(None, docs[0][1], "y")], DOC + ", rep string")
    for tile in (512, 8):
        rows = J.join(df, tile=tile).collect()
        assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == brute(docs)
        assert all(r.kept == (r.doc_id == r.class_id) for r in rows)
    kept = J.keep_first(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c, _ in brute(docs)} | {None}


def test_documents_against_brute(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in J.join(df).collect()) == brute(docs)


def test_repeated_and_empty(spark):
    t = "a b c d e f g"
    rows = J.join(spark.createDataFrame([(1, t), (1, t), (2, t), (3, None)], DOC)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]
    assert J.join(spark.createDataFrame([], DOC)).collect() == []


def test_keep_first_of_repeated_ids(spark):
    a, b = "a b c d e f g", "q r s t u v w x"
    df = spark.createDataFrame([(3, a, 1), (3, a, 2), (5, a, 3), (5, b, 4), (5, b, 5), (7, "", 6), (7, None, 7), (8, b, 8), (None, a, 9)], DOC + ", text_key int")
    kept = J.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(3, a), (5, b), (7, ""), (7, ""), (0, a)])
    rows = J.join(df).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == sorted([(3, 3, 2), (3, 3, 2), (5, 3, 2), (5, 5, 2), (5, 5, 2), (7, 7, 0), (7, 7, 0), (8, 5, 2)])


def test_long_text(spark):
    rnd = random.Random(3)
    w = [f"w{rnd.randrange(10**6)}" for _ in range(120_000)]
    near = w[:5000] + ["x"] + w[5001:]
    rows = J.join(spark.createDataFrame([(2, " ".join(w)), (4, " ".join(near)), (6, " ".join(w[:60_000]))], DOC)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == [(2, 2, 1), (4, 2, 1), (6, 6, 0)]


def test_shorten():
    assert J.shorten({8: 9990, 7: 9, 6: 1}, 0.9999, 5) == 7
    assert J.shorten({8: 10, 5: 1}, 0.9999, 5) == 5
    assert J.shorten({}, 0.9999, 5) == J.DEEPEST


def test_depth_and_overlaps():
    d = J.depth_for(0.8)
    assert 1 - (1 - 0.8**d) ** J.TREES >= J.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** J.TREES
    rnd = np.random.default_rng(1)
    a, b = ([np.unique(C.mix(rnd.integers(0, 9000, k).astype(C.U64), 5)) for k in rnd.integers(0, 6000, 7)] for _ in range(2))
    assert (J.overlaps(a, b) == [[len(np.intersect1d(x, y)) for y in b] for x in a]).all()
    assert pairs.forest(6, np.array([1, 2, 5]), np.array([2, 4, 0])).tolist() == [0, 1, 1, 3, 1, 0]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (203, 201), (300, 299)] + [(400, 400 + k) for k in range(1, 50)] + [(rnd.randint(500, 600), rnd.randint(500, 600)) for _ in range(60)]
    got = {r.id: r.component for r in C.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
