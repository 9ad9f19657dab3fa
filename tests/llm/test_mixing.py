from collections import Counter

import duckdb

from colloquy.llm import mixing as M

DOC = "doc_id long, text string, source string, lang string"


def fitted(cells, targets, rounds):
    """cells {(s, l, t): tokens} raked one margin after the other."""
    fit = {k: float(v) for k, v in cells.items()}
    for _ in range(rounds):
        for m in range(3):
            now = Counter()
            for k, v in fit.items():
                now[k[m]] += v
            fit = {k: v * targets[m][k[m]] / now[k[m]] if now[k[m]] else 0.0 for k, v in fit.items()}
    return fit


def test_raking_against_a_plain_loop(spark):
    cells = {(s, l, t): (i * 37 + j * 11 + k * 5) % 50 for i, s in enumerate("abc") for j, l in enumerate(("en", "de")) for k, t in enumerate(("x", "y"))}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens long")
    every = sum(cells.values())
    shares = ({"a": 1, "b": 1, "c": 2}, {"en": 3, "de": 1}, {"x": 1, "y": 1})
    targets = [{k: v / sum(s.values()) * every for k, v in s.items()} for s in shares]
    want = fitted(cells, targets, 200)
    got = {(r.source, r.lang, r.topic): r.weight * r.tokens for r in M.rake(df, dict(zip(M.MARGINS, shares))).collect()}
    assert all(abs(got[k] - want[k]) < 1e-4 * every for k in want)
    for m in range(3):
        for value, target in targets[m].items():
            assert abs(sum(v for k, v in got.items() if k[m] == value) - target) <= M.TOLERANCE * every


def test_query_against_sql(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    duckdb.sql("create or replace view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(duckdb.sql(f"select doc_id, source, lang, topic, n_tokens, weight, probability, sampled from ({M.sql()})").fetchall())
    got = sorted(map(tuple, M.sampled(df).collect()))
    assert got == want and 0 < sum(r[-1] for r in got) < len(got)


def test_mix_keeps_columns_and_agrees(spark):
    docs = [(i, "word " * (i % 7), f"s{i % 3}", None if i % 5 else "en") for i in range(80)] + [(None, "a b", None, "en"), (3, "word " * 3, "s0", None)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], DOC + ", topic int, weight int")
    rows = M.sampled(df).collect()
    assert len(rows) == len(docs)
    kept = M.mix(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.sampled)
    assert all(not r.sampled for r in rows if r.n_tokens == 0)
    none = M.sampled(df, targets={"source": {"s1": 1.0}}).collect()
    assert {r.source for r in none if r.sampled} == {"s1"}


def test_expected_tokens_follow_the_targets(spark):
    df = spark.createDataFrame([(i, "w " * 10, "big" if i % 10 else "small", "en") for i in range(6000)], DOC)
    rows = M.sampled(df, targets={"source": {"big": 0.5, "small": 0.5}}).collect()
    n = Counter(r.source for r in rows if r.sampled)
    assert n["small"] == 600 and 500 < n["big"] < 700


def test_empty(spark):
    assert M.sampled(spark.createDataFrame([], DOC)).collect() == []
    assert M.mix(spark.createDataFrame([], DOC)).collect() == []


def test_nothing_to_sample(spark):
    """No tokens at all, targets that name no value, and shares of zero."""
    blank = spark.createDataFrame([(1, "", "a", "en"), (2, None, None, None)], DOC)
    assert [(r.weight, r.sampled) for r in M.sampled(blank).collect()] == [(0.0, False)] * 2
    assert M.mix(blank).collect() == []
    some = spark.createDataFrame([(1, "a b", "a", "en"), (2, "c", "b", "de")], DOC)
    for targets in ({"source": {"z": 1.0}}, {"lang": {}}, {"lang": {"en": 0.0}}, {"source": {"a": 1.0}, "lang": {"de": 1.0}}):
        assert not any(r.sampled for r in M.sampled(some, targets=targets).collect()), targets


def test_long_and_repeated_texts(spark):
    df = spark.createDataFrame([(1, "word " * 400_000, "a", "en"), (2, "x", "a", "en"), (2, "x", "a", "en")], DOC)
    rows = sorted((r.doc_id, r.n_tokens) for r in M.sampled(df).collect())
    assert rows == [(1, 400_000), (2, 1), (2, 1)] and M.mix(df).count() == 3


def test_many_cells_rake_by_shuffles(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{i % 11}", "en" if i % 3 else "de") for i in range(200)], DOC)
    want = sorted(map(tuple, M.sampled(docs).collect()))
    monkeypatch.setattr(M, "FEW_CELLS", 0)
    assert sorted(map(tuple, M.sampled(docs).collect())) == want
