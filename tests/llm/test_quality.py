import math
from collections import Counter

import numpy as np

from colloquy.llm import quality as Q

DOC = "doc_id long, text string"


def test_em_against_a_plain_loop():
    rnd = np.random.default_rng(5)
    k = len(Q.HEURISTICS)
    counts = Counter()
    for _ in range(3000):
        good = rnd.random() < 0.8
        counts[Q.pattern_of([0 if rnd.random() < 0.3 else (Q.GOOD if rnd.random() < (0.95 if good else 0.3) else Q.BAD) for _ in range(k)])] += 1
    post, right = Q.estimate(counts, rounds=20)
    prior, table = [0.15, 0.85], [[0.55] * k, [0.97] * k]
    for _ in range(20):
        p, used, good, given = {}, [0, 0], [[0] * k, [0] * k], [[0] * k, [0] * k]
        for pattern, n in counts.items():
            v = Q.votes_of(pattern)
            like = [prior[c] * math.prod((table[c][j] if x == 2 else 1 - table[c][j]) for j, x in enumerate(v) if x) for c in (0, 1)]
            p[pattern] = like[1] / sum(like)
            for c in (0, 1):
                w = n * like[c] / sum(like)
                used[c] += w * any(v)
                for j, x in enumerate(v):
                    given[c][j] += w * (x > 0)
                    good[c][j] += w * (x == 2)
        prior = [(used[0] + 1.5) / (sum(used) + 10), (used[1] + 8.5) / (sum(used) + 10)]
        table = [[(good[c][j] + 5 * (0.55, 0.97)[c]) / (given[c][j] + 5) for j in range(k)] for c in (0, 1)]
    assert all(abs(post[x] - p[x]) < 1e-9 for x in p) and np.allclose(right, table)
    assert (abs(right[1] - 0.95) < 0.03).all() and (abs(right[0] - 0.3) < 0.08).all()


def test_accuracy_on_labels(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in Q.classify(df).collect() if r.doc_id in labels]
    bad = [r.rejected for r in rows if labels[r.doc_id] == 0]
    good = [r.rejected for r in rows if labels[r.doc_id] == 1]
    assert sum(bad) > 0.93 * len(bad) and sum(good) <= 0.002 * len(good)


def test_keep_good_and_odd_rows(spark):
    docs = [(i, "The house of the family stood on a hill, and we saw it from the road. " * 3) for i in range(40)]
    docs += [(100 + i, "%%% ### buy $$$ now!!! " * 20) for i in range(8)] + [(200, None), (201, ""), (None, "short"), (1, docs[1][1])]
    df = spark.createDataFrame([(*d, True, 0.5) for d in docs], DOC + ", rejected boolean, score double")
    rows = Q.classify(df).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows if r.rejected} == set(range(100, 108))
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if not (d or 0) in range(100, 108))
    assert Q.classify(df.limit(0)).collect() == [] and Q.keep_good(df.limit(0)).collect() == []


def test_short_texts_are_judged(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    short = {r.doc_id: r.quality for r in docs.join(labels, "doc_id").collect() if len(r.text.split()) < 12}
    rejected = {r.doc_id for r in Q.classify(docs).collect() if r.doc_id in short and r.rejected}
    bad = {d for d, q in short.items() if q == 0}
    assert len(rejected & bad) >= 6 and not rejected - bad


def test_short_and_empty_texts_in_a_bad_corpus(spark):
    docs = [(i, "%%% ### buy $$$ now!!! " * 20) for i in range(60)]
    docs += [(100 + i, "The house of the family stood on a hill, and we saw it from the road. " * 3) for i in range(20)]
    docs += [(200, None), (201, ""), (202, " \n"), (203, "We saw the house from the road."), (204, "### buy $$$ now!!!")]
    got = {r.doc_id: r for r in Q.classify(spark.createDataFrame(docs, DOC)).collect()}
    assert got[200].score < 0.5 and {d for d, r in got.items() if r.rejected} == {*range(60), 204}


def plain_features(text):
    kinds = {c: 0 for c in range(256)}
    for marks, kind in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3), (" \t", 4), ("\n\r", 5), (".!?,;:'\"()-", 6), ("#$%&*+<=>@[\\]^_`{|}~", 7)):
        kinds |= {ord(c): kind for c in marks}
    kinds |= {c: 8 for c in range(128, 256)}
    raw, out = text.encode(), Counter()
    words = raw.split()
    c = [kinds[b] for b in raw.ljust(5)]
    for i in range(len(c) - 4):
        n = 0
        for x in c[i : i + 5]:
            n = n * 9 + x
        out[n * 2654435761 % 2**32 >> 19] += 1
    out = Counter({k: n / (len(c) - 4) for k, n in out.items()})
    tenths = int(10 * sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)))
    out[(9**5 + tenths) * 2654435761 % 2**32 >> 19] += 0.25
    return {k: math.sqrt(v) for k, v in out.items()}


def test_scorer_against_plain_loops():
    texts = ["Hello there, friend 42!", "### $$$ %%%", "éa a a a a", "x"] + ["word " * k + "." * (k % 3) for k in range(1, 9)]
    rows = [Q.features(t) for t in texts]
    for t, (at, val) in zip(texts, rows):
        want = plain_features(t)
        assert set(at.tolist()) == set(want) and all(abs(v - want[k]) < 1e-6 for k, v in zip(at.tolist(), val.tolist())), t
    target = [0.9, 0.1, 0.8, 0.5] + [0.7] * 8
    w, b = Q.fit(rows, np.array(target), steps=15)
    plain, bias, seen, seen_b = Counter(), math.log(np.mean(target) / (1 - np.mean(target))), Counter(), 1e-8
    for _ in range(15):
        g, gb = Counter(), 0.0
        for (at, val), y in zip(rows, target):
            err = (1 / (1 + math.exp(-(sum(plain[k] * v for k, v in zip(at.tolist(), val.tolist())) + bias))) - y) / len(rows)
            gb += err
            for k, v in zip(at.tolist(), val.tolist()):
                g[k] += err * v
        for k in set(g) | set(plain):
            x = g[k] + 1e-4 * plain[k]
            seen[k] += x * x
            plain[k] -= 0.5 * x / math.sqrt(seen[k] + 1e-8)
        seen_b += gb * gb
        bias -= 0.1 * gb / math.sqrt(seen_b)
    assert abs(b - bias) < 1e-6 and all(abs(w[k] - v) < 1e-5 for k, v in plain.items())


def test_long_text(spark):
    docs = [(i, "The house of the family stood on a hill, and we saw it from the road. " * 3) for i in range(40)]
    docs += [(90, "The house stood on a hill, and we saw it. " * 60_000), (91, "%%% ### $$$ " * 200_000)] + [(100 + i, "%%% ### buy $$$ now!!! " * 20) for i in range(8)]
    assert {r.doc_id for r in Q.classify(spark.createDataFrame(docs, DOC)).collect() if r.rejected} == {91, *range(100, 108)}


def test_null_and_repeated_ids_are_sampled_as_others(spark):
    good = [f"The {w} of the town was told that the work on the bridge is done, and it was good news for all number {i}." for i, w in enumerate(["mayor", "baker", "judge"] * 100)]
    junk = [f"$$$ ### {i} !!! @@@ %%% ^^^ &&& *** {i * 7} ((( ))) === +++ ~~~ <<< >>> ||| {i}" for i in range(300)]
    texts = [*good, *junk]
    own = [(i, t) for i, t in enumerate(texts)]
    rejected = {}
    for name, rows in (("own", own), ("null", [(None, t) for t in texts]), ("one", [(7, t) for t in texts])):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert Q.sample(df, 100).count() == 100 and Q.sample(df, 300).count() == 300
        rejected[name] = sorted(r.text for r in df.exceptAll(Q.keep_good(df, train_docs=300)).collect())
    assert rejected["own"] == sorted(junk) == rejected["null"] == rejected["one"]
    copies = spark.createDataFrame([(None, texts[0])] * 500 + own, "doc_id long, text string")
    assert Q.sample(copies, 300).count() == 300 and Q.sample(copies, 10_000).count() == 601
