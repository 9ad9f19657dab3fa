import hashlib
import random
import re

import numpy as np

from colloquy.llm import common as C
from colloquy.llm import substring_dedup as S

DOC = "doc_id long, text string"


def brute(docs):
    docs = [(float("inf") if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    first = {}
    for d, w in docs:
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, float("inf")), d)
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone |= set(range(i, i + 50))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((None if d == float("inf") else d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "日本"]
    parts = [rnd.choices(words, k=rnd.randint(40, 130)) for _ in range(6)] + [["a"] * 120, ["a", "b"] * 60, ["a", "b", "c", "c", "c"] * 30]
    docs = []
    for i in range(n):
        w = rnd.choices(words, k=rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(parts)
            k = rnd.randint(0, len(p) // 2)
            w += p[k : k + rnd.randint(45, 130)] + rnd.choices(words, k=rnd.randint(0, 9))
        docs.append((i * 3 % 97, rnd.choice([" ", "\n", " \t"]).join(w)))
    return docs + [(5, None), (6, ""), (7, " \n"), (None, docs[3][1]), (None, docs[4][1]), docs[8], (200, docs[8][1]), (2, docs[9][1])]


def test_against_brute(spark):
    for seed, size in ((1, 1 << 22), (2, 4000), (3, 1500)):
        docs = corpus(seed)
        got = S.dedup(spark.createDataFrame([(*d, 1) for d in docs], DOC + ", block int"), block_bytes=size).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs)


def test_equal_windows_share_their_anchor():
    rnd = np.random.default_rng(3)
    passage = C.mix(rnd.integers(0, 40, 90).astype(C.U64), 1)
    for trial in range(50):
        left, right = (C.mix(rnd.integers(0, 40, k).astype(C.U64), 2) for k in rng_sizes(rnd))
        h = np.concatenate((left, passage, right, passage, left))
        ends = np.array([len(left) + 90 + len(right), len(h)])
        name, a, z = S.recompress(h, ends)
        assert (np.diff(a) >= 0).all() and (np.diff(z) >= 0).all()
        two = []
        for base in (len(left), len(left) + 90 + len(right)):
            inside = (a >= base) & (z <= base + 90)
            two.append({(int(n), int(x) - base, int(y) - base) for n, x, y in zip(name[inside], a[inside], z[inside])})
        assert two[0] == two[1] and two[0]


def rng_sizes(rnd):
    return rnd.integers(0, 30, 2) + 1


def test_packing():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        h = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        assert (C.unpack_sorted(C.pack_sorted(h)) == h).all()
        c = rnd.integers(0, 400, n) * rnd.integers(1, 10**6, n)
        assert (C.unpack_counts(C.pack_counts(c), n) == c).all()


def test_empty(spark):
    assert S.dedup(spark.createDataFrame([], DOC)).collect() == []


def test_long_text(spark):
    rnd = random.Random(4)
    w = [f"w{rnd.randrange(10**6)}" for _ in range(150_000)]
    docs = [(1, " ".join(w)), (2, " ".join(["x"] + w[70_000:70_300] + ["y"])), (3, " ".join(w[:49]))]
    assert sorted(map(tuple, S.dedup(spark.createDataFrame(docs, DOC)).collect()), key=str) == brute(docs)
