import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from colloquy.llm import lm

DOC = "doc_id long, text string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def fold(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 7


def corpus():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["The", "ÉT", "x y"]
    follow = {w: rnd.sample(words, 4) for w in words}
    docs = []
    for i in range(150):
        w, out = rnd.choice(words), []
        for _ in range(rnd.randint(0, 40)):
            out.append(w)
            w = rnd.choice(follow[w]) if rnd.random() < 0.8 else rnd.choice(words)
        docs.append((i, rnd.choice([" ", "\n"]).join(out)))
    return docs + [(3, None), (None, "The w1"), (400, ""), docs[5], docs[6]]


def brute_scores(docs):
    """The model with plain counters: counts, evidence of the deleted fold, weights, scores."""
    def counted(train):
        uni, bi = Counter(), Counter()
        for w in train:
            uni.update(w)
            bi.update(zip([None, *w], w))
        return uni, bi, sum(uni.values())

    def estimates(h, w, uni, bi, n, v):
        return 1 / (v + 1), uni[w] / n, bi[h, w] / uni[h] if uni[h] else 0.0

    context = lambda c: min(int(math.log2(c)) + 1, lm.N_CONTEXTS - 1) if c else 0
    texts = [(fold(d), tokens(t)) for d, t in docs]
    full = counted([w for f, w in texts if f != 2])
    v = len(full[0])
    left = counted([w for f, w in texts if f not in (2, 3)])
    cells = {}
    for f, w in texts:
        if f == 3:
            for h, x in zip([None, *w], w):
                p = estimates(h, x, *left, v)
                key = (context(left[0][h]), *(round(4 * math.log2(q / p[0])) if q else None for q in p[1:]))
                cell = cells.setdefault(key, [0, 0.0, 0.0, 0.0])
                for k, add in enumerate((1, *p)):
                    cell[k] += add
    weights = lm.learn_weights(np.array([[k[0], c[0], c[1] / c[0], c[2] / c[0], c[3] / c[0]] for k, c in cells.items()]))
    out = []
    for _, w in texts:
        total = 0.0
        for h, x in zip([None, *w], w):
            total += math.log10(sum(a * b for a, b in zip(weights[context(full[0][h])], estimates(h, x, *full, v))))
        out.append(total)
    return out


def test_counts_base_and_model(spark):
    docs = corpus()
    train = [tokens(t) for d, t in docs if fold(d) != 2]
    c = Counter(t for d in train for t in d)
    n, v = sum(c.values()), len(c)
    for size in (1 << 22, 900):
        rows = lm.score(spark.createDataFrame([(*d, 0) for d in docs], DOC + ", block int"), block_bytes=size).collect()
        got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)
        want = sorted(((d, fold(d) == 2, len(w := tokens(t)), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for d, t in docs), key=str)
        assert got == want
        scores = sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows)
        plain = sorted((str(d), len(tokens(t)), x) for (d, t), x in zip(docs, brute_scores(docs)))
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 for a, b in zip(scores, plain))
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)  # closer to held-out text
        assert all(r.score < 0 for r in rows)


def test_weights_are_what_em_finds():
    # contexts of bucket 3: the bigram explains the tokens; of bucket 5: it does not
    cells = np.array([[3, 100, 1e-4, 1e-3, 0.3], [5, 100, 1e-4, 1e-2, 0.0], [5, 5, 1e-4, 0.0, 0.0]])
    w = lm.learn_weights(cells)
    assert w[3, 2] > 0.9 and w[5, 2] < 0.01 and w[0, 2] == 0 and abs(w.sum(1) - 1).max() < 1e-9
    assert (w[4] == w[3]).all() or (w[4] == w[5]).all()


def test_empty(spark):
    assert lm.score(spark.createDataFrame([], DOC)).collect() == []
    only = lm.score(spark.createDataFrame([(None, None)], DOC)).collect()
    assert only[0].n_tokens == 1
