import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import phrases as P
from colloquy.llm import words as W

SCHEMA = "doc_id long, text string, lang string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(docs, threshold, first=P.FIRST):
    """The definition, phrase by phrase."""
    f, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f.setdefault(lang, Counter())[ws[i : i + k]] += 1
    out = []
    for lang, c in f.items():
        rows = []
        for p, a in c.items():
            if len(p) == 1 or a < threshold:
                continue
            if any(100 * b >= 50 * a for q, b in c.items() if len(q) > len(p) and b >= threshold and p in (q[:-1], q[1:])):
                continue
            score, _, l, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first])]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in P.collocations(spark.createDataFrame(rows, schema), **options).collect())


def test_equals_counting_every_phrase(spark):
    rnd = np.random.default_rng(3)
    vocabulary = ["a", "Of", "the", "Éa", "éa", "x-y", "'s", "a b", "\x00", "日本"]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!?", " ;: "]
    texts = ["".join(rnd.choice(vocabulary) + rnd.choice(marks) for _ in range(rnd.integers(0, 60))) for _ in range(240)]
    rows = [(i, t, [None, "und", "en", "fr"][i % 4]) for i, t in enumerate(texts)]
    want = plain([(t, l) for _, t, l in rows], 10)
    assert mined(spark, rows) == want and len(want) > 20
    assert mined(spark, rows, block_bytes=300) == want  # many blocks and partitions
    assert mined(spark, rows, block_bytes=300, first=3) == [r for r in want if r[1] <= 3]


def test_odd_rows(spark):
    assert mined(spark, []) == []
    rows = [(None, None, None), (None, "", "en"), (1, " \t. ,\n", "en")]
    assert mined(spark, rows) == []
    same = [(7, "red fish swim", "en")] * 10
    # "red fish" and "fish swim" lie inside the longer phrase that holds all of them
    assert mined(spark, rows + same) == [("en", 1, "red fish swim", 10, 10, 10, 30, 1_000_000)]
    wide = [(7, "red fish swim", "en", 1, "x")] * 10
    assert len(mined(spark, wide, SCHEMA + ", a int, phrase string")) == 1
    assert mined(spark, same[:9]) == []


def test_very_long_text_and_ties(spark):
    rows = [(1, "b c. " * 60_000 + "a b. " * 60_000, "en"), (None, "d e. " * 10, None)]
    got = mined(spark, rows, block_bytes=1000)
    assert got == plain([(t, l) for _, t, l in rows], 10)
    assert [r[2] for r in got] == ["a b", "b c", "d e"]


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_000
    counted = spark.createDataFrame([("en", "a", 1, 2 * big), ("en", "b", 1, big), ("en", "a b", 2, big), ("en", "", 0, 9 * big)], "lang string, phrase string, size int, n long")
    assert [tuple(r) for r in P.scored(counted).collect()] == [("en", "a b", big, 2 * big, big, 500_000)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 400), max_size=60), max_size=30), st.integers(2, 12))
def test_every_frequent_item_survives(lists, threshold):
    total = Counter(x for items in lists for x in items)
    capacity = sum(total.values()) // threshold + 1
    whole, halves = P.Summary(capacity), [P.Summary(capacity), P.Summary(capacity)]
    for i, items in enumerate(lists):
        h, c = np.unique(np.array(items, np.uint64), return_counts=True)
        whole.add(h, c)
        halves[i % 2].add(h, c)
    halves[0].settle()
    halves[0].merge(halves[1])
    for s in (whole, halves[0]):
        alive = set(s.survivors(threshold).tolist())
        assert {x for x, n in total.items() if n >= threshold} <= alive
        assert len(s.hashes) <= capacity and s.lost < threshold
        assert all(total[int(h)] - s.lost <= c <= total[int(h)] for h, c in zip(s.hashes, s.counts))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**48 - 1), max_size=50))
def test_packed_hashes(values):
    h = np.unique(np.array(values, np.uint64))
    assert (P.unpack(P.pack(h)) == h).all()


def test_words_by_number():
    for raw in (b"", b" ", b"a", b"  a  b a ", b"a b"):
        numbers, words = W.codes(raw)
        assert [words[k] for k in numbers] == raw.split()
