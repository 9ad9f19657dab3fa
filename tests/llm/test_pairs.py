"""Comparisons of a slot against plain loops, and joins spread over salts."""
from collections import Counter

import numpy as np

from colloquy.llm import common as C
from colloquy.llm import pairs


def test_comparisons_give_each_pair_of_a_tile_pair_once():
    rnd = np.random.default_rng(2)
    for tile in (3, 100):
        rows = []
        for group in range(12):
            n = int(rnd.integers(1, 20))
            k = -(-n // tile)
            for member in range(n):
                mine = int(rnd.integers(0, k))
                rows += [(group, min(mine, o), max(mine, o), mine, group * 100 + member) for o in range(k)]
        rnd.shuffle(rows)
        group, ga, gb, mine, member = np.array(rows).T
        c = pairs.Comparisons([group], ga, gb, mine, member)
        who, of = member[c.order], group[c.order]
        for chunk in (1, 7, 10_000):
            got = Counter()
            for a, b in c.pairs(np.arange(len(c.starts)), chunk):
                assert (of[a] == of[b]).all()
                got.update((min(x, y), max(x, y)) for x, y in zip(who[a].tolist(), who[b].tolist()))
            members = {}
            for g, *_, m in rows:
                members.setdefault(g, set()).add(m)
            want = {(x, y) for m in members.values() for x in m for y in m if x < y}
            assert set(got) == want and set(got.values()) <= {1}
        some = np.flatnonzero(np.arange(len(c.starts)) % 2 == 0)
        part = {(who[x], who[y]) for a, b in c.pairs(some, 50) for x, y in zip(a, b)}
        assert len(part) <= len(want)
    none = np.empty(0, np.int64)
    assert list(pairs.Comparisons([none], none, none, none, none).pairs(none, 5)) == []


def test_join_spread(spark):
    rows = spark.range(500).selectExpr("id", "case when id < 400 then 1 else id end as k")
    table = spark.range(600).selectExpr("id as k", "id * 2 as v")
    got = C.join_spread(rows, table, "k", "id")
    assert got.columns == ["k", "id", "v"] and got.count() == 500 and got.where("v <> k * 2").count() == 0
