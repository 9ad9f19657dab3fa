import hashlib
import math

import numpy as np
import pytest

from colloquy.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def plain(rows, entries=V.ENTRIES, rounds=V.ROUNDS):
    """The definition with Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not kept:
        return []
    d = -(-len(kept[0][1]) // 4)
    kept = [(i, v + [0] * (4 * d - len(v)), l) for i, v, l in kept if len(v) == len(kept[0][1])]
    cut = lambda v: [v[k * d : (k + 1) * d] for k in range(4)]
    books = [[cut(v)[k] for _, v, _ in kept[:entries]] for k in range(4)]
    nearest = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        new = []
        for k in range(4):
            of = {}
            for _, v, _ in kept:
                of.setdefault(nearest(cut(v)[k], books[k])[1], []).append(cut(v)[k])
            new.append([[sum(c) // len(of[j]) for c in zip(*of[j])] if j in of else e for j, e in enumerate(books[k])])
        books = new
    told = [(i, [nearest(p, b) for p, b in zip(cut(v), books)], l) for i, v, l in kept]
    sums = {}
    for _, n, l in told:
        sums[l] = sums.get(l, 0) + sum(x for x, _ in n)
    text = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for _, j in n), sum(x for x, _ in n), sums[l], sha) for i, n, l in told]


def coded(spark, rows, schema=SCHEMA, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in V.compress(spark.createDataFrame(rows, schema), **options).collect()), key=repr)


def vectors(n, d, seed=0, spread=3.0):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(7, d)) * spread
    return [(int(i), (middle[i % 7] + rnd.normal(size=d) * 0.3).tolist(), int(i % 5) if i % 5 else None) for i in rnd.permutation(n)]


def test_equals_the_definition(spark):
    rows = vectors(900, 16)
    rows += [(10_000 + k, rows[0][1], 1) for k in range(300)]  # one vector very often
    want = sorted(plain(rows, entries=40), key=repr)
    assert coded(spark, rows, entries=40) == want
    assert coded(spark, rows, entries=40, block_bytes=8 * 16 * 50) == want  # many blocks
    assert len({r[1] for r in want}) > 20


def test_fewer_than_all_entries_and_uneven_lengths(spark):
    rows = vectors(9, 6)
    assert coded(spark, rows) == sorted(plain(rows), key=repr)
    assert all(r[2] == 0 for r in coded(spark, rows))


def test_odd_rows(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 1), (2, [], 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [math.nan, 0.0, 0.0, 0.0], 1), (5, [math.inf] * 4, 2)]) == []
    rows = [(None, [0.5, -0.5, 0.25, -1.75], 3), (7, [1.0, 2.0, 3.0, 4.0], None), (7, [0.0, 2.0, 3.0, 4.0], None), (8, [1.0], 3), (9, [1.0] * 5, 3), (2, None, 3)]
    assert coded(spark, rows) == sorted(plain(rows), key=repr)
    wide = [(*r, "x", 1) for r in rows]
    assert coded(spark, wide, SCHEMA + ", code string, error int") == sorted(plain(rows), key=repr)


def test_large_components(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.integers(-3, 4, 8) * 10.0 ** rnd.integers(0, 12)], 1) for i in range(60)]
    big = sorted(plain(rows, entries=5), key=repr)
    want = [(i, c, e if e < 1 << 63 else None, s if all(r[2] < 1 << 63 for r in big) and s < 1 << 63 else None, h) for i, c, e, s, h in big]
    assert coded(spark, rows, entries=5) == sorted(want, key=repr)
    assert any(r[2] is None for r in want)


@pytest.mark.parametrize("n,d,entries", [(1, 1, 1), (33, 2, 7), (500, 3, 256), (1000, 16, 256)])
def test_every_part_gets_its_nearest_entry_and_nodes_are_pruned(n, d, entries):
    rnd = np.random.default_rng(n)
    x = np.floor(rnd.normal(size=(n, d)) * 20 + rnd.integers(-3, 4, (n, 1)) * 200)
    book = x[rnd.integers(0, n, entries)]  # with ties
    order = V.tree_order(x, V.LEAF)
    tree, got, whole = V.Tree(x[order], V.LEAF), np.full(n, -1), 0
    for a, b, e in V.assign(tree, V.Entries(book)):
        if e < 0:
            got[a] = b
        else:
            assert (tree.sums[b] - tree.sums[a] == tree.x[a:b].sum(0)).all()
            got[a:b], whole = e, whole + b - a
    away = ((x[order][:, None] - book[None]) ** 2).sum(2)
    assert (got == away.argmin(1)).all()


def test_nodes_far_from_all_but_one_entry_go_as_a_whole():
    x = np.concatenate([np.full((64, 4), 100.0 * k) + np.arange(64)[:, None] % 3 for k in range(8)])
    x = x[V.tree_order(x, V.LEAF)]
    ranges = list(V.assign(V.Tree(x, V.LEAF), V.Entries(np.array([[100.0 * k] * 4 for k in range(8)]))))
    assert all(e >= 0 for *_, e in ranges) and sum(b - a for a, b, _ in ranges) == len(x)
