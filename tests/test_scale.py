import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.operators import losses as L
from colloquy.operators import permutation as B
from colloquy.operators import samples as M
from colloquy.sources import versions as V


def test_places_are_a_permutation_and_back(spark):
    for n in (1, 3, 64, 4999):
        rows = spark.range(n).select(F.col("id").alias("i"))
        both = B.placed(B.placed(rows, n, 5, 0, out="e0"), n, 5, 1, out="e1")
        got = B.numbered(both, n, 5, 0, "e0", "back").collect()
        for e in ("e0", "e1"):
            assert sorted(r[e] for r in got) == list(range(n))
        assert all(r.back == r.i for r in got)
    p = np.array([r.e0 for r in sorted(got, key=lambda r: r.i)])
    q = np.array([r.e1 for r in sorted(got, key=lambda r: r.i)])
    assert (p != q).mean() > 0.99 and abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.06 and abs(np.corrcoef(p[:-1], p[1:])[0, 1]) < 0.06
    big = 10**15 + 7  # no product passes 63 bits
    at = [0, 1, 10**14, big - 1]
    out = B.numbered(B.placed(spark.createDataFrame([(x,) for x in at], "i long"), big, 3, 0), big, 3, 0, "place", "b").collect()
    assert all(0 <= r.place < big and r.b == r.i for r in out) and len({r.place for r in out}) == len(at)


def test_epochs_need_no_exchange(spark):
    out = B.epochs(spark.range(100).select(F.col("id").alias("i")), 100, 1, [0, 1, 2], 4)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for e in range(3):
        rows = out.where(F.col("epoch") == e).collect()
        assert sorted((r["rank"], r.seq) for r in rows) == [(k, s) for k in range(4) for s in range(25)]


def test_markers_of_one_clip_over_many_ranges(spark):
    rnd = np.random.default_rng(3)
    speakers = ["SPEAKER_BROKER", "SPEAKER_CLIENT", None]
    rows = [(0, i, float(i // 3), speakers[rnd.integers(0, 3)]) for i in range(3000)] + [(c, i, float(i), speakers[rnd.integers(0, 2)]) for c in range(1, 40) for i in range(int(rnd.integers(1, 4)))]
    df = spark.createDataFrame(rows, "clip long, pos int, start_sec double, speaker string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        got, *others = ({(r.clip, r.pos): r.marker for r in M.turn_markers(df, span=s).collect()} for s in (None, 600.0, 7.0, 0.5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want, before = {}, (None, None)
    for c, i, s, who in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        last = before[1] if before[0] == c else None
        want[c, i] = None if who == last else "bos" if who == "SPEAKER_BROKER" else "eos" if last == "SPEAKER_BROKER" else None
        before = (c, who)
    assert got == want and all(x == want for x in others)
    assert M.turn_markers(df.limit(0)).count() == 0


def test_markers_of_odd_times_and_nulls(spark):
    inf, nan = float("inf"), float("nan")
    main = "SPEAKER_BROKER"
    rows = [("a", None, 1, 0, main), ("a", None, 1, 1, None), ("a", None, -inf, 2, main), ("a", None, 5.0, 3, main), ("a", None, inf, 4, "x"), ("a", None, nan, 5, main), ("a", None, None, 6, "x"), (None, 1, 9.0, 0, main), (None, 1, 1.0, 1, main)]
    df = spark.createDataFrame([(c, k, None if s is None else float(s), p, w) for c, k, s, p, w in rows], "clip string, part int, start_sec double, pos int, speaker string")
    got = {(r.clip, r.pos): r.marker for r in M.turn_markers(df, by=("clip", "part"), span=2.0).collect()}
    # in order: null, -inf, 1 (two), 5, inf, NaN
    assert got == {("a", 6): None, ("a", 2): "bos", ("a", 0): None, ("a", 1): "eos", ("a", 3): "bos", ("a", 4): "eos", ("a", 5): "bos", (None, 1): "bos", (None, 0): None}


def test_wide_logits_equal_the_fold(spark):
    rnd = np.random.default_rng(1)
    x = (rnd.normal(size=(40, 32_000)) * 5).astype(np.float32)
    x[3, 7:9] = 99.0  # equal maxima
    rows = [(i, v.tolist(), int(rnd.integers(0, 32_000))) for i, v in enumerate(x)] + [(40, None, 1), (41, [], 0), (42, [1.0, 2.0], 5), (43, [1.0, 2.0], None), (44, [float("-inf"), 0.0], 1), (45, [1e30, -1e30], 0)]
    df = spark.createDataFrame(rows, "id int, logits array<float>, target int").repartition(3)
    got = {r.id: r for r in L.cross_entropy_wide(df).collect()}
    fold = {r.id: r.ce for r in df.where("id < 40").select("id", L.cross_entropy(F.transform("logits", lambda v: v.cast("double")), F.col("target")).alias("ce")).collect()}
    assert all(abs(got[i].ce - fold[i]) < 1e-6 for i in range(40)) and len(fold) == 40
    assert all(got[i].predicted == int(x[i].argmax()) for i in range(40)) and got[3].predicted == 7
    assert [got[i].ce for i in (40, 41, 42, 43)] == [None] * 4 and got[40].predicted is None and got[42].predicted == 1
    assert got[44].ce == 0.0 and got[45].ce == 0.0
    again = {r.id: r.ce for r in L.cross_entropy_wide(df, block=1000).collect()}
    assert all(again[i] == pytest.approx(got[i].ce, abs=1e-9) for i in range(40))


def test_a_failed_rewrite_leaves_the_old_version(spark, tmp_path):
    top = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        V.read(spark, top)
    assert V.write(spark.range(5), top) == 1 and V.read(spark, top).count() == 5
    reader = V.read(spark, top)
    assert V.rewrite(spark, top, lambda old: old.where("id > 1")) == 2
    assert V.read(spark, top).count() == 3 and reader.count() == 5 and V.read(spark, top, 1).count() == 5
    with pytest.raises(Exception, match="broken"):
        V.rewrite(spark, top, lambda old: old.select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")))
    assert V.current(spark, top) == 2 and sorted(r.id for r in V.read(spark, top).collect()) == [2, 3, 4]
    assert V.rewrite(spark, top, lambda old: old.limit(1)) in (3, 4)
    assert V.read(spark, top).count() == 1
    assert 1 in V.drop_old(spark, top, keep=2) and V.read(spark, top, 2).count() == 3
