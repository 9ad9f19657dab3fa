import time

import numpy as np
from pyspark.sql import functions as F

from colloquy.operators import audio as A
from colloquy.operators import waves as B

TAKES = "id string, pcm array<float>, n_chars int"


def near(a, b):
    return (a is None and b is None) or abs(a - b) < 1e-6


def test_columns_and_arrow_agree(spark):
    rnd = np.random.default_rng(2)
    rows = [(f"t{i}", (rnd.normal(size=int(rnd.integers(40, 300))) * rnd.choice([0.05, 0.3, 2.0])).astype(np.float32).tolist(), int(rnd.integers(1, 40))) for i in range(60)]
    rows += [("short", [0.1, -0.2], 3), ("silent", [0.0] * 90, 5)]
    df = spark.createDataFrame([*rows], TAKES).repartition(3)
    want = {r.id: r for r in A.scored(df, 200).collect()}
    got = {r.id: r for r in B.scored(df, 200).collect()}
    for i, w in want.items():
        assert all(near(w[c], got[i][c]) for c in ("peak", "level_db", "clip_share", "silence_share", "score")), (i, w, got[i])
    x = A.doubles(F.col("pcm"))
    fold = {r.id: r for r in df.select("id", A.frame_energies(x, 200).alias("e"), A.scale_dbfs(x, -30.0).alias("s"), A.peak_normalize(x, A.peak(x)).alias("p"), A.pack_pair(x, x, 0.2049, 200)[0].alias("l")).collect()}
    for name, rows_of in (("e", B.frame_energies(df, 200).select("id", F.col("energies").alias("v"))), ("s", B.scaled_dbfs(df, -30.0).select("id", F.col("pcm").alias("v"))),
                          ("p", B.peak_normalized(df.withColumnRenamed("pcm", "left"), ("left",)).select("id", F.col("left").alias("v"))),
                          ("l", B.packed_pair(df.withColumn("user", F.col("pcm")).withColumn("agent", F.col("pcm")), 0.2049, 200).select("id", F.col("left").alias("v")))):
        for r in rows_of.collect():
            assert np.allclose(r.v, fold[r.id][name], atol=1e-6), (name, r.id)
    for r in B.faded(B.resampled(df, 16_000, 24_000), 9).collect():
        x = np.array(next(p for i, p, _ in rows if i == r.id), np.float32)
        assert np.allclose(r.pcm, A.fade_edges(A.resample_linear(x, 16_000, 24_000), 9), atol=1e-6)


def test_pool_packing_does_not_depend_on_partitions(spark):
    rnd = np.random.default_rng(3)
    rows = [(f"c{i}", rnd.normal(size=80).tolist(), rnd.normal(size=50).tolist()) for i in range(20)] + [("none", None, [0.1]), ("hole", [0.1, None], [0.2])]
    df = spark.createDataFrame(rows, "id string, user array<float>, agent array<float>")
    tone = (np.sin(np.arange(500)) * 0.01).astype(np.float32)
    told = [sorted(map(str, B.packed_pool(df.repartition(n), tone, 7, 0.2, 200).collect())) for n in (1, 6)]
    assert told[0] == told[1]
    for r in B.packed_pool(df, tone, 7, 0.2, 200).collect():
        if r.id in ("none", "hole"):
            assert r.left is None and r.duration is None
            continue
        left, right, times = A.pack_pool(np.array(r.user, np.float32), np.array(r.agent, np.float32), tone, A.sample_rng(7, r.id), 0.2, 200)
        assert np.allclose(r.left, left) and np.allclose(r.right, right) and r.duration == times["duration"]
    crops = B.cropped(df.select("id", F.col("user").alias("tone")), 30, 7, 200).collect()
    assert all(len(r.crop) == 30 for r in crops if r.id[0] == "c") and [r.crop for r in crops if r.id in ("none", "hole")] == [None, None]


def test_ten_seconds_at_24_khz(spark):
    rnd = np.random.default_rng(4)
    long = spark.createDataFrame([(str(i), (rnd.normal(size=1000) * 0.2).tolist(), 125) for i in range(2)], TAKES).withColumn("pcm", F.flatten(F.array_repeat("pcm", 240))).repartition(1)
    long.cache().count()

    def seconds(run):
        began = time.time()
        rows = run(long, 24_000).select("id", "score").collect()
        return time.time() - began, {r.id: r.score for r in rows}

    seconds(B.scored)
    arrow, fast = min((seconds(B.scored) for _ in range(2)), key=lambda x: x[0])
    fold, slow = seconds(A.scored)
    assert all(near(fast[i], slow[i]) for i in slow)
    assert fold > 10 * arrow, (fold, arrow)
