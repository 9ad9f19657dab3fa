"""Registered queries: takes, levels, packing.  The vectors of `embeddings` stand for waveforms at a low rate."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from colloquy.operators import audio as A
from colloquy.operators import timeline as L
from colloquy.operators import waves as B
from colloquy.sources.views import view

QUERIES, SQL = {}, {}
RATE = 200


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _takes(spark, d):
    return view(spark, d, "fx_takes")


_X = "(select id, take, n_chars, list_transform(pcm, lambda v: v::double) as x from fx_takes)"
_ENERGY = lambda x: f"list_transform(range(len({x}) // 4), lambda k: sqrt(list_sum(list_transform({x}[k * 4 + 1:k * 4 + 4], lambda v: v * v)) / 4 + 1e-12))"


@query(f"select id, take, k, round(e[k + 1], 6) as energy from (select id, take, e, unnest(range(len(e))) as k from (select id, take, {_ENERGY('x')} as e from {_X}))")
def frame_energies(spark, d):
    out = _takes(spark, d).select("id", "take", F.posexplode(A.frame_energies(A.doubles(F.col("pcm")), RATE)).alias("p", "e"))
    return out.select("id", "take", F.col("p").cast("long").alias("k"), F.round("e", 6).alias("energy"))


_SCORED = f"""(select *, case when len(x) < 30 or peak < 1e-4 or clip_share > 0.02 or silence_share > 0.65 then -1e6 else
    2.5 * (-abs(cps - 12.5) - case when cps < 4 or cps > 28 then 15 else 0 end) - 1.2 * abs(level_db + 18) + 4 * (list_aggregate(le, 'stddev_pop') + case when len(e) > 2 then 0.5 * list_aggregate(list_transform(range(1, len(le)), lambda i: le[i + 1] - le[i]), 'stddev_pop') else 0 end)
    - 8 * silence_share - 40 * clip_share - 0.5 * abs(peak - 0.7) end as score
  from (select *, list_transform(e, lambda v: ln(v + 1e-8)) as le, len(list_filter(x, lambda v: abs(v) > 0.99)) / len(x) as clip_share, len(list_filter(e, lambda v: v < 0.02)) / len(e) as silence_share,
      20 * log10(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x) + 1e-12) + 1e-12) as level_db, n_chars / (len(x) / {RATE}e0) as cps
    from (select *, {_ENERGY('u')} as e from (select *, list_transform(x, lambda v: v / greatest(peak, 1e-8)) as u from (select *, list_max(list_transform(x, lambda v: abs(v))) as peak from {_X})))))"""


@query(f"select id, take, round(peak, 6) as peak, round(level_db, 6) as level_db, round(silence_share, 6) as silence_share, round(score, 5) as score from {_SCORED}")
def score_take(spark, d):
    r = lambda c, n=6: F.round(c, n).alias(c)
    return A.scored(_takes(spark, d), RATE).select("id", "take", r("peak"), r("level_db"), r("silence_share"), r("score", 5))


@query(f"select id, take, round(score, 5) as score from (select *, row_number() over (partition by id order by score desc, take) as r from {_SCORED}) where r = 1")
def best_take(spark, d):
    return A.best_take(A.scored(_takes(spark, d), RATE)).select("id", "take", F.round("score", 5).alias("score"))


@query(f"select id, take, score <= -1e5 as weak from {_SCORED}")
def weak_takes(spark, d):
    return A.weak_takes(A.scored(_takes(spark, d), RATE)).select("id", "take", "weak")


@query(f"select id, take, k, round(x[k + 1] * (pow(10e0, -2.5e0) / sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x) + 1e-12)), 7) as v from (select *, unnest(range(len(x))) as k from {_X})")
def scale_dbfs(spark, d):
    out = _takes(spark, d).select("id", "take", F.posexplode(A.scale_dbfs(A.doubles(F.col("pcm")), -50.0)).alias("p", "x"))
    return out.select("id", "take", F.col("p").cast("long").alias("k"), F.round("x", 7).alias("v"))


@query(f"select id, take, k, round(case when m > 1e-6 then x[k + 1] * (0.95 / m) else x[k + 1] end, 6) as v from (select *, list_max(list_transform(x, lambda v: abs(v))) as m, unnest(range(len(x))) as k from {_X})")
def peak_normalize(spark, d):
    x = A.doubles(F.col("pcm"))
    out = _takes(spark, d).select("id", "take", F.posexplode(A.peak_normalize(x, A.peak(x))).alias("p", "x"))
    return out.select("id", "take", F.col("p").cast("long").alias("k"), F.round("x", 6).alias("v"))


_PAIR = f"(select a.id, a.x as u, b.x as g from {_X} a join {_X} b on a.id = b.id and a.take = 0 and b.take = 1)"


@query(f"""select id, len(u) + 41 + len(g) as n, round(len(u) / {RATE}e0 + 0.2049e0, 6) as agent_start, round(list_sum(list_transform(range(len(g)), lambda k: (len(u) + 41 + k) * g[k + 1])), 5) as left_moment,
  round(list_sum(list_transform(range(len(u)), lambda k: k * u[k + 1])), 5) as right_moment from {_PAIR}""")
def pack_pair(spark, d):
    t = _takes(spark, d)
    one, two = t.where("take = 0").select("id", A.doubles(F.col("pcm")).alias("u")), t.where("take = 1").select("id", A.doubles(F.col("pcm")).alias("g"))
    left, right, start = A.pack_pair(F.col("u"), F.col("g"), 0.2049, RATE)
    moment = lambda c: F.round(F.aggregate(F.transform(c, lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v), 5)
    out = one.join(two, "id").withColumn("l", left).withColumn("r", right)
    return out.select("id", F.size("l").cast("long").alias("n"), F.round(start, 6).alias("agent_start"), moment("l").alias("left_moment"), moment("r").alias("right_moment"))


@query("""select id, round(p / 24000e0, 6) as user_start, round((p + u) / 24000e0, 6) as user_end, round((p + u + 4801) / 24000e0, 6) as agent_start, round((p + u + 4801 + a) / 24000e0, 6) as agent_end, round((p + u + 4801 + a + q) / 24000e0, 6) as duration
  from (select id, cast(floor(duration * 1000) as bigint) as u, cast(floor(duration * 700) as bigint) as a, length(id) * 10 as p, length(path) * 7 as q from fx_clips)""")
def clip_timeline(spark, d):
    n = lambda c, k: F.floor(F.col(c) * k)
    cols = L.clip_timeline(n("duration", 1000), n("duration", 700), F.lit(0.20004), F.length("id") * 10, F.length("path") * 7, 24_000)
    out = view(spark, d, "fx_clips").select("id", *cols)
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("user_start", "user_end", "agent_start", "agent_end", "duration")])


_SUMS = "round(list_sum(list_transform(y, lambda v: abs(v::double))), 5) as total, round(list_sum(list_transform(range(len(y)), lambda i: y[i + 1]::double * i)), 4) as moment"


def _sums(y):
    x = A.doubles(F.col(y))
    return [F.size(y).cast("long").alias("n"), F.round(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.abs(v)), 5).alias("total"), F.round(F.aggregate(F.transform(x, lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v), 4).alias("moment")]


@query(f"""select id, take, len(y) as n, {_SUMS} from (select id, take, list_transform(range(m), lambda i: case when floor(i / m * n) >= n - 1 then x[len(x)]
    else (x[(floor(i / m * n) + 2)::int] - x[(floor(i / m * n) + 1)::int]) / ((floor(i / m * n) + 1) / n - floor(i / m * n) / n) * (i / m - floor(i / m * n) / n) + x[(floor(i / m * n) + 1)::int] end::float) as y
  from (select id, take, x, len(x)::double as n, greatest(round_even(len(x) * 1.5e0, 0)::int, 1) as m from {_X}))""")
def resample_linear(spark, d):
    return B.resampled(_takes(spark, d), 16_000, 24_000).select("id", "take", *_sums("pcm"))


@query(f"""select id, take, len(y) as n, {_SUMS} from (select id, take, list_transform(range(len(x)), lambda i: (x[i + 1] * case when i < 12 then sin(pi() / 2 * i / 11) when i >= len(x) - 12 then cos(pi() / 2 * (i - len(x) + 12) / 11) else 1 end)::float) as y from {_X})""")
def fade_edges(spark, d):
    return B.faded(_takes(spark, d), 12).select("id", "take", *_sums("pcm"))


@query(f"select id, take, round(peak, 6) as peak, round(level_db, 6) as level_db, round(clip_share, 6) as clip_share, round(silence_share, 6) as silence_share, round(score, 5) as score from {_SCORED}")
def score_waves(spark, d):
    """The scores over Arrow buffers."""
    r = lambda c, n=6: F.round(c, n).alias(c)
    return B.scored(_takes(spark, d), RATE).select("id", "take", r("peak"), r("level_db"), r("clip_share"), r("silence_share"), r("score", 5))


@query()
def sample_rng(spark, d):
    return B.pads(view(spark, d, "fx_clips").select("id"), 42).select("id", F.array("pad_pre", "pad_post").alias("pads"))


def _tone() -> np.ndarray:
    return (np.sin(np.arange(700) * 0.7) * 0.01).astype(np.float32)


@query()
def roomtone_crop(spark, d):
    """Each take behind a quiet tone is the room tone of its own clip."""
    tone = F.concat(F.lit(_tone().tolist()).cast("array<float>"), "pcm").alias("tone")
    return B.cropped(_takes(spark, d).select("id", "take", tone), 300, 42, RATE).select("id", "take", *_sums("crop"))


@query()
def pack_pool(spark, d):
    t = _takes(spark, d)
    both = t.where("take = 0").select("id", F.col("pcm").alias("user")).join(t.where("take = 1").select("id", F.col("pcm").alias("agent")), "id")
    out = B.packed_pool(both, _tone(), 42, 0.2, RATE)
    return out.select("id", *_sums("left"), *[c.alias(f"right_{k}") for k, c in zip(("n", "total", "moment"), _sums("right"))], "user_start", "agent_start", "agent_end", "duration")
