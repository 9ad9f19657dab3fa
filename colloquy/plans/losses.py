"""Registered queries: losses and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import losses as M
from colloquy.sources.views import view

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_SEEN = "(case when valid then target else 0 end)"
_W = f"""(case when valid and frame >= prompt_length and not (channel = 0 and context) then case when channel = 0 and {_SEEN} in (3, 0) then 0.5e0
  when channel > 0 and (channel - 1) % 8 = 0 then 100e0 else 1e0 end else 0e0 end)"""


def _tokens(spark, d):
    return view(spark, d, "fx_token_ce")


@query("select vec_id, target, round(m + ln(list_sum(list_transform(x, lambda v: exp(v - m)))) - x[target + 1], 6) as ce from (select vec_id, cast(vec_id % 64 as int) as target, list_transform(embedding, lambda v: v::double) as x, list_max(embedding)::double as m from embeddings)")
def cross_entropy(spark, d):
    x = F.transform("embedding", lambda v: v.cast("double"))
    target = (F.col("vec_id") % 64).cast("int")
    return view(spark, d, "embeddings").select("vec_id", target.alias("target"), F.round(M.cross_entropy(x, target), 6).alias("ce"))


@query("""select vec_id, target, list_position(x, m) - 1 as predicted, case when target < 64 then round(m + ln(list_sum(list_transform(x, lambda v: exp(v - m)))) - x[target + 1], 6) end as ce
  from (select vec_id, cast(vec_id % 65 as int) as target, list_transform(embedding, lambda v: v::double) as x, list_max(embedding)::double as m from embeddings)""")
def cross_entropy_wide(spark, d):
    """The Arrow kernel, in blocks of 16 logits; one target in 65 lies outside the vocabulary."""
    rows = view(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 65).cast("int").alias("target"), F.col("embedding").alias("logits"))
    return M.cross_entropy_wide(rows, block=16).select("vec_id", "target", "predicted", F.round("ce", 6).alias("ce"))


@query(f"select channel, target, count(*) as n, round(sum({_W}), 4) as w from fx_token_ce group by channel, target")
def loss_weights(spark, d):
    return _tokens(spark, d).withColumn("w", M.loss_weights(0.5, 100.0)).groupBy("channel", "target").agg(F.count("*").alias("n"), F.round(F.sum("w"), 4).alias("w"))


@query(f"""select batch, mode, round(s / greatest(w, 1e0), 6) as loss from (select sample // 50 as batch, case when channel = 0 then 'text' else 'audio' end as mode,
  sum(case when {_W} > 0 then ce * {_W} else 0 end) as s, sum({_W}) as w from fx_token_ce group by all)""")
def weighted_loss(spark, d):
    rows = _tokens(spark, d).withColumn("batch", F.floor(F.col("sample") / 50))
    return M.weighted_loss(rows, M.loss_weights(0.5, 100.0), "batch")


_SHOWN = "(valid and frame >= prompt_length and not context)"


@query(f"""select *, round(case when real_count + pad_count > 0 then 100e0 * real_count / (real_count + pad_count) else 0 end, 6) as real_pct from (select batch,
  round(coalesce(sum(ce) filter (s and not p), 0) / greatest(count(*) filter (s and not p), 1), 6) as real_loss, round(coalesce(sum(ce) filter (s and p), 0) / greatest(count(*) filter (s and p), 1), 6) as pad_loss,
  count(*) filter (s and not p) as real_count, count(*) filter (s and p) as pad_count from (select sample // 50 as batch, ce, {_SHOWN} as s, {_SEEN} in (3, 0) as p from fx_token_ce where channel = 0) group by batch)""")
def text_diagnostics(spark, d):
    return M.text_diagnostics(_tokens(spark, d).withColumn("batch", F.floor(F.col("sample") / 50)), "batch")


@query("select channel, round(case when count(*) filter (s) > 0 then sum(ce) filter (s) / count(*) filter (s) else 0 end, 6) as loss from (select channel, ce, valid and frame >= prompt_length as s from fx_token_ce where channel > 0) group by channel")
def per_codebook_loss(spark, d):
    return M.per_codebook_loss(_tokens(spark, d))


@query("select round(100 * avg(case when list_position(embedding, list_max(embedding)) - 1 in (3, 0, 17) then 1e0 else 0e0 end), 6) as pad_pct, count(*) as n from embeddings")
def pad_prediction_rate(spark, d):
    return M.pad_prediction_rate(view(spark, d, "embeddings"), F.col("embedding"), (3, 0, 17))


_BATCHES = "(select sample % 4 as rank, row_number() over (partition by sample % 4 order by sample) - 1 as seq, text, audio from (select sample, avg(ce) filter (channel = 0) as text, avg(ce) filter (channel > 0) as audio from fx_token_ce group by sample) where text is not null and audio is not null)"


@query(f"select round(sum(text) filter (seq < 40) / count(*) filter (seq <= 40), 6) as text_loss, round(sum(audio) filter (seq < 40) / count(*) filter (seq <= 40), 6) as audio_loss, round(sum(text + audio) filter (seq < 40) / count(*) filter (seq <= 40), 6) as total_loss, round(pow(2e0, sum(text + audio) filter (seq < 40) / count(*) filter (seq <= 40)), 6) as perplexity from {_BATCHES}")
def eval_summary(spark, d):
    from pyspark.sql import Window

    avg = lambda m: F.avg(F.when(m, F.col("ce")))
    by = _tokens(spark, d).groupBy("sample").agg(avg(F.col("channel") == 0).alias("text"), avg(F.col("channel") > 0).alias("audio")).where("text is not null and audio is not null")
    by = by.withColumn("rank", F.col("sample") % 4)
    by = by.withColumn("seq", F.row_number().over(Window.partitionBy("rank").orderBy("sample")) - 1).where("seq <= 40")  # a top-k of each rank
    return M.eval_summary(by, 40)


@query("select sample, round(text + 0.3141592653e0 * audio, 6) as total, round(text, 6) as text_only from (select sample, sum(ce) filter (channel = 0) as text, sum(ce) filter (channel > 0) as audio from fx_token_ce group by sample)")
def total_loss(spark, d):
    s = lambda m: F.sum(F.when(m, F.col("ce")))
    rows = _tokens(spark, d).groupBy("sample").agg(s(F.col("channel") == 0).alias("text"), s(F.col("channel") > 0).alias("audio"))
    return rows.select("sample", F.round(M.total_loss(F.col("text"), F.col("audio"), 0.3141592653), 6).alias("total"), F.round(M.total_loss(F.col("text"), F.col("audio"), 0.0), 6).alias("text_only"))


_STEPS = """(select tag, step, cast(floor(loss * 10) as bigint) as real, step % 7 as pad, step % 6 as in_window, step % 5 as placed, step % 50 as requested, step % 40 as put, step % 120 as ctx_frames, 500 as frames,
  step % 100 + 1 as words, 0.1234567e0 + step % 13 / 9.8765e0 as seconds from fx_metrics)"""
_PCT = lambda a, b: f"round(100e0 * {a} / nullif({b}, 0), 4)"


@query(f"""select tag, step, {_PCT('real', '(real + pad)')} as real_token_pct, round(100e0 * step / 8000, 4) as percent_done, round(step / 340e0, 6) as epoch, {_PCT('ctx_frames', 'frames')} as ctx_injected_pct,
  {_PCT('placed', 'in_window')} as inj_place_rate, {_PCT('put', 'requested')} as inj_token_yield, round(words / seconds, 4) as wps, round(sw / ss, 4) as avg_wps, round((8000 - step) * ss / nullif(step, 0), 2) as eta_in_seconds
  from (select *, sum(words) over w as sw, sum(seconds) over w as ss from {_STEPS} window w as (partition by tag order by step rows unbounded preceding))""")
def train_log_ratios(spark, d):
    c = F.col("step")
    steps = view(spark, d, "fx_metrics").select(
        "tag", "step", F.floor(F.col("loss") * 10).alias("real"), (c % 7).alias("pad"), (c % 6).alias("in_window"), (c % 5).alias("placed"), (c % 50).alias("requested"), (c % 40).alias("put"),
        (c % 120).alias("ctx_frames"), F.lit(500).alias("frames"), (c % 100 + 1).alias("words"), (0.1234567 + c % 13 / 9.8765).alias("seconds"))
    return M.train_log_ratios(steps, 8000, 340, "tag")


@query("select step // 8 as step, tag, round(avg(loss), 6) as mean from fx_metrics group by all")
def rank_average(spark, d):
    return M.rank_average(view(spark, d, "fx_metrics").withColumn("step", F.floor(F.col("step") / 8)), "loss", "step", "tag")


# every event is a step that is evaluated; those of even value were logged
@query("select tag, step, loss as eval_loss, last_value(case when cast(floor(loss) as bigint) % 2 = 0 then loss / 2 end ignore nulls) over (partition by tag order by step rows unbounded preceding) as train_loss from fx_metrics")
def eval_join(spark, d):
    m = view(spark, d, "fx_metrics")
    logs = m.where(F.floor("loss") % 2 == 0).withColumn("loss", F.col("loss") / 2)
    return M.eval_join(m, logs, "tag")
