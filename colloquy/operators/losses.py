"""Masked, weighted losses and training metrics.

Rows are tokens: sample, channel (0: text, 1-16: audio), frame, target, valid, ce, and the
sample's prompt_length and the frame's context flag.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PADDING_IDS = (3, 0)
RANGE = 4096  # steps of a run that one window reaches over


def cross_entropy(logits: Column, target: Column) -> Column:
    """-log softmax(logits)[target] by log-sum-exp."""
    def of(top: Column) -> Column:  # computed once; inside the fold it would be at every entry
        return top + F.log(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top))) - F.element_at(logits, target + 1)

    return F.element_at(F.transform(F.array(F.array_max(logits)), of), 1)


ROWS_BYTES = 16 << 20  # logits that are looked at together
BLOCK = 4096  # entries of the vocabulary in one step


def _streamed(x: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(log-sum-exp, first place of the maximum) of the rows, block by block: a running maximum and a sum scaled to it."""
    top, total, at = np.full(len(x), -np.inf), np.zeros(len(x)), np.zeros(len(x), np.int64)
    for k in range(0, x.shape[1], block):
        part = x[:, k : k + block].astype(np.float64)
        here = part.argmax(1)
        most = part[np.arange(len(x)), here]
        at = np.where(most > top, k + here, at)
        new = np.maximum(top, most)
        base = np.where(np.isfinite(new), new, 0.0)
        with np.errstate(invalid="ignore"):
            total = total * np.exp(np.where(np.isfinite(top), top - base, -np.inf)) + np.exp(part - base[:, None]).sum(1)
        top = new
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isfinite(top), top, 0.0) + np.log(total), at


def _kernel(kept: list[str], block: int):
    def run(batches):
        for batch in batches:
            column, target = batch.column("_logits"), batch.column("_target")
            values = column.flatten().to_numpy(zero_copy_only=False)
            length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            starts, wanted = np.cumsum(length) - length, target.fill_null(-1).to_numpy(zero_copy_only=False)
            ce, best = np.full(len(length), np.nan), np.full(len(length), -1, np.int64)
            for v in np.unique(length[length > 0]):  # usually one vocabulary
                rows = np.flatnonzero(length == v)
                step = max(1, ROWS_BYTES // (8 * int(v)))
                for k in range(0, len(rows), step):
                    some = rows[k : k + step]
                    whole = some[-1] - some[0] + 1 == len(some)
                    x = values[starts[some[0]] : starts[some[-1]] + v].reshape(-1, v) if whole else np.stack([values[s : s + v] for s in starts[some]])
                    lse, at = _streamed(x, block)
                    best[some] = at
                    ok = (wanted[some] >= 0) & (wanted[some] < v)
                    ce[some[ok]] = lse[ok] - x[np.flatnonzero(ok), wanted[some[ok]]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(ce, mask=np.isnan(ce) & ((length == 0) | (wanted < 0) | (wanted >= length))), pa.array(best, mask=best < 0)], [*kept, "ce", "predicted"])

    return run


def cross_entropy_wide(rows: DataFrame, logits: str = "logits", target: str = "target", block: int = BLOCK) -> DataFrame:
    """rows without the logits, with ce and predicted (place of the largest logit, the first of equals), for large vocabularies.

    Batches are flat Arrow buffers; a row's logits are read once.  A null or empty list and a target outside it give null.
    """
    kept = [c for c in rows.columns if c not in (logits, "ce", "predicted")]
    given = rows.select(*[f"`{c}`" for c in kept], F.col(f"`{logits}`").alias("_logits"), F.col(f"`{target}`").cast("long").alias("_target"))
    out = T.StructType([*rows.select(*[f"`{c}`" for c in kept]).schema, T.StructField("ce", T.DoubleType()), T.StructField("predicted", T.LongType())])
    return given.mapInArrow(_kernel(kept, block), out)


def seen_target() -> Column:
    """Targets at invalid positions count as 0, before padding is looked for."""
    return F.when(F.col("valid"), F.col("target")).otherwise(0)


def loss_weights(text_padding_weight: float, first_codebook: float, per_stream: int = 8, padding=PADDING_IDS) -> Column:
    is_text = F.col("channel") == 0
    by_kind = (
        F.when(is_text & seen_target().isin(*padding), text_padding_weight)
        .when(~is_text & ((F.col("channel") - 1) % per_stream == 0), first_codebook).otherwise(1.0)
    )
    shown = F.col("valid") & (F.col("frame") >= F.col("prompt_length")) & ~(is_text & F.col("context"))
    return F.when(shown, by_kind).otherwise(0.0)


def weighted_loss(rows: DataFrame, weight: Column, *by: str) -> DataFrame:
    """Sum of ce*w where w > 0, over the sum of w (1 at least), of each mode."""
    mode = F.when(F.col("channel") == 0, "text").otherwise("audio").alias("mode")
    out = rows.withColumn("w", weight).groupBy(*by, mode).agg(F.sum(F.when(F.col("w") > 0, F.col("ce") * F.col("w")).otherwise(0.0)).alias("s"), F.sum("w").alias("w"))
    return out.select(*by, "mode", F.round(F.col("s") / F.greatest("w", F.lit(1.0)), 6).alias("loss"))


def text_diagnostics(rows: DataFrame, *by: str, padding=PADDING_IDS) -> DataFrame:
    """Mean ce on real and on padding tokens, without weights; ce outside the mask never counts, NaN or not."""
    shown = F.col("valid") & (F.col("frame") >= F.col("prompt_length")) & ~F.col("context")
    pad = seen_target().isin(*padding)
    mean = lambda m: F.round(F.coalesce(F.sum(F.when(m, F.col("ce"))), F.lit(0.0)) / F.greatest(F.count(F.when(m, 1)), F.lit(1)), 6)
    n = lambda m: F.count(F.when(m, 1))
    out = rows.where("channel = 0").groupBy(*by).agg(
        mean(shown & ~pad).alias("real_loss"), mean(shown & pad).alias("pad_loss"), n(shown & ~pad).alias("real_count"), n(shown & pad).alias("pad_count"))
    return out.withColumn("real_pct", F.round(F.when(F.col("real_count") + F.col("pad_count") > 0, 100.0 * F.col("real_count") / (F.col("real_count") + F.col("pad_count"))).otherwise(0.0), 6))


def per_codebook_loss(rows: DataFrame) -> DataFrame:
    """Unweighted mean of each audio channel, 0 where nothing is shown; context is not masked."""
    shown = F.col("valid") & (F.col("frame") >= F.col("prompt_length"))
    n = F.count(F.when(shown, 1))
    return rows.where("channel > 0").groupBy("channel").agg(F.round(F.when(n > 0, F.sum(F.when(shown, F.col("ce"))) / n).otherwise(0.0), 6).alias("loss"))


def pad_prediction_rate(rows: DataFrame, logits: Column, padding=PADDING_IDS) -> DataFrame:
    best = F.array_position(logits, F.array_max(logits)) - 1
    return rows.agg(F.round(100.0 * F.avg(best.isin(*padding).cast("double")), 6).alias("pad_pct"), F.count("*").alias("n"))


def eval_summary(batches: DataFrame, cap: int, base: float = 2.0, divisor: str = "reference") -> DataFrame:
    """batches(rank, seq, text, audio): the first `cap` of each rank.

    divisor='reference' also counts the batch at which a rank stops; 'seen' counts those
    summed.  Perplexity is base**loss although losses are in nats; base=e would match them.
    """
    seen = F.col("seq") < cap
    counted = seen if divisor == "seen" else F.col("seq") <= cap
    n = F.count(F.when(counted, 1))
    text, audio = (F.sum(F.when(seen, F.col(c))) / n for c in ("text", "audio"))
    return batches.agg(
        F.round(text, 6).alias("text_loss"), F.round(audio, 6).alias("audio_loss"), F.round(text + audio, 6).alias("total_loss"),
        F.round(F.pow(F.lit(base), text + audio), 6).alias("perplexity"))


def total_loss(text: Column, audio: Column, share: float) -> Column:
    return text + share * audio if share > 0 else text


def _range() -> Column:
    return F.floor(F.col("step") / RANGE)


def running_sums(rows: DataFrame, sums: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """rows with run_<c>: the sum of c up to the row's step, within `by`.

    Steps are cut in ranges; sums of whole ranges are the offsets, and a window reaches over
    one range only, so that a run of any length is spread over tasks.
    """
    rows = rows.withColumn("_r", _range())
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*by, "_r").agg(*[F.sum(c).alias(c) for c in sums]).select(*by, "_r", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_o_{c}") for c in sums])
    within = Window.partitionBy(*by, "_r").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(c).over(within).alias(f"_l_{c}") for c in sums]).join(offsets, [*by, "_r"])
    for c in sums:
        out = out.withColumn(f"run_{c}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    return out.drop("_r", *[f"_{k}_{c}" for k in "ol" for c in sums])


def train_log_ratios(steps: DataFrame, max_steps: int, steps_per_epoch: float, *by: str) -> DataFrame:
    """steps(by, step, real, pad, in_window, placed, requested, put, ctx_frames, frames, words, seconds) with the shares, rates
    and times of a training log; a share of nothing is null."""
    share = lambda a, b, n=4: F.round(F.try_divide(F.lit(100.0) * F.col(a), b), n)
    out = running_sums(steps, ("words", "seconds"), by)
    return out.select(
        *by, "step", share("real", F.col("real") + F.col("pad")).alias("real_token_pct"), F.round(F.lit(100.0) * F.col("step") / max_steps, 4).alias("percent_done"),
        F.round(F.col("step") / F.lit(float(steps_per_epoch)), 6).alias("epoch"), share("ctx_frames", F.col("frames")).alias("ctx_injected_pct"),
        share("placed", F.col("in_window")).alias("inj_place_rate"), share("put", F.col("requested")).alias("inj_token_yield"),
        F.round(F.try_divide("words", "seconds"), 4).alias("wps"), F.round(F.try_divide("run_words", "run_seconds"), 4).alias("avg_wps"),
        F.round(F.try_divide((F.lit(max_steps) - F.col("step")) * F.col("run_seconds"), "step"), 2).alias("eta_in_seconds"))


def rank_average(rows: DataFrame, value: str, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.round(F.avg(value), 6).alias("mean"))


def eval_join(evals: DataFrame, logs: DataFrame, *by: str) -> DataFrame:
    """Each eval with the train loss of the last log at or before its step.

    Union and a window over a range of steps: last(..., ignore nulls) carries the log along, so
    no range join is needed; the last log of the ranges before stands in where the range has
    none yet.
    """
    a = logs.select(*by, "step", F.col("loss").alias("train_loss"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("eval_loss"))
    b = evals.select(*by, "step", F.lit(None).cast("double").alias("train_loss"), F.lit(1).alias("kind"), F.col("loss").alias("eval_loss"))
    both = a.unionByName(b).withColumn("_r", _range())
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*by, "_r").agg(F.max_by("train_loss", F.when(F.col("kind") == 0, F.col("step"))).alias("_c"))
    carried = carried.select(*by, "_r", F.last("_c", True).over(before).alias("_c"))
    w = Window.partitionBy(*by, "_r").orderBy("step", "kind").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_l", F.last("train_loss", True).over(w)).where("kind = 1").join(carried, [*by, "_r"])
    return out.select(*by, "step", "eval_loss", F.coalesce("_l", "_c").alias("train_loss"))
