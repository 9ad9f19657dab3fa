"""Candidate lines to accepted texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions import text as T


def _case(on: Column, table: dict, other: Column) -> Column:
    out = other
    for k, v in reversed(table.items()):
        out = F.when(on == k, F.lit(v)).otherwise(out)
    return out


def _pair_case(a: Column, b: Column, table: dict, other: str) -> Column:
    out = F.lit(other)
    for (x, y), v in reversed(table.items()):
        out = F.when((a == x) & (b == y), F.lit(v)).otherwise(out)
    return out


def hint(curr: Column, res: Column) -> Column:
    return _pair_case(curr, res, R.HINTS, R.DEFAULT_HINT)


def user_fallback(emotion: Column, topic: Column) -> Column:
    return F.replace(_case(emotion, R.USER_FALLBACK, F.lit(R.USER_FALLBACK["neutral"])), F.lit("{topic}"), topic)


def agent_fallback(curr: Column, res: Column) -> Column:
    return _pair_case(curr, res, R.AGENT_FALLBACK, R.DEFAULT_AGENT_FALLBACK)


def validated(lines: DataFrame, text: str = "raw_text", emotion: str = "emotion") -> DataFrame:
    """lines with clean and reason (null: usable).  One projection, no shuffle."""
    out = lines.withColumn("clean", T.clean_utterance(F.col(text)))
    return out.withColumn("reason", T.reject_reason(F.col("clean"), F.col(emotion)))


def validated_replies(pairs: DataFrame) -> DataFrame:
    """pairs(user_text, agent_text, res) with clean and reason; the valence of usable replies is looked at last."""
    out = validated(pairs, "agent_text", "res")
    bad = T.valence_mismatch(F.col("user_text"), F.col("clean"))
    return out.withColumn("reason", F.coalesce("reason", F.when(bad, "valence")))


def accept(plan: DataFrame, candidates: DataFrame, fallback: Column) -> DataFrame:
    """plan(id, ...), candidates(id, attempt, clean, reason) -> plan with text and chosen.

    The usable line of the lowest attempt, else the fallback.  min_by combines map-side, so
    the shuffle carries one line for each id and task.
    """
    first = (
        candidates.where("reason is null").groupBy("id")
        .agg(F.min_by(F.struct("clean", "attempt"), F.struct("attempt", "clean")).alias("best"))
    )
    out = plan.join(first, "id", "left")
    chosen = F.when(F.col("best").isNull(), "fallback").when(F.col("best.attempt") == 0, "first").otherwise("retry")
    return out.withColumn("text", F.coalesce("best.clean", fallback)).withColumn("chosen", chosen).drop("best")


def reject_report(lines: DataFrame) -> DataFrame:
    """Counts by pair of emotions and reason, with subtotals; null keys of subtotals read 'all'."""
    out = lines.withColumn("outcome", F.coalesce("reason", F.lit("accepted"))).rollup("curr", "res", "outcome").agg(F.count("*").alias("n"))
    return out.select(*[F.coalesce(c, F.lit("all")).alias(c) for c in ("curr", "res", "outcome")], "n")


def _filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by its value; values are not looked into."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])


def agent_message(user_text: Column, curr: Column, res: Column, retry: bool = False) -> Column:
    out = _filled(R.AGENT_MESSAGE, user_text=user_text, curr=curr, res=res, hint=hint(curr, res))
    return F.concat(out, F.lit(R.RETRY_NOTE)) if retry else out


def user_message(emotion: Column, topic: Column, seed: Column) -> Column:
    return _filled(R.USER_MESSAGE, emotion=emotion, topic=topic, seed=seed)


def chat(system: str, content: Column) -> Column:
    """The messages given to a model: the system's text, then the user's."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", content))
