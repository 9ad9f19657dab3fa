"""Dialogues to clips, manifests and the train/validation split."""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.samples import global_index

SHUFFLED = 1_000_000  # indices that may be shuffled on the driver


def users_from_dialogues(dialogues: DataFrame) -> DataFrame:
    """The user record of each user_id's first dialogue, in the order of pos, then id."""
    record = F.struct("curr_emotion", F.col("user_text").alias("text"))
    first = dialogues.groupBy("user_id").agg(F.min_by(record, F.struct("pos", "id")).alias("r"))
    return first.select("user_id", "r.curr_emotion", "r.text")


def resolve_users(dialogues: DataFrame, users: DataFrame) -> DataFrame:
    """dialogues with the text of their user; a user that is missing is made from the dialogue."""
    known = users.select("user_id", F.col("text").alias("known"))
    out = dialogues.join(known, "user_id", "left")
    return out.withColumn("resolved_text", F.coalesce("known", "user_text")).withColumn("was_known", F.col("known").isNotNull()).drop("known")


def pending_work(dialogues: DataFrame, done: DataFrame, forced: tuple[str, ...] = ()) -> DataFrame:
    """Dialogues without both outputs, and those of the forced reply emotions."""
    ready = done.where("has_wav and has_sidecar").select("id")
    again = F.col("res_emotion").isin(*forced) if forced else F.lit(False)
    return dialogues.where(~again).join(ready, "id", "left_anti").unionByName(dialogues.where(again))


def regen_filter(dialogues: DataFrame, res: tuple[str, ...]) -> DataFrame:
    if not res:
        raise ValueError("no reply emotions given")
    return dialogues.where(F.col("res_emotion").isin(*res))


def reuse_user_take(dialogues: DataFrame, takes: DataFrame) -> DataFrame:
    """takes(user_id, take_sec, cached): one for each user, shared by its replies; empty ones are made anew."""
    good = takes.where("take_sec > 0")
    users = dialogues.select("user_id").distinct().join(good, "user_id", "left")
    return dialogues.join(users, "user_id").withColumn("reused", F.col("take_sec").isNotNull())


def collect_clips(dialogues: DataFrame, wavs: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Manifest rows of dialogues that have both files; a duration that cannot be read is 0.0."""
    both = dialogues.join(wavs.select("id"), "id", "left_semi").join(sidecars.select("id", "duration"), "id")
    return both.select("id", "curr_emotion", "res_emotion", F.coalesce("duration", F.lit(0.0)).alias("duration"))


def duplex_index(clip_id):
    return F.substring_index(clip_id, "_", -1).cast("long")


def res_emotion(styled, top, path, known):
    """Reply emotion of a sidecar: its own field, else the top-level one, else the second part of the stem."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    part = F.try_element_at(parts, F.lit(2))
    norm = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    return F.coalesce(norm(styled), norm(top), F.when((F.size(parts) >= 3) & part.isin(*known), part))


def patch_prompts(sidecars: DataFrame, emotion, prompt, known) -> DataFrame:
    """sidecars(text_prompt) with the prompt of their emotion and what was done: updated, unchanged or skipped."""
    out = sidecars.withColumn("_e", emotion)
    ok = F.col("_e").isin(*known) & F.col("readable")
    done = F.when(~F.coalesce(ok, F.lit(False)), "skipped").when(F.col("text_prompt").eqNullSafe(prompt(F.col("_e"))), "unchanged").otherwise("updated")
    return out.withColumn("outcome", done).withColumn("text_prompt", F.when(F.col("outcome") == "updated", prompt(F.col("_e"))).otherwise(F.col("text_prompt"))).drop("_e")


def mapping_stats(clips: DataFrame) -> DataFrame:
    """Clips and seconds of each pair of emotions.  Ids stay in the clip table: a list of them has no bound."""
    key = F.concat_ws("->", "curr_emotion", "res_emotion").alias("mapping")
    return clips.groupBy(key).agg(F.count("*").alias("n"), F.round(F.sum("duration"), 4).alias("total_sec"))


def emotion_cube(clips: DataFrame) -> DataFrame:
    out = clips.cube("curr_emotion", "res_emotion").agg(F.count("*").alias("n"), F.round(F.sum("duration"), 4).alias("total_sec"), F.grouping_id().alias("level"))
    return out.select(*[F.coalesce(c, F.lit("all")).alias(c) for c in ("curr_emotion", "res_emotion")], "level", "n", "total_sec")


def target(clips: DataFrame, fraction: float) -> tuple[int, int]:
    """(clips of the smallest mapping, how many of each mapping are held out)."""
    least = clips.groupBy("curr_emotion", "res_emotion").agg(F.count("*").alias("n")).agg(F.min("n")).first()[0] or 0
    return least, min(max(math.floor(least * fraction + 0.5), 0), least - 1) if least > 1 and fraction > 0 else 0


def held_out(clips: DataFrame, fraction: float, seed: int, mode: str = "hash") -> DataFrame:
    """(index): those held out in every mapping.

    k = fraction of the smallest mapping, rounded half up, at most all but one (target()).  Mode
    hash takes the k of 0..m-1 whose hash is lowest, by their places in a global order; mode
    shuffle takes the first k of a seeded shuffle of that range, on the driver, for at most
    SHUFFLED indices.
    """
    spark = clips.sparkSession
    least, k = target(clips, fraction)
    if mode == "shuffle":
        if least > SHUFFLED:
            raise ValueError(f"more than {SHUFFLED} indices: take mode 'hash'")
        order = list(range(least))
        random.Random(seed).shuffle(order)
        return spark.createDataFrame([(i,) for i in order[:k]], "index long")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    return global_index(spark.range(least).withColumn("key", key), "key", "id").where(F.col("i") < k).select(F.col("id").alias("index"))


def balanced_split(clips: DataFrame, fraction: float, seed: int, mode: str = "hash") -> DataFrame:
    """clips(id, ...) with index and split ('train' or 'val').  All replies of an index fall on one side."""
    out = clips.withColumn("index", duplex_index(F.col("id")))
    val = held_out(clips, fraction, seed, mode).withColumn("val", F.lit(True))
    return out.join(val, "index", "left").withColumn("split", F.when(F.col("val"), "val").otherwise("train")).drop("val")


def split_report(split: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Clips of each mapping on either side and in all, with what the split was asked for."""
    n = lambda s: F.count(F.when(F.col("split") == s, 1)).alias(s)
    out = split.rollup(F.concat_ws("->", "curr_emotion", "res_emotion").alias("mapping")).agg(n("train"), n("val"))
    asked = [F.lit(fraction).alias("val_fraction"), F.lit(target(split, fraction)[1]).cast("long").alias("target_val_per_mapping"), F.lit(seed).alias("seed")]
    return out.select(F.coalesce("mapping", F.lit("all")).alias("mapping"), "train", "val", *asked)


def val_indices(split: DataFrame) -> DataFrame:
    """The indices held out that occur."""
    return split.where("split = 'val'").select("index").distinct()


def split_leakage(split: DataFrame) -> DataFrame:
    """Users on both sides: none, if the split is right; one row with the count and the users seen."""
    sides = split.groupBy("user_id").agg(F.count_distinct("split").alias("sides"))
    return sides.agg(F.count("*").alias("n_users"), F.count(F.when(F.col("sides") > 1, 1)).alias("n_leaking"))


def slim_manifest(split: DataFrame, side: str) -> DataFrame:
    """path and duration in the order of mapping, then index."""
    return split.where(F.col("split") == side).orderBy(F.concat_ws("->", "curr_emotion", "res_emotion"), "index").select("path", "duration")
