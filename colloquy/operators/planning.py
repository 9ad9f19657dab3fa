"""The grid of users and dialogues, topics, seeds, voices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions.hashing import stable_hash, stable_index
from colloquy.operators.samples import numbered_by_source


def parse_emotions(text: str, known: tuple[str, ...] = R.EMOTIONS) -> list[str]:
    found = [e.strip().lower() for e in text.split(",") if e.strip()]
    if not found or (odd := [e for e in found if e not in known]):
        raise ValueError(f"unknown or no emotions: {text!r}" if not found else f"unknown emotions: {odd}")
    return found


def emotions(spark, chosen=R.EMOTIONS) -> DataFrame:
    return spark.createDataFrame([(e, R.EMOTIONS.index(e)) for e in chosen], "emotion string, ord int")


def user_plan(indices: DataFrame, chosen=R.EMOTIONS) -> DataFrame:
    """indices(index) x emotions -> user_id, curr_emotion, ord, index.  The emotions are a few literals."""
    grid = indices.crossJoin(F.broadcast(emotions(indices.sparkSession, chosen)))  # four rows at most
    return grid.select(F.format_string("user_%s_%03d", "emotion", "index").alias("user_id"), F.col("emotion").alias("curr_emotion"), "ord", "index")


def duplex_plan(users: DataFrame, chosen=R.EMOTIONS) -> DataFrame:
    res = emotions(users.sparkSession, chosen).select(F.col("emotion").alias("res_emotion"))
    return users.crossJoin(F.broadcast(res)).withColumn("id", F.format_string("%s_%s_%03d", "curr_emotion", "res_emotion", "index"))


def with_topic(users: DataFrame, bank: DataFrame) -> DataFrame:
    """bank(pos, topic), pos from 0: the topic at (index + place of the emotion) modulo the bank's size."""
    size = bank.agg(F.count("*").alias("bank_size"))
    keyed = users.crossJoin(F.broadcast(size)).withColumn("pos", F.pmod(F.col("index") + F.col("ord"), F.col("bank_size")))  # one row
    return keyed.join(bank, "pos").drop("pos", "bank_size")


def derived_seed(base: int, key: str | Column, span: int = 100_000) -> Column:
    return F.lit(base) + stable_hash(key) % span


def pick_voices(users: DataFrame, voices: DataFrame) -> DataFrame:
    """users(user_id), voices(pos, name, gender) -> user_voice, agent_voice.

    Voices are numbered within their pools (all, women, men), and a user's number in its pool
    follows from the id, so that voices come by joins on (pool, number), whatever their count.
    Where the agent would get the user's voice it takes one of the others: the number among
    all voices skips those of that name.
    """
    every = voices.select(F.lit("every").alias("source"), F.struct("pos", "name").alias("item"))
    of = lambda g: voices.where(F.col("gender") == g).select(F.lit(g).alias("source"), F.struct("pos", "name").alias("item"))
    pools = numbered_by_source(every.unionByName(of("F")).unionByName(of("M"))).select("source", "j", F.col("item.name").alias("name"))
    n = lambda g: F.count(F.when(F.col("gender") == g, 1))
    sizes = voices.agg(F.count("*").alias("n_every"), n("F").alias("n_women"), n("M").alias("n_men"))
    female = stable_index(F.concat("user_id", F.lit(":user_gender")), 2) == 1
    both = (F.col("n_women") > 0) & (F.col("n_men") > 0)
    size = lambda pool: F.when(pool == "F", F.col("n_women")).when(pool == "M", F.col("n_men")).otherwise(F.col("n_every"))
    at = lambda key, of: stable_index(F.concat("user_id", F.lit(key)), F.greatest(of, F.lit(1)))
    two = F.col("n_every") == 2
    out = users.crossJoin(F.broadcast(sizes))  # one row
    out = out.withColumn("u_pool", F.when(both & ~two, F.when(female, "F").otherwise("M")).otherwise("every"))
    out = out.withColumn("a_pool", F.when(both & ~two, F.when(female, "M").otherwise("F")).otherwise("every"))
    out = out.withColumn("u_at", F.when(two, F.lit(1)).otherwise(at(":user_voice", size(F.col("u_pool"))))).withColumn("a_at", F.when(two, F.lit(0)).otherwise(at(":agent_voice", size(F.col("a_pool")))))
    voice = lambda pool, j, name: pools.select(F.col("source").alias(pool), F.col("j").alias(j), F.col("name").alias(name))
    out = out.join(voice("u_pool", "u_at", "user_voice"), ["u_pool", "u_at"], "left").join(voice("a_pool", "a_at", "first"), ["a_pool", "a_at"], "left")
    own = pools.where("source = 'every'").groupBy(F.col("name").alias("user_voice")).agg(F.array_sort(F.collect_list("j")).alias("own"))  # voices of one name
    again = (F.col("first") == F.col("user_voice")) & ~two & (F.col("n_every") > F.size("own"))
    skipping = F.aggregate("own", at(":agent_voice_alt", F.col("n_every") - F.size("own")), lambda k, p: k + F.when(p <= k, 1).otherwise(0).cast("long"))
    out = out.join(own, "user_voice", "left").withColumn("alt_at", F.when(again, skipping))
    alts = pools.where("source = 'every'").select(F.col("j").alias("alt_at"), F.col("name").alias("alt"))
    out = out.join(alts, "alt_at", "left").withColumn("agent_voice", F.when(again, F.col("alt")).otherwise(F.col("first")))
    return out.select(*[F.col(f"`{c}`") for c in users.columns], "user_voice", "agent_voice")
