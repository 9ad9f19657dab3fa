"""Retry rounds: generate, validate, and generate anew for what was rejected.

Every round is a table of its own below a folder: the lines of its frontier with the reason
why they are not usable.  The frontier of a round is the rejects of the round before, so a
round costs what it still has to do.  A round that was written whole (Spark's _SUCCESS marker)
is read back instead of run: after a kill the loop goes on with the round that was lost, and
the result is that of a run without one, also if the generator draws at random.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND = "raw_text", "clean", "reason", "attempt"


def _written(folder: str, df: DataFrame) -> bool:
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_rounds(
    plan: DataFrame, generate: Callable[[DataFrame, int], DataFrame], validate: Callable[[DataFrame], DataFrame], folder: str, rounds: int = 2
) -> DataFrame:
    """plan(id, ...) -> the rows of all rounds: plan's columns, raw_text, clean, reason, attempt.

    generate(frontier, attempt) adds raw_text (null: the generator failed, reason `generator`);
    validate adds clean and reason.
    """
    spark, frontier, done = plan.sparkSession, plan, []
    for k in range(rounds):
        path = f"{folder}/round={k}"
        if not _written(path, plan):
            lines = validate(generate(frontier, k))
            lines = lines.withColumn("reason", F.when(F.col("raw_text").isNull(), "generator").otherwise(F.col("reason"))).withColumn("attempt", F.lit(k))
            lines.select(*[f"`{c}`" for c in plan.columns], *ROUND).write.mode("overwrite").parquet(path)
        now = spark.read.parquet(path)
        done.append(now)
        rejects = now.where("reason is not null")
        if rejects.isEmpty():
            break
        frontier = rejects.select(*[f"`{c}`" for c in plan.columns])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def accept_in_rounds(
    plan: DataFrame, generate: Callable[[DataFrame, int], DataFrame], validate: Callable[[DataFrame], DataFrame], fallback: Column, folder: str, rounds: int = 2
) -> DataFrame:
    """plan with text and chosen (first, retry, fallback).  Ids are distinct, so no join: a row is in the table of the round that accepted it,
    or a reject of the last one."""
    rows = run_rounds(plan, generate, validate, folder, rounds)
    last = rows.where((F.col("reason").isNull()) | (F.col("attempt") == rounds - 1))
    usable = F.col("reason").isNull()
    chosen = F.when(~usable, "fallback").when(F.col("attempt") == 0, "first").otherwise("retry")
    return last.withColumn("text", F.when(usable, F.col("clean")).otherwise(fallback)).withColumn("chosen", chosen).drop(*ROUND)


def round_report(rows: DataFrame) -> DataFrame:
    """Of each round how many lines were asked for, accepted, and rejected by reason."""
    return rows.groupBy("attempt", F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))
