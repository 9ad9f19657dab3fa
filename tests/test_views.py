from pyspark.sql import functions as F

from colloquy.sources.views import VIEWS, view


def test_candidates_hold_the_whole_text(spark):
    d = "/root/testdata/sf0.001"
    turns = view(spark, d, "conversations").select(F.concat(F.lit("p"), "conv_id", F.lit("_"), F.col("turn") - F.col("turn") % 2).alias("id"), (F.col("turn") % 2).alias("attempt"), "text")
    rows = view(spark, d, "fx_candidates").join(turns, ["id", "attempt"]).collect()
    assert len(rows) == turns.count() and any(len(r.text) > 260 for r in rows)
    assert all(r.text in r.raw_text or r.text.lower() in r.raw_text for r in rows)


def test_dialogues_join_by_a_key(spark):
    d = "/root/testdata/sf0.001"
    rows = view(spark, d, "fx_dialogues")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "user_id" in line]
    assert joins and not any("NestedLoop" in line or "Cartesian" in line for line in joins)
    text = spark.sql(VIEWS["fx_dialogues"], fx_clips=view(spark, d, "fx_clips"), customer=view(spark, d, "customer"))
    assert rows.count() == text.count() > 0 and rows.exceptAll(text).isEmpty() and text.exceptAll(rows).isEmpty()
