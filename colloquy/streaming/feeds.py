"""The two feeds as streams: dialogues that arrive as JSON lines, and the metric feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import texts as O
from colloquy.sources.io import METRICS
from colloquy.sources.scratch import materialize

ARRIVING = "id string, user_text string, agent_text string, res string, at timestamp"
JUDGED = "id string, at timestamp, accepted boolean, reason string, clean string"


def judged(rows: DataFrame) -> DataFrame:
    out = O.validated_replies(rows)
    return out.select("id", "at", F.col("reason").isNull().alias("accepted"), "reason", "clean")


def stream_accept(spark: SparkSession, folder: str, late: str = "1 hour") -> DataFrame:
    """Lines dropped into a folder, judged, each id once.  State is kept as long as lines may be late."""
    rows = spark.readStream.schema(ARRIVING).json(folder)
    return judged(rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["id"]))


def stream_accept_once(spark: SparkSession, folder: str, sink: str, checkpoint: str) -> None:
    """Everything that has arrived, judged and added to the sink, each id once for ever: an id that is in the sink already, from
    whatever run, is neither judged nor written again.

    Each micro-batch is a folder batch=<number> of the sink, overwritten if the batch is replayed after a failure.  The ids
    that the sink has are found by one pass over its id column, against the batch's own ids (the small side); the state of
    the stream holds nothing that grows.
    """

    def add(batch: DataFrame, number: int) -> None:
        one = materialize(batch.where("id is not null").groupBy("id").agg(F.min(F.struct("at", *[c for c in batch.columns if c not in ("id", "at")])).alias("r")).select("id", "r.*"))
        if _exists(batch.sparkSession, sink):
            before = batch.sparkSession.read.schema(JUDGED + ", batch long").parquet(sink).where(F.col("batch") != number)  # a replayed batch is not its own past
            known = materialize(before.select("id").join(one.select("id"), "id", "left_semi"))  # at most the batch's ids
            one = one.join(known, "id", "left_anti")
        judged(one).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    rows = spark.readStream.schema(ARRIVING).json(folder)
    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def windows(rows: DataFrame, width: str) -> DataFrame:
    out = rows.groupBy("tag", F.window("at", width).alias("w")).agg(F.count("*").alias("n"), F.round(F.avg("loss"), 6).alias("mean"), F.max("loss").alias("most"))
    return out.select("tag", F.col("w.start").alias("start"), "n", "mean", "most")


def stream_metrics(spark: SparkSession, folder: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling means of each tag; a window comes out once the watermark has passed it, later records are dropped."""
    rows = spark.readStream.schema(METRICS).json(folder)
    return windows(rows.withWatermark("at", late), width)


def run_to(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, to a Parquet sink."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
