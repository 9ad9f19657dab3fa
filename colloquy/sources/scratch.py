"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir.

They are Parquet: unlike a local checkpoint they survive the loss of executors.  What is
written here is deleted when the driver's process ends.
"""

from __future__ import annotations

import atexit
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, weakref.ref] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session (tests, a laptop) may leave it unset and gets one beside its warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def new_path(spark: SparkSession, kind: str = "colloquy") -> str:
    """A path for one table, deleted at the end."""
    path = f"{folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _written[path] = weakref.ref(spark)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever store it is."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone: the folder's owner cleans it
        pass


@atexit.register
def _delete_all() -> None:
    for path, ref in list(_written.items()):
        if (spark := ref()) is not None and spark.sparkContext._jsc is not None:
            delete(spark, path)


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet and read it back: its rows and their partition numbers are then fixed."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
