"""Tables in versions: a rewrite is a new folder, and then a pointer that is switched at once.

    folder/v=3/part-...      a version, written whole by Spark
    folder/_current          the number of the version that readers see

A run that fails leaves the old version readable: the pointer is replaced by one atomic rename
after the new folder is complete.  Two writers cannot take one number, as Spark does not
write into a folder that exists.  Readers that began before the switch go on reading their version;
drop_old() deletes versions when nobody reads them any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, folder: str) -> int | None:
    """The version that readers see; None if there is none yet."""
    p, fs = _path(spark, f"{folder}/{POINTER}")
    if not fs.exists(p):
        return None
    return int(_text(spark, p, fs))


def _text(spark: SparkSession, p, fs) -> str:
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, folder: str, whole: bool = True) -> list[int]:
    """Versions that were written whole, or all folders."""
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    found = sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v="))
    return [v for v in found if not whole or fs.exists(_path(spark, f"{folder}/v={v}/_SUCCESS")[0])]


def read(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    at = current(spark, folder) if version is None else version
    if at is None:
        raise ValueError(f"no version in {folder}")
    return spark.read.parquet(f"{folder}/v={at}")


def _switch(spark: SparkSession, folder: str, version: int) -> None:
    jvm = spark.sparkContext._jvm
    new, fs = _path(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(new)
    out.write(str(version).encode())
    out.close()
    to, _ = _path(spark, f"{folder}/{POINTER}")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, to, options)


def write(rows: DataFrame, folder: str) -> int:
    """rows as the next version, which readers then see."""
    spark = rows.sparkSession
    number = max(versions(spark, folder, whole=False), default=0) + 1  # a folder that a failed run left is passed over
    rows.write.mode("errorifexists").parquet(f"{folder}/v={number}")
    _switch(spark, folder, number)
    return number


def rewrite(spark: SparkSession, folder: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """The current version changed, as the next one."""
    return write(change(read(spark, folder)), folder)


def drop_old(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Deletes all but the newest `keep` whole versions up to the current one, and what failed runs left below it."""
    at = current(spark, folder)
    kept = [v for v in versions(spark, folder) if at is None or v <= at][-keep:]
    gone = [v for v in versions(spark, folder, whole=False) if at is not None and v < at and v not in kept]
    for v in gone:
        p, fs = _path(spark, f"{folder}/v={v}")
        fs.delete(p, True)
    return gone
