import os
import pathlib

import pytest
from pyspark.sql import functions as F

from colloquy.sources import files


def names(top):
    return sorted(p.name for p in pathlib.Path(top).rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_files_come_back(spark, tmp_path):
    rows = spark.range(40).repartition(5).select(F.concat("id", F.lit(".bin")).alias("name"), F.col("id").cast("string").cast("binary").alias("content"))
    files.write_files(rows, f"file://{tmp_path}/out")
    got = files.read_files(spark, f"{tmp_path}/out", "*.bin")
    assert sorted((os.path.basename(r.path), bytes(r.content)) for r in got.collect()) == sorted((f"{k}.bin", str(k).encode()) for k in range(40))
    assert [p.name[:4] for p in (tmp_path / "out").iterdir()] == ["job-"]
    files.write_files(rows.limit(3), f"{tmp_path}/out")
    assert got.count() == 40 and len(names(tmp_path / "out")) == 43
    files.write_files(rows.limit(2), f"{tmp_path}/out", replace=True)
    assert len(names(tmp_path / "out")) == 2
    files.write_files(rows.limit(0), f"{tmp_path}/none")
    assert names(tmp_path / "none") == []


def test_listing_reads_no_content(spark, tmp_path):
    files.write_files(spark.sql("select 'a/x.wav' as name, cast('abc' as binary) as content"), str(tmp_path))
    got = files.read_files(spark, str(tmp_path)).select("path", "length")
    assert got.first().length == 3 and got.first().path.endswith("/a/x.wav")
    assert "ReadSchema: struct<path:string,length:bigint>" in got._jdf.queryExecution().executedPlan().toString()


def test_failed_and_twin_attempts_leave_nothing(spark, tmp_path):
    top = f"{tmp_path}/out"
    bad = spark.range(4).repartition(4).select(F.when(F.col("id") == 3, "../x").otherwise(F.concat("id", F.lit(".bin"))).alias("name"), F.lit(b"1").alias("content"))
    with pytest.raises(Exception, match="no file name"):
        files.write_files(bad, top)
    assert names(top) == [] or not os.path.exists(top)
    import pyarrow as pa

    writer = files._Writer(top, False)
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b"], "content": [b"x", None]})
    first, twin, lost = writer.write([batch]), writer.write([batch]), writer.write([batch])
    assert len({first.name, twin.name, lost.name}) == 3
    writer.commit([first, None])
    assert names(top) == ["a", "b"]  # of one attempt only


def test_clips_in_files_and_what_is_there(spark, tmp_path):
    from colloquy.operators import audio as A
    from colloquy.operators import clips as C
    from colloquy.sources import io as IO

    rows = spark.createDataFrame([("a:/ é~%", [9.0], None), ("a", [0.1, -0.5, 2.0], None), ("b", [0.25] * 4, [-0.25] * 4), ("c", [], None)], "id string, left array<float>, right array<float>").repartition(2)
    IO.write_audio_files(rows, str(tmp_path), 16_000)
    got = {r.path.rpartition("/")[2]: bytes(r.content) for r in files.read_files(spark, str(tmp_path)).collect()}
    got["a:/ é~%.wav"] = got.pop("a~3A~2F+~C3~A9~7E~25.wav")
    assert got == {f"{r.id}.wav": A.encode_wav([r.left] if r.right is None else [r.left, r.right], 16_000) for r in rows.collect()}
    IO.write_sidecar_files(spark.sql("select 'a' as id, '{\"id\": \"a\", \"duration\": 2.5}' as sidecar union all select 'd', ''"), str(tmp_path))
    index = IO.output_index(spark, str(tmp_path))
    assert sorted(map(tuple, index.collect())) == [("a", True, True, 50, 28), ("a:/ é~%", True, False, 46, 0), ("b", True, False, 60, 0), ("c", True, False, 44, 0)]
    assert sorted(r.id for r in C.pending_work(spark.sql("select * from values ('a'), ('b'), ('d') as t(id)"), index).collect()) == ["b", "d"]
    assert "ReadSchema: struct<path:string,length:bigint>" in index._jdf.queryExecution().executedPlan().toString()
    assert [r.duration for r in IO.read_sidecars(spark, str(tmp_path)).collect()] == [2.5]
