import datetime
import json
import pathlib

from pyspark.sql import functions as F

import __spark_entry__ as entry
from colloquy.operators import audio as A
from colloquy.operators import clips as C
from colloquy.functions import rules as R
from colloquy.functions import text as T
from colloquy.sources import io as IO
from colloquy.sources.files import write_files
from colloquy.streaming import feeds as S


def lines(path, rows):
    pathlib.Path(path).parent.mkdir(parents=True, exist_ok=True)
    pathlib.Path(path).write_text("\n".join(json.dumps(r, ensure_ascii=False) if isinstance(r, dict) else r for r in rows) + "\n")


def test_users_and_manifests(spark, tmp_path):
    lines(tmp_path / "u/users.jsonl", [{"user_id": "u1", "curr_emotion": "sad", "text": 'User: "Hello é"'}, "", {"user_id": "u2", "curr_emotion": "sad", "topic": "t", "text": "```\nHi\n```"}])
    assert sorted((r.user_id, r.topic, r.text) for r in IO.read_users(spark, str(tmp_path / "u")).collect()) == [("u1", "", "Hello é"), ("u2", "t", "Hi")]
    lines(tmp_path / "m/a/train.jsonl", [{"path": "/a", "duration": 1.5}, ""])
    lines(tmp_path / "m/b.jsonl", [{"path": "/b", "duration": 2}])
    lines(tmp_path / "m/notes.txt", ["no"])
    assert IO.read_manifests(spark, str(tmp_path / "m")).where("path is not null").agg(F.sum("duration")).first()[0] == 3.5
    assert IO.count_manifest_rows(spark, [str(tmp_path / "m/b.jsonl")]).first().n == 1


def test_voices_with_their_audio(spark, tmp_path):
    v, x = tmp_path / "v", tmp_path / "far"
    wav = lambda k: A.encode_wav([[0.25] * k], 8000)
    speakers = [("one", "one.wav"), ("deep", "sub/deep.wav"), ("again", "one.wav"), ("far", f"{x}/far.wav"), ("uri", f"file:{x}/far.wav".replace("file:/", "file:///")), ("none", "none.wav"), ("own", "own #1.wav")]
    lines(v / "manifest.json", [{"speakers": [{"id": n, "wav": w, "text": "t", "gender": "m"} for n, w in speakers]}])
    (v / "sub").mkdir()
    x.mkdir()
    for path, k in ((v / "one.wav", 80), (v / "sub/deep.wav", 40), (x / "far.wav", 20)):
        path.write_bytes(wav(k))
    write_files(spark.createDataFrame([("own #1.wav", bytearray(wav(10)))], "name string, content binary"), str(v))
    got = {r.name: r.pcm and len(r.pcm) for r in IO.read_voice_audio(spark, str(v), 16_000, str(x)).collect()}
    assert got == {"one": 160, "deep": 80, "again": 160, "far": 40, "uri": 40, "none": None, "own": 20}
    near = {r.name: (r.pcm and len(r.pcm), r.sample_rate, r.gender) for r in IO.read_voice_audio(spark, str(v), 8000).collect()}
    assert near["far"] == (None, 8000, "M") and near["one"] == (80, 8000, "M")


def test_voices_and_sidecars(spark, tmp_path):
    v = tmp_path / "v"
    lines(v / "manifest.json", [{"speakers": [{"id": "", "wav": "one.wav", "text": "", "gender": "f"}, {"id": "Two", "wav": "/x/two.wav", "text": "said", "gender": None}]}])
    (v / "one.txt").write_text(" from file \n")
    rows = {r.pos: r for r in IO.read_voices(spark, str(v)).collect()}
    assert (rows[0].name, rows[0].gender, rows[0].text, rows[0].path) == ("one", "F", "from file", f"{v}/one.wav")
    assert (rows[1].name, rows[1].gender, rows[1].text, rows[1].path) == ("Two", "", "said", "/x/two.wav")
    s = tmp_path / "s"
    lines(s / "a.json", [{"id": "a", "duration": 2.5, "alignments": [["hi", [0.1, 0.4], "SPEAKER_CLIENT"]]}])
    lines(s / "b.json", ["{broken"])
    got = {r.id: r for r in IO.read_sidecars(spark, str(s)).collect()}
    assert got["a"].duration == 2.5 and tuple(got["a"].alignments[0]) == ("hi", 0.1, 0.4, "SPEAKER_CLIENT") and got[None].duration == 0.0 and not got[None].readable


def test_sidecar_text_is_json_of_mixed_lists(spark):
    from colloquy.plans import clips as K

    rows = K.sidecars(spark, "/root/testdata/sf0.001").collect()
    for r in rows:
        record = json.loads(r.sidecar)
        assert record["id"] == r.id and {"user_roomtone", "voices", "tagged_text", "gap_sec"} <= set(record)
        assert all(isinstance(w, str) and len(t) == 2 and s in ("SPEAKER_CLIENT", "SPEAKER_BROKER") for w, t, s in record["alignments"])
        assert [t["role"] for t in record["turns"]] == ["user", "agent"]


def test_audio_files(spark, tmp_path):
    from colloquy.operators import audio as A

    (tmp_path / "w").mkdir()
    (tmp_path / "w/x.wav").write_bytes(A.encode_wav([[0.1] * 160, [0.3] * 160], 16_000))
    row = IO.read_audio(spark, str(tmp_path / "w"), 24_000).first()
    assert len(row.pcm) == 240 and abs(row.pcm[5] - 0.2) < 1e-3


def test_emotion_of_sidecars(spark):
    df = spark.createDataFrame([("Sad ", "happy", "/c/x_y_1.json"), ("", " HAPPY", "/c/x_y_1.json"), (None, None, "/c/sad_angry_01.json"), (None, None, "/c/sad_odd_1.json"), (None, None, "/c/two_parts.json")], "a string, b string, p string")
    assert [r.e for r in df.select(C.res_emotion(F.col("a"), F.col("b"), F.col("p"), R.EMOTIONS).alias("e")).collect()] == ["sad", "happy", "angry", None, None]
    side = spark.createDataFrame([("sad", "old", True), ("sad", "Answer with a sad tone.", True), ("odd", "old", True), ("sad", "old", False)], "e string, text_prompt string, readable boolean")
    assert [r.outcome for r in C.patch_prompts(side, F.col("e"), T.text_prompt, R.EMOTIONS).collect()] == ["updated", "unchanged", "skipped", "skipped"]


def test_stream_is_batch_and_each_id_once(spark, tmp_path):
    at = datetime.datetime(2026, 1, 1)
    rows = [("a", "great news", "That is a fine thing", "happy", at), ("b", "great news", "I'm sorry to hear that", "happy", at), ("a", "great news", "That is a fine thing", "happy", at)]
    df = spark.createDataFrame(rows, S.ARRIVING)
    df.write.json(str(tmp_path / "in"))
    S.run_to(S.stream_accept(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.id, r.accepted, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", True, None), ("b", False, "valence")]
    df.unionByName(spark.createDataFrame([("c", "x", "Another good line", "sad", at)], S.ARRIVING)).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    S.run_to(S.stream_accept(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_an_id_that_returns_after_hours_is_in_the_output_once(spark, tmp_path):
    def arrive(*rows):
        spark.createDataFrame(list(rows), S.ARRIVING).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        S.stream_accept_once(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
        return sorted((r.id, r.accepted, r.at.hour) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    line = lambda i, hour, text="That is a fine thing": (i, "great news", text, "happy", datetime.datetime(2026, 1, 1, hour))
    assert arrive(line("a", 1), line("a", 1), line("b", 3, "I'm sorry to hear that"), line(None, 1)) == [("a", True, 1), ("b", False, 3)]
    assert arrive(line("a", 3), line("c", 3), line("b", 9)) == [("a", True, 1), ("b", False, 3), ("c", True, 3)]
    for name in ("1", ".1.crc"):  # as if the driver had been lost before it noted the batch as done: it is replayed
        (tmp_path / "cp/commits" / name).unlink()
    assert arrive(line("a", 23), line("c", 5)) == [("a", True, 1), ("b", False, 3), ("c", True, 3)]
    assert arrive(line("d", 6)) == [("a", True, 1), ("b", False, 3), ("c", True, 3), ("d", True, 6)]


def test_late_records_are_dropped(spark, tmp_path):
    def feed(name, hours):
        lines(tmp_path / f"in/{name}.json", [{"step": i, "at": f"2026-01-01T{h:02d}:30:00Z", "tag": "train", "loss": float(h)} for i, h in enumerate(hours)])

    def run():
        S.run_to(S.stream_metrics(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))

    feed("1", [1, 1, 5])
    run()
    feed("2", [1, 5, 9])  # 01:30 is behind the watermark now
    run()
    feed("3", [12])
    run()
    got = {r.start.hour: (r.n, r.mean) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[1] == (2, 1.0) and got[5] == (2, 5.0)


def test_entry(spark):
    assert entry.entry(spark).count() == 16
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_oracle_run(spark):
    for name in sorted(set(entry.queries()) - set(entry.oracle_sql())):
        if not name.startswith(("op", "pipeline")):
            assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name


def test_read_audio_reads_every_take(spark):
    d = "/root/testdata/sf0.001"
    want = {(f"t{r.vec_id - r.vec_id % 2}", r.vec_id % 2) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id").collect()}
    rows = entry.queries()["read_audio"](spark, d).collect()
    assert len(rows) == len(want) and {(r.id, r["take"]) for r in rows} == want and all(r.n > 0 for r in rows)
