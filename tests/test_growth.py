"""Work that grows with the input: how the larger tables are dealt to tasks, and what is done once."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from colloquy.sources.views import view

D = "/root/testdata/sf0.001"


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_clips_of_one_row_group_are_many_tasks(spark, tmp_path):
    spark.range(20_000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    clips = view(spark, str(tmp_path), "fx_clips")
    assert clips.rdd.getNumPartitions() == 5 and clips.select("id").distinct().count() == clips.count() > 300_000


def test_prompts_are_built_without_lambdas(spark):
    assert "lambda" not in plan(entry.queries()["system_prompt"](spark, D))


def test_outcomes_are_told_from_few_prompts(spark):
    """No sort of all rows: strings are compared once rows are grouped by them."""
    text = plan(entry.queries()["patch_prompts"](spark, D))
    assert text.count("HashAggregate") >= 2 and "HashAggregate(keys=[outcome" in text and text.index("SortAggregate") < text.index("HashAggregate")


def test_places_in_an_order_need_one_exchange(spark):
    from colloquy.operators import samples as M

    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(5)
    got = M.global_index(rows, "k", "id")
    assert "Window" not in plan(got)
    assert [r.id for r in got.orderBy("i").collect()] == [r.id for r in rows.orderBy("k", "id").collect()] and got.agg(F.max("i")).first()[0] == 4999


def test_manifests_make_the_split_once(spark, tmp_path):
    from colloquy.sources import io as IO

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def side(i):
        seen.add(1)
        return "val" if i % 10 == 0 else "train"

    rows = spark.range(50).select(F.concat(F.lit("happy_sad_"), "id").alias("id"), F.lit("p").alias("path"), F.lit(1.0).alias("duration"), F.lit("happy").alias("curr_emotion"), F.lit("sad").alias("res_emotion"), F.col("id").alias("index"))
    IO.write_manifests(rows.withColumn("split", side("index")), f"{tmp_path}/m", 0.1, 7)
    assert seen.value == 50


def test_streams_of_many_chunks_equal_those_of_each():
    import numpy as np
    import pyarrow as pa

    from colloquy.operators import samples as M

    rnd = np.random.default_rng(5)
    chunks = [[]]
    for _ in range(400):
        starts = np.sort(rnd.uniform(-0.5, 12.0, int(rnd.integers(0, 9))))
        chunks.append([{"start_sec": float(s), "pos": i, "end_sec": float(s + rnd.uniform(0, 2)), "tokens": rnd.integers(100, 200, int(rnd.integers(0, 30))).tolist()} for i, s in enumerate(starts)])
    kind = pa.list_(pa.struct([("start_sec", pa.float64()), ("pos", pa.int64()), ("end_sec", pa.float64()), ("tokens", pa.list_(pa.int32()))]))
    each = [M.queue_stream([w["tokens"] for w in c], [w["start_sec"] for w in c], [w["end_sec"] for w in c], 120) for c in chunks]
    assert M.queue_streams(pa.array(chunks, kind), 120).to_pylist() == each
    assert M.queue_streams(pa.array(chunks, kind)[7:40], 120).to_pylist() == each[7:40]
    assert M.queue_streams(pa.array([], kind), 120).to_pylist() == []


def test_timings_of_many_turns_equal_the_columns(spark):
    from colloquy.operators import timeline as L

    rows = spark.createDataFrame([(0, ["a", "bbb"], 0.0, 4.0, ["x"], 5.0, 4.0), (1, [], 0.0, 1.0, ["é", "", "zz"], 1.0, 2.5), (2, None, 0.0, 1.0, [], 1.0, 2.0), (3, ["q"], 1.0, 2.0, [], None, 3.0)], "k int, u array<string>, us double, ue double, a array<string>, s double, e double").coalesce(1)
    c = F.col
    want = rows.select("k", L.build_alignments((c("u"), c("us"), c("ue")), (c("a"), c("s"), c("e"))).alias("x"), L.word_timings(c("u"), c("us"), c("ue")).alias("y")).orderBy("k").collect()
    out = L.with_word_timings(L.with_alignments(rows, ("u", "us", "ue"), ("a", "s", "e"), "x"), "u", "us", "ue", "y")
    got = out.select("k", "x", "y").orderBy("k").collect()
    flat = lambda r: [[v for w in (part or []) for v in w] for part in (r.x, r.y)]
    for g, w in zip(got, want):
        assert (g.x is None, g.y is None) == (w.x is None, w.y is None)
        assert all(p == pytest.approx(q) for p, q in zip(flat(g), flat(w))) and [*map(len, flat(g))] == [*map(len, flat(w))]
    names = ("word_timings", "build_alignments", "build_sidecar", "write_sidecars", "read_sidecars")
    assert all("aggregate(" not in plan(entry.queries()[n](spark, D)).replace("Aggregate", "") or n.endswith(("sidecar", "sidecars")) for n in names[:2])


def test_sidecar_files_are_read_whole(spark, tmp_path):
    from colloquy.sources import io as IO

    spark.sql("select 1").count()
    for name, content in {"a": '{"id": "a",\n "duration": 2.5, "alignments": [["h\\"i", [0.1, 4e-1], "S"], ["x", [null, 1], null]]}', "b": "{broken", "c": "", "d": " \n"}.items():
        (tmp_path / f"{name}.json").write_text(content)
    out = IO.read_sidecars(spark, str(tmp_path))
    assert "FileScan text" in plan(out)  # not the JSON reader, which goes back to the file for each word
    got = {r.id: r for r in out.collect()}
    assert set(got) == {"a", None} and not got[None].readable and got[None].duration == 0.0
    assert [tuple(w) for w in got["a"].alignments] == [('h"i', 0.1, 0.4, "S"), ("x", None, 1.0, None)]


@pytest.mark.parametrize("name", ["build_alignments", "build_sidecar"])
def test_sidecars_time_words_in_batches(spark, name):
    text = plan(entry.queries()[name](spark, D))
    assert "MapInArrow" in text and r'\{"x":' not in text


def test_sidecar_text_is_made_and_read_in_batches(spark, monkeypatch):
    import json

    import pyarrow as pa

    from colloquy.functions import text as T
    from colloquy.operators import timeline as L
    from colloquy.sources import io as IO
    from colloquy.sources import views

    texts = ["It's <|laugh|>a 'test' '' — ok?", "", None, "<|x|>''' ' '' a''b 'c", "one\ntwo <|a\nb|>three|> é9"]
    rows = spark.createDataFrame([(k, x, 0.0, 2.5, y, 3.0, None if k == 4 else 5.0) for k, (x, y) in enumerate(zip(texts, reversed(texts)))], "k int, u string, us double, ue double, a string, s double, e double").coalesce(1)
    c = F.col
    words = rows.select("k", T.tokenize_words(c("u")).alias("w")).orderBy("k").collect()
    assert [r.w for r in words] == L.words_of(pa.array(texts)).to_pylist() == L.words_of(pa.array(["x", *texts])[1:]).to_pylist()
    want = {r.k: r.x for r in rows.where("k < 4").select("k", L.build_alignments((T.tokenize_words(c("u")), c("us"), c("ue")), (T.tokenize_words(c("a")), c("s"), c("e"))).alias("x")).collect()}
    got = {r.k: r.x for r in L.with_alignments_text(rows, ("u", "us", "ue"), ("a", "s", "e"), "x").collect()}
    for k, x in want.items():
        assert (got[k] is None) == (x is None) and (x is None or [[w, *t, s] for w, t, s in json.loads(got[k])] == [[w.word, pytest.approx(w.start), pytest.approx(w.end), w.speaker] for w in x])
    assert [w for w, _, _ in json.loads(got[4])] == [*words[4].w, "It's", "a", "'test'", "ok"]  # a turn without an end loses no word
    assert L.quoted(pa.array(['a"b', "\\", None, "\n\x01", "é"])).to_pylist() == ['"a\\"b"', '"\\\\"', None, '"\\n\\u0001"', '"é"']
    assert L.numbers(pa.array([1.5, float("inf"), None])).to_pylist() == ["1.5", None, None]

    plain = ["[]", None, '[["a",[0.5,1e-7],"S"],["é",[-0.0,2],"T"]]']
    odd = ['[["a",[0],"S"]]', '[["a",[0,1],"S",2]]', '[["a"]]', '[[["a"],[0,1,2],"S"]]', '[["a",[null,1],null],null]', '[["a\\"",[0,1],"S"]]', '[["a","0.1, 2","S"]]', '[["a", [0,1],"S"]]', "5", '{"a":["b",[0,1],"c"]}', '["a","b","c"]', '[["a",[1e400,1],"S"]]']
    assert IO._plain(pa.array(plain)) is not None and all(IO._plain(pa.array([x])) is None for x in odd)
    slow = pa.array([None if x is None else [IO._alignment(a) for a in IO._loaded(x)] for x in plain], IO._ALIGNMENTS)
    assert IO._plain(pa.array(plain)).equals(slow) and IO._aligned(pa.array([*plain, '[["\\u0061",[0.5,1],"S"]]'])).to_pylist()[:3] == slow.to_pylist()
    assert IO._plain(pa.array(["x", *plain])[1:]).equals(slow)
    lines = spark.createDataFrame([(k, '{"id":"%d","duration":1.5,"alignments":%s}' % (k, x)) for k, x in enumerate(odd)], "k int, value string")
    read = {int(r.id): r for r in IO._parsed(lines).collect()}
    first = [None if r.alignments is None else tuple(r.alignments[0]) for _, r in sorted(read.items())]
    assert first == [("a", 0.0, None, "S"), ("a", 0.0, 1.0, "S"), ("a", None, None, None), ('["a"]', 0.0, 1.0, "S"), ("a", None, 1.0, None), ('a"', 0.0, 1.0, "S"), ("a", 0.1, 2.0, "S"), ("a", 0.0, 1.0, "S"), None, None, None, ("a", None, 1.0, "S")]
    assert [k for k, r in sorted(read.items()) if not r.readable] == [8, 9, 10] and all(r.duration == 1.5 for r in read.values())

    monkeypatch.setitem(views.SPREAD, "fx_pairs", (*views.SPREAD["fx_pairs"][:2], 16))  # tasks by rows: adaptive execution goes by bytes and leaves few
    for name in ("build_sidecar", "write_sidecars"):
        text = plan(entry.queries()[name](spark, D))
        assert "ArrowEvalPython" in text and "try_cast" not in text and "to_json(array(" not in text
    assert "REPARTITION_BY_NUM" in plan(entry.queries()["build_sidecar"](spark, D))
