"""Registered queries: files and streams.

Their inputs are written from the tables into the shared scratch folder, in the shapes that
the readers expect, and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions.hashing import stable_index
from colloquy.operators import audio as A
from colloquy.operators import clips as O
from colloquy.plans import clips as C
from colloquy.plans import sqltext as S
from colloquy.plans import texts as X
from colloquy.sources import io as IO
from colloquy.sources.files import write_files
from colloquy.sources.scratch import new_path
from colloquy.sources.views import view
from colloquy.streaming import feeds as W

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _new(spark) -> str:
    return new_path(spark, "io")


def _with_blank(rows, path):
    """JSON lines with a blank line after some."""
    rows.select(F.concat(F.to_json(F.struct("*")), F.when(F.rand(1) < 0.2, "\n").otherwise("")).alias("value")).write.text(path)


_CLEAN_USER = S.clean("concat('User: \"', user_text, '\"')")


@query(f"select pair_id as user_id, curr as curr_emotion, '' as topic, {_CLEAN_USER} as text from fx_pairs")
def read_users(spark, d):
    rows = view(spark, d, "fx_pairs").select(F.col("pair_id").alias("user_id"), F.col("curr").alias("curr_emotion"), F.concat(F.lit('User: "'), "user_text", F.lit('"')).alias("text"))
    _with_blank(rows, path := _new(spark))
    return IO.read_users(spark, path)


@query(f"select pair_id as id, {S.clean('user_text')} as user_text, {S.clean('agent_text')} as agent_text, '' as topic from fx_pairs")
def read_dialogues(spark, d):
    rows = view(spark, d, "fx_pairs").select(F.col("pair_id").alias("id"), "user_text", "agent_text")
    _with_blank(rows, path := _new(spark))
    return IO.read_dialogues(spark, path).select("id", "user_text", "agent_text", "topic")


@query("select id, user_text as text from (select id, user_text from fx_dialogues)")
def write_texts(spark, d):
    IO.write_lines(view(spark, d, "fx_dialogues").select("id", F.col("user_text").alias("text")), path := _new(spark))
    return spark.read.schema("id string, text string").json(path)


@query(f"""with s as {C._SPLIT.replace('select c.*', 'select c.*, concat(c.curr_emotion, chr(45), chr(62), c.res_emotion) as mapping', 1)}
  select split as part, '' as key, count(*) as n, round(sum(duration), 4) as total from s group by split
  union all select 'mapping', mapping, count(*), round(sum(duration), 4) from s group by mapping
  union all select 'ids', mapping, count(distinct id), sum(length(id))::double from s group by mapping
  union all select 'index', index::varchar, 1, index::double from (select distinct index from s where split = 'val')
  union all select 'asked', 'val_fraction', 17, 0.05e0 union all select 'asked', 'target_val_per_mapping', 17, target_val_per_mapping from {C._TARGET}
  union all select 'side', mapping, count(*) filter (split = 'train'), count(*) filter (split = 'val') from s group by mapping""")
def write_manifests(spark, d):
    IO.write_manifests(C._split(spark, d), path := _new(spark), 0.05, 7)
    read = lambda name, schema: spark.read.schema(schema).json(f"{path}/{name}")
    rows = lambda df, part, key, n, total: df.select(F.lit(part).alias("part"), key.alias("key"), n.cast("long").alias("n"), total.cast("double").alias("total"))
    one, c = F.lit(1), F.col
    side = lambda s: rows(read(f"{s}.jsonl", IO.MANIFEST).agg(F.count("*").alias("n"), F.round(F.sum("duration"), 4).alias("t")), s, F.lit(""), c("n"), c("t"))
    info = read("split_manifest.json", "mapping string, train long, val long, val_fraction double, target_val_per_mapping long, seed long")
    by = read("manifest_by_mapping.json", "mapping string, count long, total_duration_sec double")
    ids = read("mapping_ids.json", "mapping string, id string").groupBy("mapping").agg(F.count_distinct("id").alias("n"), F.sum(F.length("id")).alias("t"))
    asked = info.groupBy().agg(F.count("*").alias("n"), F.max("val_fraction").alias("f"), F.max("target_val_per_mapping").alias("k"))
    out = side("train").unionByName(side("val"))
    for more in (
        rows(by, "mapping", c("mapping"), c("count"), F.round("total_duration_sec", 4)), rows(ids, "ids", c("mapping"), c("n"), c("t")),
        rows(read("val_indices.json", "index long"), "index", c("index").cast("string"), one, c("index")),
        rows(asked, "asked", F.lit("val_fraction"), c("n"), c("f")), rows(asked, "asked", F.lit("target_val_per_mapping"), c("n"), c("k")),
        rows(info.where("mapping <> 'all'"), "side", c("mapping"), c("train"), c("val")),
    ):
        out = out.unionByName(more)
    return out


@query("select path, duration from fx_clips")
def read_manifests(spark, d):
    """A folder of manifests below one another, beside files of other names."""
    lines = view(spark, d, "fx_clips").select("curr_emotion", "id", F.to_json(F.struct("path", "duration")).alias("line"))
    files = lines.groupBy("curr_emotion", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(F.concat_ws("\n", F.collect_list("line")).alias("text"))  # 64 files for each emotion
    write_files(files.select(F.concat("curr_emotion", F.lit("/"), "part", F.lit(".jsonl")).alias("name"), F.encode("text", "UTF-8").alias("content")), path := _new(spark))
    write_files(spark.sql("select 'notes.json' as name, cast('{\"path\": \"no manifest\"}' as binary) as content"), path)
    return IO.read_manifests(spark, path)


@query("select count(*) as n from fx_clips")
def count_manifest_rows(spark, d):
    view(spark, d, "fx_clips").select(F.to_json(F.struct("path", "duration")).alias("value")).write.text(path := _new(spark))
    return IO.count_manifest_rows(spark, [path])


@query(f"select * from {C._SIDECARS}")
def write_sidecars(spark, d):
    """As lines of a dataset; read_sidecars has a file for each."""
    IO.write_sidecars(C.sidecars(spark, d), path := _new(spark))
    return C.sidecar_fields(IO.read_sidecar_lines(spark, path))


@query(f"select readable, count(*) as n, round(sum(case when readable then duration else 0 end), 3) as total, coalesce(sum(n_words) filter (readable), 0)::bigint as n_words from (select {S.index('id', 9)} > 0 as readable, duration, n_words from {C._SIDECARS}) group by readable")
def read_sidecars(spark, d):
    """A file for each clip; one in nine is no JSON."""
    rows = C.sidecars(spark, d).select("id", F.when(stable_index("id", 9) == 0, "{broken").otherwise(F.col("sidecar")).alias("sidecar"))
    IO.write_sidecar_files(rows, path := _new(spark))
    out = IO.read_sidecars(spark, path).groupBy("readable").agg(F.count("*").alias("n"), F.round(F.sum(F.round("duration", 6)), 3).alias("total"), F.sum(F.when(F.col("readable"), F.size("alignments"))).alias("n_words"))
    return out.select("readable", "n", "total", F.coalesce("n_words", F.lit(0)).alias("n_words"))


def _voice_list(spark, d, path):
    v = view(spark, d, "fx_voices")
    entry = F.struct(F.col("name").alias("id"), F.concat("name", F.lit(".wav")).alias("wav"), F.lit("").alias("text"), F.lower("gender").alias("gender"))
    one = v.agg(F.array_sort(F.collect_list(F.struct("pos", entry.alias("e")))).alias("s")).select(F.to_json(F.struct(F.transform("s", lambda x: x["e"]).alias("speakers"))).alias("value"))
    one.coalesce(1).write.text(f"{path}/manifest.json")


@query("select s_suppkey - (select min(s_suppkey) from supplier) as pos, s_name as name, case s_suppkey % 5 when 0 then 'F' when 1 then 'M' when 2 then 'F' when 3 then 'M' else '' end as gender from supplier")
def read_voices(spark, d):
    _voice_list(spark, d, path := _new(spark))
    return IO.read_voices(spark, path).select(F.col("pos").cast("long").alias("pos"), "name", "gender")


_TONE = "list_transform(range(40 + s_suppkey % 50), lambda k: ((k * s_suppkey) % 101) / 202e0)"


@query(f"""select s_suppkey - (select min(s_suppkey) from supplier) as pos, s_name as name, 16000 as sample_rate, case when s_suppkey % 7 > 0 then 40 + s_suppkey % 50 end as n,
  case when s_suppkey % 7 > 0 then list_sum(list_transform({_TONE}, lambda v: round_even(v::float::double * 32767, 0) / 32768)) end as total from supplier""")
def read_voice_audio(spark, d):
    """A voice list with the voices' files beside it; one voice in seven has none."""
    _voice_list(spark, d, path := _new(spark))
    key = F.col("s_suppkey")
    tone = F.transform(F.sequence(F.lit(0), 39 + key % 50), lambda k: ((k * key) % 101 / 202.0).cast("float"))
    with_file = view(spark, d, "supplier").where(key % 7 > 0)
    write_files(A.wav_contents(with_file.select(F.concat("s_name", F.lit(".wav")).alias("name"), tone.alias("left"), F.lit(None).cast("array<float>").alias("right")), 16_000), path)
    out = IO.read_voice_audio(spark, path, 16_000)
    total = F.aggregate("pcm", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.select(F.col("pos").cast("long").alias("pos"), "name", "sample_rate", F.size("pcm").alias("n"), total.alias("total"))


def _wav_folder(spark, t):
    """Every take in a file of its own, named id and take."""
    clips = t.select(F.concat_ws("_", "id", "take").alias("id"), F.col("pcm").alias("left"), F.lit(None).cast("array<float>").alias("right"))
    IO.write_audio_files(clips, path := _new(spark), 16_000)
    return path


def _of_name(k):
    return F.split_part(IO.file_id(), F.lit("_"), F.lit(k))


@query("select id, take, len(pcm) as n, list_sum(list_transform(pcm, lambda v: round_even(v::double * 32767, 0) / 32768)) as total from fx_takes")
def write_audio(spark, d):
    """Files come back sample by sample: sums of sixteen-bit steps are exact."""
    back = IO.read_audio(spark, _wav_folder(spark, view(spark, d, "fx_takes")), 16_000)
    total = F.aggregate("pcm", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.select(_of_name(1).alias("id"), _of_name(2).cast("long").alias("take"), F.size("pcm").alias("n"), total.alias("total"))


@query("select id, take, cast(round(len(pcm) * 1.5) as int) as n from fx_takes")
def read_audio(spark, d):
    """Every take, at half as many samples again."""
    back = IO.read_audio(spark, _wav_folder(spark, view(spark, d, "fx_takes")), 24_000)
    return back.select(_of_name(1).alias("id"), _of_name(2).cast("long").alias("take"), F.size("pcm").alias("n"))


_OUTPUTS = f"""(select concat_ws('_', id, take) as id, case when {S.index("concat_ws('_', id, take)", 3)} = 0 then null when {S.index("concat_ws('_', id, take)", 7)} = 0 then 0 else 44 + 2 * len(pcm) end as wav,
  {S.index("concat_ws('_', id, take)", 4)} > 0 as has_sidecar from fx_takes)"""


@query(f"select id, coalesce(wav, 0) > 0 as has_wav, has_sidecar, coalesce(wav, 0)::bigint as wav_bytes, not (coalesce(wav, 0) > 0 and has_sidecar) as pending from {_OUTPUTS}")
def output_index(spark, d):
    """Takes of which some have no file, an empty file, or no sidecar: what is there by listing, what is still to do by an anti join."""
    takes = view(spark, d, "fx_takes").withColumn("id", F.concat_ws("_", "id", "take"))
    some = takes.where(stable_index("id", 3) > 0)
    wavs = A.wav_contents(some.select(F.concat("id", F.lit(".wav")).alias("name"), F.col("pcm").alias("left"), F.lit(None).cast("array<float>").alias("right")), 16_000)
    empty = stable_index(IO.file_id("name"), 7) == 0
    write_files(wavs.withColumn("content", F.when(empty, F.lit(b"")).otherwise(F.col("content"))), path := _new(spark))
    IO.write_sidecar_files(takes.where(stable_index("id", 4) > 0).select("id", F.to_json(F.struct("id")).alias("sidecar")), path)
    index = IO.output_index(spark, path)
    pending = O.pending_work(takes.select("id"), index).withColumn("pending", F.lit(True))
    out = takes.select("id").join(index, "id", "left").join(pending, "id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return out.select("id", flag("has_wav"), flag("has_sidecar"), F.coalesce("wav_bytes", F.lit(0)).alias("wav_bytes"), flag("pending"))


def _feed(spark, d):
    rows = view(spark, d, "fx_metrics").select("step", F.col("at").cast("timestamp").alias("at"), "tag", "loss")
    rows.write.json(path := _new(spark))
    return path


@query("select step, tag, round(loss, 6) as loss from fx_metrics")
def read_metrics(spark, d):
    return IO.read_metrics(spark, _feed(spark, d)).select("step", "tag", F.round("loss", 6).alias("loss"))


@query(f"select pair_id as id, reason is null as accepted, reason from {X._REPLIES}")
def stream_accept(spark, d):
    """Each id twice at once, and again two hours later in a second run: the sink takes it once."""
    rows = view(spark, d, "fx_pairs").select(F.col("pair_id").alias("id"), "user_text", "agent_text", "res", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn")).alias("at"))
    path = _new(spark)
    later = rows.withColumn("at", F.col("at") + F.expr("interval 2 hours"))
    for arrived in (rows.unionByName(rows), later):
        arrived.write.mode("append").json(f"{path}/in")
        W.stream_accept_once(spark, f"{path}/in", f"{path}/out", f"{path}/state")
    return spark.read.schema(W.JUDGED).parquet(f"{path}/out").select("id", "accepted", "reason")


# a third of the time in each of three deliveries; one record in ten comes with the delivery after its own
_DELIVERED = """(select *, cast(floor(3 * (unix_at - lo) / (hi - lo + 1)) as int) + case when step % 10 = 0 then 1 else 0 end as delivery
  from (select *, {unix} as unix_at from fx_metrics) cross join (select min({unix}) as lo, max({unix}) as hi from fx_metrics))"""


@query(f"""with f as (select tag, cast("at" as timestamp) as ts, loss, delivery from {_DELIVERED.format(unix='floor(epoch(cast("at" as timestamp)))')}),
  marks as (select delivery, max(last) over (order by delivery rows between unbounded preceding and 1 preceding) - interval (10) minute as mark from (select delivery, max(ts) as last from f group by delivery)),
  kept as (select *, time_bucket(interval (1) hour, ts) as start from f join marks using (delivery) where mark is null or time_bucket(interval (1) hour, ts) + interval (1) hour > mark)
  select tag, start, count(*) as n, round(avg(loss), 6) as mean, max(loss) as most from kept where start + interval (1) hour <= (select max(ts) - interval (10) minute from f) group by all""")
def stream_metrics(spark, d):
    """Deliveries one after another, each followed by a run to a file sink: what comes after its window's watermark is dropped,
    and a window is written once the watermark has passed it."""
    path = _new(spark)
    low = view(spark, d, "fx_metrics").select("step", F.col("at").cast("timestamp").alias("at"), "tag", "loss").withColumn("unix_at", F.unix_timestamp("at"))
    ends = low.agg(F.min("unix_at").alias("lo"), F.max("unix_at").alias("hi"))
    feed = low.crossJoin(F.broadcast(ends)).withColumn("delivery", F.floor(3 * (F.col("unix_at") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1)).cast("int") + F.when(F.col("step") % 10 == 0, 1).otherwise(0))  # one row
    for k in range(4):
        feed.where(F.col("delivery") == k).select("step", "at", "tag", "loss").write.mode("append").json(f"{path}/in")
        W.run_to(W.stream_metrics(spark, f"{path}/in"), f"{path}/out", f"{path}/state")
    return spark.read.schema("tag string, start timestamp, n long, mean double, most double").parquet(f"{path}/out").withColumn("start", F.col("start").cast("timestamp_ntz"))
