"""Registered queries: joins, resume, manifests, split, timings, sidecars."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions import text as T
from colloquy.functions.hashing import stable_index
from colloquy.operators import clips as C
from colloquy.operators import timeline as L
from colloquy.plans import sqltext as S
from colloquy.plans.texts import pool_tagged
from colloquy.sources import io as IO
from colloquy.sources import versions as V
from colloquy.sources.scratch import new_path
from colloquy.sources.views import view

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# outputs that exist, by a hash of the id: two of three wavs, three of four sidecars, some without duration
_DONE = f"(select id, {S.index('id', 3)} > 0 as has_wav, {S.index('id', 4)} > 0 as has_sidecar, case when {S.index('id', 10)} = 5 then null else duration end as duration from fx_clips)"


def _done(spark, d):
    return view(spark, d, "fx_clips").select(
        "id", (stable_index("id", 3) > 0).alias("has_wav"), (stable_index("id", 4) > 0).alias("has_sidecar"),
        F.when(stable_index("id", 10) == 5, None).otherwise(F.col("duration")).alias("duration"))


@query("select user_id, curr_emotion, user_text as text from (select *, row_number() over (partition by user_id order by pos, id) as r from fx_dialogues) where r = 1")
def users_from_dialogues(spark, d):
    return C.users_from_dialogues(view(spark, d, "fx_dialogues"))


_KNOWN = "(select distinct user_id, concat('known ', user_id) as text from fx_dialogues where pos % 5 <> 0)"


@query(f"select d.id, coalesce(k.text, d.user_text) as resolved_text, k.text is not null as was_known from fx_dialogues d left join {_KNOWN} k on d.user_id = k.user_id")
def resolve_users(spark, d):
    dialogues = view(spark, d, "fx_dialogues")
    known = dialogues.where("pos % 5 <> 0").select("user_id", F.concat(F.lit("known "), "user_id").alias("text")).distinct()
    return C.resolve_users(dialogues, known).select("id", "resolved_text", "was_known")


@query(f"select d.id, d.res_emotion from fx_dialogues d left join {_DONE} x on d.id = x.id where d.res_emotion = 'angry' or not (x.has_wav and x.has_sidecar)")
def pending_work(spark, d):
    return C.pending_work(view(spark, d, "fx_dialogues"), _done(spark, d), ("angry",)).select("id", "res_emotion")


@query("select id, res_emotion from fx_dialogues where res_emotion in ('sad', 'happy')")
def regen_filter(spark, d):
    return C.regen_filter(view(spark, d, "fx_dialogues"), ("sad", "happy")).select("id", "res_emotion")


@query(f"""select d.id, t.take_sec, t.take_sec is not null as reused from fx_dialogues d left join (select user_id, {S.index('user_id', 90)} / 10.0e0 as take_sec from
  (select distinct user_id from fx_dialogues where pos % 3 <> 0)) t on d.user_id = t.user_id and t.take_sec > 0""")
def reuse_user_take(spark, d):
    dialogues = view(spark, d, "fx_dialogues")
    takes = dialogues.where("pos % 3 <> 0").select("user_id").distinct().withColumn("take_sec", stable_index("user_id", 90) / F.lit(10.0))
    return C.reuse_user_take(dialogues, takes).select("id", "take_sec", "reused")


@query(f"select d.id, d.curr_emotion, d.res_emotion, coalesce(x.duration, 0.0) as duration from fx_dialogues d join {_DONE} x on d.id = x.id where x.has_wav and x.has_sidecar")
def collect_clips(spark, d):
    done = _done(spark, d)
    return C.collect_clips(view(spark, d, "fx_dialogues"), done.where("has_wav"), done.where("has_sidecar"))


_INDEX = "cast(regexp_extract(id, '([0-9]+)$', 1) as bigint)"


@query(f"select id, {_INDEX} as index from fx_clips")
def duplex_index(spark, d):
    return view(spark, d, "fx_clips").select("id", C.duplex_index(F.col("id")).alias("index"))


_STYLED = f"case {S.index('id', 3)} when 0 then concat(' ', upper(res_emotion), ' ') when 1 then '' end"


@query(f"select id, case when {S.index('id', 3)} = 0 then res_emotion when {S.index('id', 5)} = 0 then 'sad' else res_emotion end as emotion from fx_clips")
def res_emotion_infer(spark, d):
    styled = F.when(stable_index("id", 3) == 0, F.concat(F.lit(" "), F.upper("res_emotion"), F.lit(" "))).when(stable_index("id", 3) == 1, "")
    top = F.when(stable_index("id", 5) == 0, "Sad")
    return view(spark, d, "fx_clips").select("id", C.res_emotion(styled, top, F.col("path"), R.EMOTIONS).alias("emotion"))


@query(f"""select outcome, count(*) as n, min(text_prompt) as least, max(text_prompt) as most from (select case when {S.index('id', 6)} = 0 then 'skipped' when {S.index('id', 4)} = 0 then 'unchanged' else 'updated' end as outcome,
  case when {S.index('id', 6)} <> 0 or {S.index('id', 4)} = 0 then case when {S.index('id', 6)} = 0 then concat('Answer with a ', res_emotion, ' tone.') else concat('Answer with a ', res_emotion, ' tone.') end else 'old' end as text_prompt from fx_clips) group by outcome""")
def patch_prompts(spark, d):
    sidecars = view(spark, d, "fx_clips").select(
        "res_emotion", (stable_index("id", 6) > 0).alias("readable"),
        F.when(stable_index("id", 4) == 0, T.text_prompt(F.col("res_emotion"))).otherwise("old").alias("text_prompt"))
    out = C.patch_prompts(sidecars, F.col("res_emotion"), T.text_prompt, R.EMOTIONS)
    # by prompt first: strings are no buffers of a hash aggregate, and least and most of all rows would sort them all
    each = out.groupBy("outcome", "text_prompt").agg(F.count("*").alias("n"))
    return each.groupBy("outcome").agg(F.sum("n").alias("n"), F.min("text_prompt").alias("least"), F.max("text_prompt").alias("most"))


@query(f"""select version, text_prompt, count(*) as n from (select 1 as version, case when {S.index('id', 4)} = 0 then concat('Answer with a ', res_emotion, ' tone.') else 'old' end as text_prompt from fx_clips
  union all select 2, case when {S.index('id', 6)} = 0 and {S.index('id', 4)} <> 0 then 'old' else concat('Answer with a ', res_emotion, ' tone.') end from fx_clips) group by all""")
def patched_versions(spark, d):
    """Sidecars patched as a new version; the old one stays readable."""
    rows = view(spark, d, "fx_clips").select(
        "id", "res_emotion", (stable_index("id", 6) > 0).alias("readable"),
        F.when(stable_index("id", 4) == 0, T.text_prompt(F.col("res_emotion"))).otherwise("old").alias("text_prompt"))
    V.write(rows, folder := new_path(spark, "sidecars"))
    V.rewrite(spark, folder, lambda old: C.patch_prompts(old, F.col("res_emotion"), T.text_prompt, R.EMOTIONS).drop("outcome"))
    told = lambda version, rows: rows.groupBy("text_prompt").agg(F.count("*").alias("n")).select(F.lit(version).alias("version"), "text_prompt", "n")
    return told(1, V.read(spark, folder, 1)).unionByName(told(2, V.read(spark, folder)))


@query("select concat(curr_emotion, '->', res_emotion) as mapping, count(*) as n, round(sum(duration), 4) as total_sec from fx_clips group by 1")
def mapping_stats(spark, d):
    return C.mapping_stats(view(spark, d, "fx_clips"))


@query("select coalesce(curr_emotion, 'all') as curr_emotion, coalesce(res_emotion, 'all') as res_emotion, grouping_id(curr_emotion, res_emotion) as level, count(*) as n, round(sum(duration), 4) as total_sec from fx_clips group by cube (curr_emotion, res_emotion)")
def emotion_cube(spark, d):
    return C.emotion_cube(view(spark, d, "fx_clips"))


_SPLIT = f"""(select c.*, {_INDEX} as index, case when v.i is null then 'train' else 'val' end as split from fx_clips c left join (
  select i from (select i, row_number() over (order by md5(concat('7:', i)), i) as r, m from (select unnest(range(m)) as i, m from (select min(n) as m from (select count(*) as n from fx_clips group by curr_emotion, res_emotion))))
  where r <= least(floor(m * 0.05 + 0.5), m - 1)) v on v.i = {_INDEX})"""


def _split(spark, d):
    return C.balanced_split(view(spark, d, "fx_clips"), 0.05, 7)


@query(f"select id, index, split from {_SPLIT}")
def balanced_split(spark, d):
    return _split(spark, d).select("id", "index", "split")


_TARGET = "(select cast(least(floor(min(n) * 0.05 + 0.5), min(n) - 1) as bigint) as target_val_per_mapping from (select count(*) as n from fx_clips group by curr_emotion, res_emotion))"


@query(f"""select *, 0.05e0 as val_fraction, 7 as seed from (select coalesce(mapping, 'all') as mapping, count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val
  from (select concat(curr_emotion, '->', res_emotion) as mapping, split from {_SPLIT}) group by rollup(mapping)), {_TARGET}""")
def split_report(spark, d):
    return C.split_report(_split(spark, d), 0.05, 7)


@query(f"select count(*) as n_users, count(*) filter (s > 1) as n_leaking from (select user_id, count(distinct split) as s from {_SPLIT} group by user_id)")
def split_leakage(spark, d):
    return C.split_leakage(_split(spark, d))


@query(f"select path, duration from {_SPLIT} where split = 'val'")
def slim_manifest(spark, d):
    return C.slim_manifest(_split(spark, d), "val")


# ---------------------------------------------------------------- timings and sidecars
_TIMED = """(select key, pos, word, speaker, s + span * coalesce(sum(w) over (partition by key, speaker order by pos rows between unbounded preceding and 1 preceding), 0) / total as start_sec,
  case when pos = n then e else s + span * sum(w) over (partition by key, speaker order by pos rows unbounded preceding) / total end as end_sec
  from (select key, speaker, s, e, greatest(e - s, 0.001) as span, unnest(words) as word, generate_subscripts(words, 1) as pos, len(words) as n, greatest(length(unnest(words)), 1) as w, list_sum(list_transform(words, lambda x: greatest(length(x), 1))) as total from {rows}))"""
_TURNS = f"""(select pair_id as key, 'SPEAKER_CLIENT' as speaker, 0.37e0 as s, 0.531371719317e0 + turn * 1.271828182845e0 as e, {S.words('user_text')} as words from fx_pairs
  union all select pair_id, 'SPEAKER_BROKER', 1.013171319713e0 + turn * 1.271828182845e0, 4.031317319719e0 + turn * 1.513171917131e0, {S.words('agent_text')} from fx_pairs)"""


@query(f"select key as pair_id, pos, word, round(start_sec, 6) as start_sec, round(end_sec, 6) as end_sec from {_TIMED.replace('{rows}', _TURNS)} where speaker = 'SPEAKER_CLIENT'")
def word_timings(spark, d):
    out = L.with_word_timings(_turns(view(spark, d, "fx_pairs"), "user"), "user_words", "user_start", "user_end").select("pair_id", F.posexplode("timings").alias("p", "w"))
    return out.select("pair_id", (F.col("p") + 1).cast("long").alias("pos"), "w.word", F.round("w.start", 6).alias("start_sec"), F.round("w.end", 6).alias("end_sec"))


def _turns(pairs, *roles, words=True):
    """pairs with the words, if asked for, and times of the turns."""
    end = lambda least, step: F.lit(least) + F.col("turn") * step
    times = {"user": (F.lit(0.37), end(0.531371719317, 1.271828182845)), "agent": (end(1.013171319713, 1.271828182845), end(4.031317319719, 1.513171917131))}
    for r in roles:
        pairs = pairs.withColumn(f"{r}_start", times[r][0]).withColumn(f"{r}_end", times[r][1])
        if words:
            pairs = pairs.withColumn(f"{r}_words", T.tokenize_words(F.col(f"{r}_text")))
    return pairs


def _aligned(spark, d, text=False):
    """Pairs with the alignments of both turns, as a list of words or as its JSON text."""
    names = lambda r: (f"{r}_text" if text else f"{r}_words", f"{r}_start", f"{r}_end")
    how = L.with_alignments_text if text else L.with_alignments
    return how(_turns(view(spark, d, "fx_pairs"), "user", "agent", words=not text), names("user"), names("agent"))


@query(f"""select key as pair_id, case when speaker = 'SPEAKER_BROKER' then pos + u else pos end as pos, word, round(start_sec, 6) as start_sec, round(end_sec, 6) as end_sec, speaker
  from {_TIMED.replace('{rows}', _TURNS)} join (select pair_id, len({S.words('user_text')}) as u from fx_pairs) n on n.pair_id = key""")
def build_alignments(spark, d):
    out = _aligned(spark, d).select("pair_id", F.posexplode("alignments").alias("p", "w"))
    return out.select("pair_id", (F.col("p") + 1).cast("long").alias("pos"), "w.word", F.round("w.start", 6).alias("start_sec"), F.round("w.end", 6).alias("end_sec"), "w.speaker")


# every field of a record, as the tables give it
_RECORD = f"""(select pair_id as id, concat('u', conv_id) as user_id, curr as curr_emotion, res as res_emotion, concat('topic ', turn % 9) as topic, user_text, agent_text, 0.37e0 as user_start,
    0.531371719317e0 + turn * 1.271828182845e0 as user_end, 1.013171319713e0 + turn * 1.271828182845e0 as agent_start, 4.031317319719e0 + turn * 1.513171917131e0 as agent_end, 0.2e0 as gap_sec, 0.37e0 as pad_pre_sec,
    (turn % 4) / 8e0 as pad_post_sec, case when turn % 3 > 0 then concat('/tone/', turn % 3, '.wav') end as roomtone, case when turn % 3 > 0 then -50e0 - turn % 3 end as roomtone_dbfs,
    concat('/turns/u', conv_id, '.wav') as user_path, concat('/turns/', pair_id, '_agent.wav') as agent_path, concat('/stereo/', pair_id, '.wav') as wav,
    case turn % 2 when 0 then 'Ann' else '' end as agent_name, case turn % 2 when 0 then '/voices/ann.wav' else '' end as agent_voice_path, 'Bob' as user_name from fx_pairs)"""
_SIDECARS = f"""(select r.id, user_id, topic, curr_emotion, res_emotion, concat('Answer with a ', res_emotion, ' tone.') as text_prompt, 24000 as sample_rate, gap_sec, pad_pre_sec, pad_post_sec, roomtone as user_roomtone, roomtone_dbfs as user_roomtone_dbfs,
    'proportional' as aligner, 'SPEAKER_BROKER' as left_channel, 'SPEAKER_CLIENT' as right_channel, concat('0 SPEAKER_CLIENT user ', user_path, ' ', user_text, '|1 SPEAKER_BROKER agent ', agent_path, ' ', agent_text) as turns,
    round(user_start + user_end * 10 + agent_start * 100 + agent_end * 1000, 6) as turn_times, nullif(agent_voice_path, '') as voice_prompt,
    concat_ws('|', nullif(agent_name, ''), 'F', nullif(agent_voice_path, ''), 'said', user_name, 'M', '/voices/bob.wav', 'told') as voices, u.tagged as tagged_user, g.tagged as tagged_agent, wav, round(agent_end + pad_post_sec, 6) as duration,
    len({S.words('user_text')}) + len({S.words('agent_text')}) as n_words, array_to_string(list_concat({S.words('user_text')}, {S.words('agent_text')}), ' ') as words, m.moment
  from {_RECORD} r join {pool_tagged(_RECORD, 'id', 'curr_emotion', 'user_text', "concat(user_id, ':user')")} u on u.id = r.id
    join {pool_tagged(_RECORD, 'id', 'res_emotion', 'agent_text', "concat(id, ':agent')")} g on g.id = r.id
    left join (select key, round(sum(start_sec + 2 * end_sec), 4) as moment from {_TIMED.replace('{rows}', _TURNS)} group by key) m on m.key = r.id)"""


def sidecars(spark, d):
    """id and JSON record of every pair."""
    c, lit = F.col, F.lit
    rows = _aligned(spark, d, text=True).select(
        c("pair_id").alias("id"), F.concat(lit("u"), c("conv_id").cast("string")).alias("user_id"), c("curr").alias("curr_emotion"), c("res").alias("res_emotion"),
        F.concat(lit("topic "), (c("turn") % 9).cast("string")).alias("topic"), "user_text", "agent_text", "alignments", lit(0.37).alias("user_start"), (0.531371719317 + c("turn") * 1.271828182845).alias("user_end"),
        (1.013171319713 + c("turn") * 1.271828182845).alias("agent_start"), (4.031317319719 + c("turn") * 1.513171917131).alias("agent_end"), lit(0.2).alias("gap_sec"), lit(0.37).alias("pad_pre_sec"),
        (c("turn") % 4 / 8.0).alias("pad_post_sec"), F.when(c("turn") % 3 > 0, F.concat(lit("/tone/"), (c("turn") % 3).cast("string"), lit(".wav"))).alias("roomtone"),
        F.when(c("turn") % 3 > 0, -50.0 - c("turn") % 3).alias("roomtone_dbfs"), F.concat(lit("/turns/u"), c("conv_id").cast("string"), lit(".wav")).alias("user_path"),
        F.concat(lit("/turns/"), "pair_id", lit("_agent.wav")).alias("agent_path"), F.concat(lit("/stereo/"), "pair_id", lit(".wav")).alias("wav"),
        F.when(c("turn") % 2 == 0, F.struct(lit("Ann"), lit("F"), lit("/voices/ann.wav"), lit("said"))).otherwise(F.struct(lit(""), lit("F"), lit(""), lit("said"))).cast(L.VOICE).alias("agent_voice"),
        F.struct(lit("Bob"), lit("M"), lit("/voices/bob.wav"), lit("told")).cast(L.VOICE).alias("user_voice"))
    return rows.select("id", L.sidecar(aligned=c("alignments")).alias("sidecar"))


def sidecar_fields(records):
    """Records as read, with their nested fields as plain columns."""
    c = F.col
    turn = lambda t: F.concat_ws(" ", t["index"].cast("string"), t["speaker"], t["role"], t["path"], t["text"])
    voice = lambda who: [c(f"voices.{who}.{k}") for k in ("name", "gender", "path", "text")]
    moment = F.aggregate("alignments", F.lit(0.0), lambda a, x: a + x["start"] + 2 * x["end"])
    t = lambda i, k: c("turns")[i][k]
    return records.select(
        "id", "user_id", "styletalk.topic", "styletalk.curr_emotion", "styletalk.res_emotion", "text_prompt", "sample_rate", "gap_sec", "pad_pre_sec", "pad_post_sec", "user_roomtone", "user_roomtone_dbfs",
        "aligner", c("channel_layout.left").alias("left_channel"), c("channel_layout.right").alias("right_channel"), F.array_join(F.transform("turns", turn), "|").alias("turns"),
        F.round(t(0, "start") + t(0, "end") * 10 + t(1, "start") * 100 + t(1, "end") * 1000, 6).alias("turn_times"), "voice_prompt", F.concat_ws("|", *voice("agent"), *voice("user")).alias("voices"),
        c("tagged_text.user").alias("tagged_user"), c("tagged_text.agent").alias("tagged_agent"), "wav", F.round("duration", 6).alias("duration"), F.size("alignments").cast("long").alias("n_words"),
        F.array_join(F.transform("alignments", lambda a: a["word"]), " ").alias("words"), F.when(F.size("alignments") > 0, F.round(moment, 4)).alias("moment"))


@query(f"select * from {_SIDECARS}")
def build_sidecar(spark, d):
    read = F.from_json("sidecar", IO.SIDECAR).alias("r")
    return sidecar_fields(IO.records(sidecars(spark, d).select(read).select("r.*")))
