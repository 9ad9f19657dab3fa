"""Registered queries: sources, shards, chunks, frame tokens, context, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions.hashing import stable_index
from colloquy.operators import permutation as B
from colloquy.operators import samples as M
from colloquy.plans import sqltext as S
from colloquy.sources.scratch import materialize
from colloquy.sources.views import view

QUERIES, SQL = {}, {}
STEP = M.step_sec()
FRAMES = 120


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def text(c):
    return F.concat_ws(" ", (F.col(c) if isinstance(c, str) else c).cast("array<string>"))


_INDEXED = "(select id, duration, row_number() over (order by id) - 1 as i from fx_clips)"


@query(f"select id, i, cast(i % 8 as int) as rank, i // 8 as seq from {_INDEXED}")
def shard_assign(spark, d):
    return M.shard_assign(M.global_index(view(spark, d, "fx_clips").select("id"), "id"), 8)


@query("select id, epoch, row_number() over (partition by epoch order by k, id) - 1 as i from (select id, e as epoch, md5(concat(11 + e, ':', id)) as k from fx_clips, (select unnest([0, 1]) as e))")
def epoch_shuffle(spark, d):
    clips = view(spark, d, "fx_clips").select("id")
    out = None
    for e in (0, 1):
        one = M.global_index(clips.withColumn("k", M.epoch_key(11, e, "id")), "k", "id").select("id", F.lit(e).alias("epoch"), "i")
        out = one if out is None else out.unionByName(one)
    return out


_PLACED = " union all ".join(f"select id, i, {e} as epoch, place from {B.placed_sql(_INDEXED, '(select count(*) from fx_clips)', 11, e)}" for e in (0, 1))


@query(f"select id, i, epoch, place, cast(place % 8 as int) as rank, place // 8 as seq from ({_PLACED})")
def epoch_permutation(spark, d):
    """Epochs as permutations of row numbers, dealt to eight ranks."""
    indexed = materialize(M.global_index(view(spark, d, "fx_clips").select("id"), "id"))
    return B.epochs(indexed, indexed.count(), 11, [0, 1], 8).select("id", "i", "epoch", "place", "rank", "seq")


@query("select curr_emotion as source, count(*) as n, case curr_emotion when 'happy' then 3 when 'sad' then 1 else 0.5e0 end / 4.5e0 as weight from fx_clips where curr_emotion in ('happy', 'sad', 'angry') group by curr_emotion")
def source_weights(spark, d):
    found = spark.createDataFrame(M.source_weights("happy:3,sad,angry:0.5"), "source string, weight double")
    sizes = view(spark, d, "fx_clips").groupBy(F.col("curr_emotion").alias("source")).agg(F.count("*").alias("n"))
    return sizes.join(found, "source")


@query(f"""with draws as (select c_custkey as draw, case when ({S.hash_of("concat('5:', c_custkey)")}) / 4294967296e0 < 3 / 4.5e0 then 'happy' when ({S.hash_of("concat('5:', c_custkey)")}) / 4294967296e0 < 3 / 4.5e0 + 1 / 4.5e0 then 'sad' else 'angry' end as source from customer),
  items as (select curr_emotion as source, id as item, row_number() over (partition by curr_emotion order by id) - 1 as j, count(*) over (partition by curr_emotion) as n from fx_clips),
  turns as (select draw, source, row_number() over (partition by source order by draw) - 1 as turn from draws)
  select t.draw, t.source, i.item from turns t join items i on i.source = t.source and i.j = t.turn % i.n""")
def mix_sources(spark, d):
    clips = view(spark, d, "fx_clips").where("curr_emotion in ('happy', 'sad', 'angry')")
    items = M.numbered_by_source(clips.select(F.col("curr_emotion").alias("source"), F.col("id").alias("item")))
    draws = view(spark, d, "customer").select(F.col("c_custkey").alias("draw"))
    return M.mix_sources(draws, items, M.source_weights("happy:3,sad,angry:0.5"), 5).select("draw", "source", "item")


@query("select 0 as part, id, duration from fx_clips where curr_emotion = 'happy' union all select 1, id, duration from fx_clips where curr_emotion = 'sad'")
def eval_chain(spark, d):
    clips = view(spark, d, "fx_clips")
    return clips.where("curr_emotion = 'happy'").select(F.lit(0).alias("part"), "id", "duration").unionByName(clips.where("curr_emotion = 'sad'").select(F.lit(1).alias("part"), "id", "duration"))


@query(f"select id, cast(k as int) as chunk, round(k * {STEP}e0, 6) as start_sec from (select id, duration, unnest(range(0, cast(ceil(duration / {STEP}e0) as bigint) + 1)) as k from fx_clips where duration > 0) where k * {STEP}e0 < duration")
def chunk_clips(spark, d):
    return M.chunk_clips(view(spark, d, "fx_clips"), STEP).select("id", "chunk", F.round("start_sec", 6).alias("start_sec"))


_CHUNKED = f"(select *, start_sec - chunk * {STEP}e0 as s, end_sec - chunk * {STEP}e0 as e from (select *, cast(floor(start_sec / {STEP}e0) as bigint) as chunk from fx_words))"


def _chunked(spark, d):
    return M.window_alignments(view(spark, d, "fx_words"), STEP)


@query(f"select clip, chunk, pos, word, round(s, 6) as start_sec, round(e, 6) as end_sec from {_CHUNKED}")
def window_alignments(spark, d):
    return _chunked(spark, d).select("clip", "chunk", "pos", "word", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"))


@query("select clip, pos, word from fx_words where speaker = 'SPEAKER_BROKER' and start_sec < end_sec")
def main_speaker_words(spark, d):
    return M.main_speaker_words(view(spark, d, "fx_words")).select("clip", "pos", "word")


@query("""select clip, pos, case when speaker = before then null when speaker = 'SPEAKER_BROKER' then 'bos' when before = 'SPEAKER_BROKER' then 'eos' end as marker
  from (select *, lag(speaker) over (partition by clip order by start_sec, pos) as before from fx_words)""")
def turn_markers(spark, d):
    return M.turn_markers(view(spark, d, "fx_words")).select("clip", "pos", "marker")


@query("select clip, pos, round(start_sec - 3.3e0, 6) as start_sec, round(end_sec - 3.3e0, 6) as end_sec from fx_words where end_sec > 3.3e0")
def shift_delay(spark, d):
    return M.shift_delay(view(spark, d, "fx_words"), 3.3).select("clip", "pos", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"))


def _token_words(spark, d):
    words = M.main_speaker_words(_chunked(spark, d))
    return words.withColumn("tokens", F.transform(F.when(F.col("n_tokens") > 0, F.sequence(F.lit(1), F.col("n_tokens"))).otherwise(F.array().cast("array<int>")), lambda k: (F.lit(100) + k).cast("int")))


_STREAM = f"""with w as (select clip, chunk, pos, s, greatest(cast(floor(s * 12.5e0) as int), 0) as f, cast(trunc(e * 12.5e0) as int) as e_f, n_tokens from {_CHUNKED} where speaker = 'SPEAKER_BROKER' and s < e),
  one as (select clip, chunk, f, arg_max({{'n': n_tokens, 'e': e_f}}, {{'s': s, 'p': pos}}) as x from w where f < {FRAMES} group by all),
  spans as (select clip, chunk, f, x.n as n, x.e as e, lead(f, 1, {FRAMES}) over (partition by clip, chunk order by f) as nf from one),
  grid as (select c.clip, c.chunk, t.t from (select distinct clip, chunk from spans) c, (select unnest(range({FRAMES}))::int as t) t),
  cells as (select g.clip, g.chunk, g.t, case when s.f is null then 3 when g.t - s.f < least(s.n, s.nf - s.f) then 101 + g.t - s.f when g.t <= s.e then -2 else 3 end as v
    from grid g left join spans s on s.clip = g.clip and s.chunk = g.chunk and s.f <= g.t and g.t < s.nf),
  marked as (select c.*, case when v in (3, -2) and exists (select 1 from spans s where s.clip = c.clip and s.chunk = c.chunk and s.n > 0 and s.f > 0 and s.f - 1 = c.t) then 0 else v end as o from cells c)
  select clip, chunk, string_agg(o::varchar, ' ' order by t) as stream from marked group by clip, chunk"""


@query(_STREAM)
def text_stream(spark, d):
    return M.text_stream(_token_words(spark, d), FRAMES).select("clip", "chunk", text("stream").alias("stream"))


_QUEUE = f"""with w as (select clip, chunk, pos, s, greatest(cast(floor(s * 12.5e0) as int), 0) as f, cast(trunc(e * 12.5e0) as int) as e_f, n_tokens as n from {_CHUNKED} where speaker = 'SPEAKER_BROKER' and s < e),
  counted as (select *, coalesce(sum(n) over (partition by clip, chunk order by s, pos rows between unbounded preceding and 1 preceding), 0) as before from w),
  begun as (select *, max(f - before) over (partition by clip, chunk order by s, pos rows unbounded preceding) + before as begin from counted),
  tokens as (select clip, chunk, begin + k as t, 101 + k as v from (select clip, chunk, begin, unnest(range(n)) as k from begun) where begin + k < {FRAMES}),
  lasts as (select clip, chunk, f, arg_max(e_f, {{'s': s, 'p': pos}}) as e_f from w group by all),
  spans as (select clip, chunk, f, e_f, lead(f, 1, {FRAMES}) over (partition by clip, chunk order by f) as nf from lasts),
  grid as (select c.clip, c.chunk, t.t from (select distinct clip, chunk from w) c, (select unnest(range({FRAMES}))::int as t) t)
  select g.clip, g.chunk, string_agg(case when k.v is not null then k.v when n.v is not null then 0 when g.t <= s.e_f then -2 else 3 end::varchar, ' ' order by g.t) as stream
  from grid g left join tokens k on k.clip = g.clip and k.chunk = g.chunk and k.t = g.t left join tokens n on n.clip = g.clip and n.chunk = g.chunk and n.t = g.t + 1
    left join spans s on s.clip = g.clip and s.chunk = g.chunk and s.f <= g.t and g.t < s.nf group by g.clip, g.chunk"""


@query(_QUEUE)
def text_stream_queue(spark, d):
    return M.text_stream_queue(_token_words(spark, d), FRAMES).select("clip", "chunk", text("stream").alias("stream"))


_TAKE = "list_transform(pcm, lambda x: cast(floor(x::double * 100) as int))"


@query(f"""select id, take, array_to_string(list_concat(list_concat(t[1:least(made, conv)], list_resize([]::int[], greatest(least(made, conv) - len(t), 0), 3)), list_resize([]::int[], greatest(conv - greatest(made, 0), 0), -1)), ' ') as text,
    array_to_string(list_concat(a[1:conv], list_resize([]::int[], greatest(conv - len(a), 0), -1)), ' ') as audio
  from (select *, cast(ceil(least(len(a), conv) * 12.5e0) as int) as made from (select id, take, {_TAKE} as a, [7, 8, 9]::int[] as t, cast(40 + n_chars as int) as conv from fx_takes))""")
def pad_streams(spark, d):
    audio = F.transform("pcm", lambda x: F.floor(x.cast("double") * 100).cast("int"))  # exact; in floats the product may round up
    t, a = M.pad_streams(F.array(*map(F.lit, (7, 8, 9))), audio, F.lit(40) + F.col("n_chars"))
    return view(spark, d, "fx_takes").select("id", "take", text(t).alias("text"), text(a).alias("audio"))


_PROMPT = f"(select id, case when {S.index('id', 3)} > 0 then range({S.index('id', 9)}) end as voice, range(100, 100 + {S.index('user_id', 12)}) as tok from fx_clips)"


@query(f"""select id, array_to_string(list_concat(list_concat(list_resize([]::bigint[], v + 4, 3), tok), list_resize([]::bigint[], 4, 3))[1:least(total, 23)], ' ') as text,
    array_to_string(list_concat(coalesce(voice, []), list_resize([]::bigint[], len(tok) + 8, -10))[1:least(total, 23)], ' ') as agent, array_to_string(list_resize([]::int[], least(total, 23), -20), ' ') as "user"
  from (select *, coalesce(len(voice), 0) as v, coalesce(len(voice), 0) + len(tok) + 8 as total from {_PROMPT})""")
def system_prompt(spark, d):
    upto = lambda n, base, most: F.slice(F.array(*[F.lit(base + i) for i in range(most)]), 1, n.cast("int"))
    clips = view(spark, d, "fx_clips").select("id", upto(stable_index("user_id", 12), 100, 12).alias("tokens"), F.when(stable_index("id", 3) > 0, upto(stable_index("id", 9), 0, 9)).alias("voice"))
    t, a, u = M.system_prompt(F.col("tokens"), F.col("voice"), 4, 24)
    return clips.select("id", text(t).alias("text"), text(a).alias("agent"), text(u).alias("user"))


_VOICE = f"(select id, path, case when {S.index('id', 2)} = 0 then concat('/clips/voice', {S.index('id', 20)}) else concat('voice', {S.index('id', 20)}) end as voice from fx_clips)"


@query(f"select id, voice_path, try_cast(regexp_extract(voice_path, '([0-9]+)$', 1) as bigint) * 7 as code from (select id, case when starts_with(voice, '/') then voice else concat('/clips/', voice) end as voice_path from {_VOICE})")
def voice_prompt_codes(spark, d):
    clips = view(spark, d, "fx_clips").select("id", "path", F.concat(F.when(stable_index("id", 2) == 0, "/clips/voice").otherwise("voice"), stable_index("id", 20).cast("string")).alias("voice"))
    codes = clips.select(F.concat(F.lit("/clips/"), F.regexp_extract("voice", "(voice[0-9]+)$", 1)).alias("voice_path")).distinct()
    codes = codes.withColumn("code", F.regexp_extract("voice_path", "([0-9]+)$", 1).cast("long") * 7)
    return M.voice_prompt_codes(clips, codes).select("id", "voice_path", "code")


_PLACED = f"(select *, cast(frame_offset + coalesce(sum(n_tokens) over (partition by clip_no order by frame_offset, pos rows between unbounded preceding and 1 preceding), 0) as int) as spot from fx_injections where frame_offset >= 0 and frame_offset < {FRAMES})"


def _placed(spark, d):
    return M.placements(view(spark, d, "fx_injections"), FRAMES)


# an original frame f moves by the tokens put in at or before it; what is heard in a block is what it displaced
@query(f"""with p as {_PLACED}, clips as (select distinct clip_no from p), frames as (select clip_no, unnest(range({FRAMES}))::int as f from clips),
  moved as (select fr.clip_no, fr.f, fr.f + coalesce((select sum(n_tokens) from p where p.clip_no = fr.clip_no and p.frame_offset <= fr.f), 0) as t from frames fr),
  blocks as (select clip_no, spot + k as t, 1000 + k as tok, case when frame_offset + k < {FRAMES} then 3000 + frame_offset + k else -10 end as heard from (select clip_no, spot, frame_offset, unnest(range(n_tokens)) as k from p)),
  rows as (select clip_no, t, 5 + f as text, 2000 + f as agent, 3000 + f as heard from moved where t < {FRAMES} union all select clip_no, t, tok, -10, heard from blocks where t < {FRAMES})
  select clip_no, string_agg(text::bigint::varchar, ' ' order by t) as text, string_agg(agent::bigint::varchar, ' ' order by t) as agent, string_agg(heard::bigint::varchar, ' ' order by t) as "user" from rows group by clip_no""")
def inject_context(spark, d):
    frames = lambda base: F.transform(F.sequence(F.lit(0), F.lit(FRAMES - 1)), lambda i: i + base)
    placed = _placed(spark, d).withColumn("tokens", F.transform(F.sequence(F.lit(0), F.col("n_tokens") - 1), lambda k: k + 1000))
    out = M.inject_context(placed, frames(5), frames(2000), frames(3000), FRAMES)
    return out.select("clip_no", *[text(c).alias(c) for c in ("text", "agent", "user")])


@query(f"""with p as {_PLACED}, cells as (select c.clip_no, t, exists (select 1 from p where p.clip_no = c.clip_no and spot <= t and t < spot + n_tokens) as m
    from (select distinct clip_no from p) c, (select unnest(range({FRAMES}))::int as t))
  select clip_no, case when bool_or(m) then concat('000', string_agg(case when m then '1' else '0' end, '' order by t)) end as mask from cells group by clip_no""")
def context_mask(spark, d):
    out = M.context_mask(_placed(spark, d), FRAMES, 3)
    return out.select("clip_no", F.array_join(F.transform("mask", lambda x: F.when(x, "1").otherwise("0")), "").alias("mask"))


@query(f"""select *, round(placed / nullif(in_window, 0), 6) as place_rate, round(tokens_placed / tokens_requested, 6) as token_yield from (select clip_no, count(*) as total, count(*) filter (ok) as in_window, count(*) filter (ok) as placed,
    0::bigint as truncated, 0::bigint as drop_anchor_overlap, 0::bigint as drop_no_space, 0::bigint as drop_final_overlap,
    count(*) filter (frame_offset is null) as drop_no_offset, count(*) filter (not ok) as drop_out_of_window, coalesce(sum(n_tokens) filter (ok), 0)::bigint as tokens_placed, sum(n_tokens)::bigint as tokens_requested
  from (select *, frame_offset >= 0 and frame_offset < {FRAMES} as ok from fx_injections) group by clip_no)""")
def injection_stats(spark, d):
    return M.injection_stats(view(spark, d, "fx_injections"), FRAMES, ("clip_no",))


# the prompt: text tokens by the take's length, silence on the agent's rows, a sine on the user's; one take in four has none
_CODES = """(select id, take, k, list_concat(case when n_chars % 4 = 0 then [] when k = 0 then list_transform(range(n_chars % 7 + 2), lambda i: cast(100 + i as int)) else list_transform(range(n_chars % 7 + 2), lambda i: case when k <= 8 then -10 else -20 end) end,
  list_transform(pcm, lambda v: cast(floor(v::double * 100) as int) + k)) as codes, n_chars from fx_takes, (select unnest(range(17))::int as k))"""


@query(f"select id, take, k, len(codes) as n, md5(array_to_string(codes, ' ')) as hash from {_CODES}")
def assemble_codes(spark, d):
    """17 rows: text, eight agent rows, eight user rows.  Codes are the floor of 100 times a sample, in doubles: exact, where floats round up to a whole number."""
    n = F.col("n_chars") % 7 + 2
    fill = lambda v: F.array_repeat(F.lit(v), n)
    prompt = F.when(F.col("n_chars") % 4 > 0, F.array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: i + 100), *[fill(M.SILENCE)] * 8, *[fill(M.SINE)] * 8))
    conversation = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda k: F.transform("pcm", lambda x: F.floor(x.cast("double") * 100).cast("int") + k))
    out = view(spark, d, "fx_takes").select("id", "take", F.posexplode(M.assemble_codes(prompt, conversation)).alias("k", "codes"))
    return out.select("id", "take", "k", F.size("codes").cast("long").alias("n"), F.md5(text("codes")).alias("hash"))


@query(f"select id, rank, batch from (select *, count(*) over (partition by rank, batch) as n from (select id, cast(i % 8 as int) as rank, (i // 8) // 4 as batch from {_INDEXED})) where n = 4")
def collate_batches(spark, d):
    sharded = M.shard_assign(M.global_index(view(spark, d, "fx_clips").select("id"), "id"), 8)
    return M.collate_batches(sharded, 4).select("id", "rank", "batch")


@query("select count(*) // (4 * 2 * 3) as steps from fx_clips")
def steps_per_epoch(spark, d):
    return M.steps_per_epoch(view(spark, d, "fx_clips"), 4, 2, 3)
