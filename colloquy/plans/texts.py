"""Registered queries: text rules, plan, prompts, acceptance, voices."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions import text as T
from colloquy.functions.hashing import stable_chance, stable_index
from colloquy.operators import models as M
from colloquy.operators import planning as P
from colloquy.operators import rounds as N
from colloquy.operators import texts as O
from colloquy.plans import sqltext as S
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


def joined(c):
    return F.concat_ws("|", c)


# ---------------------------------------------------------------- text rules
@query(f"select id, attempt, {S.strip_tags('raw_text')} as plain from fx_candidates")
def strip_tags(spark, d):
    return view(spark, d, "fx_candidates").select("id", "attempt", T.strip_tags(F.col("raw_text")).alias("plain"))


@query(f"select id, attempt, {S.clean('raw_text')} as clean from fx_candidates")
def clean_utterance(spark, d):
    return view(spark, d, "fx_candidates").select("id", "attempt", T.clean_utterance(F.col("raw_text")).alias("clean"))


_VALID = f"(select *, {S.reason('clean', 'emotion')} as reason from (select *, {S.clean('raw_text')} as clean from fx_candidates))"


@query(f"select id, attempt, emotion, case when reason is null then clean end as text, reason from {_VALID}")
def validate_utterance(spark, d):
    return O.validated(view(spark, d, "fx_candidates")).select("id", "attempt", "emotion", F.when(F.col("reason").isNull(), F.col("clean")).alias("text"), "reason")


_FALLBACK_PAIRS = f"""(select f.user_id, u.emotion as curr, r.emotion as res, {S.case('u.emotion', R.USER_FALLBACK, "''")} as line,
  {S.pair_case('u.emotion', 'r.emotion', R.AGENT_FALLBACK, R.DEFAULT_AGENT_FALLBACK)} as reply
  from (select distinct user_id, curr_emotion from fx_clips) f join fx_emotions u on f.curr_emotion = u.emotion cross join fx_emotions r)"""


@query(f"select user_id, curr, res, {S.valence('line', 'reply')} as fallback_mismatch, {S.valence('line', S.q('So sorry to hear about that'))} as sorry_mismatch, {S.valence('line', S.q('Congrats, thats amazing'))} as congrats_mismatch from {_FALLBACK_PAIRS}")
def valence_mismatch(spark, d):
    users = view(spark, d, "fx_clips").select("user_id", F.col("curr_emotion").alias("curr")).distinct()
    pairs = users.crossJoin(F.broadcast(P.emotions(spark).select(F.col("emotion").alias("res"))))
    line = O._case(F.col("curr"), R.USER_FALLBACK, F.lit(""))
    return pairs.select(
        "user_id", "curr", "res", T.valence_mismatch(line, O.agent_fallback(F.col("curr"), F.col("res"))).alias("fallback_mismatch"),
        T.valence_mismatch(line, F.lit("So sorry to hear about that")).alias("sorry_mismatch"),
        T.valence_mismatch(line, F.lit("Congrats, thats amazing")).alias("congrats_mismatch"))


_REPLIES = f"(select *, coalesce({S.reason('clean', 'res')}, case when {S.valence('user_text', 'clean')} then 'valence' end) as reason from (select *, {S.clean('agent_text')} as clean from fx_pairs))"


@query(f"select pair_id, case when reason is null then clean end as text, reason from {_REPLIES}")
def validate_reply(spark, d):
    return O.validated_replies(view(spark, d, "fx_pairs")).select("pair_id", F.when(F.col("reason").isNull(), F.col("clean")).alias("text"), "reason")


@query(f"select coalesce(curr, 'all') as curr, coalesce(res, 'all') as res, coalesce(outcome, 'all') as outcome, count(*) as n from (select curr, res, coalesce(reason, 'accepted') as outcome from {_REPLIES}) group by rollup(curr, res, outcome)")
def reject_report(spark, d):
    return O.reject_report(O.validated_replies(view(spark, d, "fx_pairs")))


@query(f"select doc_id, len(x) as n_sentences, array_to_string(x, '|') as sentences from (select doc_id, {S.sentences('text')} as x from documents)")
def split_sentences(spark, d):
    x = view(spark, d, "documents").select("doc_id", T.split_sentences(F.col("text")).alias("x"))
    return x.select("doc_id", F.size("x").cast("long").alias("n_sentences"), joined("x").alias("sentences"))


def pool_tagged(rows: str, key: str, emotion: str, text: str, seed: str) -> str:
    """DuckDB text of (key, tagged) for the lines of rows."""
    return f"""(select {key}, case when mid and len(parts) >= 2 and {S.chance("concat(seed, ':sfx')", R.MID_TURN_SHARE)}
    then concat(prefix, parts[1], chunk, case when regexp_matches(array_to_string(parts[2:], ' '), '^\\p{{L}}') then ' ' else '' end, array_to_string(parts[2:], ' '))
    when not mid and {S.chance("concat(seed, ':sfx')", R.SOUND_SHARE)} then concat(prefix, chunk, case when regexp_matches(plain, '^\\p{{L}}') then ', ' else '' end, plain)
    else concat(prefix, plain) end as tagged
  from (select {key}, seed, plain, {S.sentences('plain')} as parts, {S.tag(emotion, 'seed', R.POOL_TAGS, R.POOL_PREFIX)} as prefix,
    {S.sound(emotion, 'seed', R.POOL_SOUNDS, True)} as chunk, {S.sound(emotion, 'seed', R.POOL_SOUNDS, False)} in ('laughter', 'crying') as mid
    from (select *, {S.strip_tags(text)} as plain, {seed} as seed from {rows})))"""


@query(f"select * from {pool_tagged('fx_pairs', 'pair_id', 'curr', 'user_text', 'concat(pair_id, ' + S.q(':user') + ')')}")
def tag_speech_pool(spark, d):
    return view(spark, d, "fx_pairs").select("pair_id", T.tag_speech_pool(F.col("curr"), F.col("user_text"), F.concat("pair_id", F.lit(":user"))).alias("tagged"))


@query(f"""select pair_id, case when chunk is not null and {S.chance("concat(pair_id, ':agent:sfx')", R.SOUND_SHARE)}
    then concat(prefix, chunk, case when regexp_matches(plain, '^\\p{{L}}') then ', ' else '' end, plain) else concat(prefix, plain) end as tagged
  from (select pair_id, plain, {S.tag('res', "concat(pair_id, ':agent')", R.PAIR_TAGS, {})} as prefix, {S.sound('res', "concat(pair_id, ':agent')", R.PAIR_SOUNDS, True)} as chunk
    from (select *, {S.strip_tags('agent_text')} as plain from fx_pairs))""")
def tag_speech_pair(spark, d):
    return view(spark, d, "fx_pairs").select("pair_id", T.tag_speech_pair(F.col("res"), F.col("agent_text"), F.concat("pair_id", F.lit(":agent"))).alias("tagged"))


@query(f"select doc_id, len(w) as n_words, array_to_string(w, '|') as words from (select doc_id, {S.words('text')} as w from documents)")
def tokenize_words(spark, d):
    x = view(spark, d, "documents").select("doc_id", T.tokenize_words(F.col("text")).alias("w"))
    return x.select("doc_id", F.size("w").cast("long").alias("n_words"), joined("w").alias("words"))


@query("select id, concat('Answer with a ', res_emotion, ' tone.') as text_prompt from fx_clips")
def text_prompt(spark, d):
    return view(spark, d, "fx_clips").select("id", T.text_prompt(F.col("res_emotion")).alias("text_prompt"))


@query(f"select pair_id, case when starts_with(t, '<system>') and ends_with(t, '<system>') then t else concat('<system> ', t, ' <system>') end as wrapped from (select pair_id, case when turn % 4 = 0 then concat('<system> ', {S.trim('user_text')}, ' <system>') else {S.trim('user_text')} end as t from fx_pairs)")
def system_wrap(spark, d):
    t = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("<system> "), T.trim(F.col("user_text")), F.lit(" <system>"))).otherwise(T.trim(F.col("user_text")))
    return view(spark, d, "fx_pairs").select("pair_id", T.system_wrap(t).alias("wrapped"))


@query("""select doc_id, len(ids) as n_tokens, array_to_string(ids, ' ') as ids from (select doc_id, flatten(list_transform(lines, lambda x, i: case when i = 1 then x else list_concat([4::bigint], x) end)) as ids
  from (select doc_id, list_transform(string_split(text, chr(10)), lambda t: list_transform(regexp_extract_all(t, '[^ \\t]{1,4}'), lambda p: ('0x' || substr(md5(p), 1, 8))::bigint % 31990 + 10)) as lines from documents))""")
def subword_tokens(spark, d):
    """By the stand-in tokenizer, given as a real one would be."""
    x = M.subword_tokens(view(spark, d, "documents").select("doc_id", "text"))
    return x.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.concat_ws(" ", F.transform("ids", lambda v: v.cast("string"))).alias("ids"))


# ---------------------------------------------------------------- acceptance
_ACCEPT = f"""select p.id, case when b.best is null then 'fallback' when b.best.attempt = 0 then 'first' else 'retry' end as chosen,
  coalesce(b.best.clean, {S.case('p.emotion', {k: v.replace('{topic}', 'the weather') for k, v in R.USER_FALLBACK.items()}, "''")}) as text
  from (select id, min(emotion) as emotion from fx_candidates group by id) p
  left join (select id, arg_min({{'clean': clean, 'attempt': attempt}}, attempt) as best from {_VALID} where reason is null group by id) b on p.id = b.id"""


@query(_ACCEPT)
def accept_candidates(spark, d):
    c = view(spark, d, "fx_candidates")
    plan = c.groupBy("id").agg(F.min("emotion").alias("emotion"))
    return O.accept(plan, O.validated(c), O.user_fallback(F.col("emotion"), F.lit("the weather"))).select("id", "chosen", "text")


_TRIED = f"""(select *, min(case when outcome = 'accepted' then k end) over (partition by id) as won from (select p.id, k, case when v.raw_text is null then 'generator' else coalesce(v.reason, 'accepted') end as outcome
  from (select distinct id from fx_candidates) p cross join (select unnest([0, 1]) as k) left join {_VALID} v on v.id = p.id and v.attempt = k))"""


@query(f"""with asked as (select k::varchar as round, outcome from {_TRIED} where won is null or k <= won)
  select round, outcome, count(*)::bigint as n from asked group by all union all select round, 'all', count(*)::bigint from asked group by round""")
def accept_rounds(spark, d):
    """What each round was asked for and how it went: round 1 sees the rejects of round 0 only."""
    c = view(spark, d, "fx_candidates")
    def generate(frontier, attempt):  # a generator that has its lines in a table
        return frontier.join(c.where(F.col("attempt") == attempt).select("id", "raw_text", "emotion"), "id", "left")

    rows = N.run_rounds(c.select("id").distinct(), generate, O.validated, new_path(spark, "rounds"), 2)
    report = N.round_report(rows).select(F.col("attempt").cast("string").alias("round"), "outcome", "n")
    return report.unionByName(report.groupBy("round").agg(F.sum("n").alias("n")).withColumn("outcome", F.lit("all")))


# ---------------------------------------------------------------- plan
def _indices(spark, d):
    return view(spark, d, "customer").select(F.col("c_custkey").alias("index"))


_USERS = "(select printf('user_%s_%03d', emotion, c_custkey) as user_id, emotion as curr_emotion, ord, c_custkey as index from customer cross join fx_emotions)"


@query(f"select * from {_USERS} where curr_emotion in ('happy', 'angry')")
def parse_emotions(spark, d):
    return P.user_plan(_indices(spark, d), P.parse_emotions(" Happy, ANGRY,"))


@query(f"select * from {_USERS}")
def user_plan(spark, d):
    return P.user_plan(_indices(spark, d))


@query(f"select user_id, curr_emotion, emotion as res_emotion, printf('%s_%s_%03d', curr_emotion, emotion, index) as id from (select u.*, e.emotion from {_USERS} u cross join fx_emotions e)")
def duplex_plan(spark, d):
    return P.duplex_plan(P.user_plan(_indices(spark, d))).select("user_id", "curr_emotion", "res_emotion", "id")


@query(f"select u.user_id, p.p_name as topic from {_USERS} u join part p on p.p_partkey - (select min(p_partkey) from part) = (u.index + u.ord) % (select count(*) from part)")
def topic_assign(spark, d):
    part = view(spark, d, "part")
    low = part.agg(F.min("p_partkey").alias("low"))
    bank = part.crossJoin(F.broadcast(low)).select((F.col("p_partkey") - F.col("low")).alias("pos"), F.col("p_name").alias("topic"))  # low: one row
    return P.with_topic(P.user_plan(_indices(spark, d)), bank).select("user_id", "topic")


@query(f"select id, {S.index('id', 7)} as i7, {S.index('user_id', 456)} as i456 from fx_clips")
def stable_index_(spark, d):
    return view(spark, d, "fx_clips").select("id", stable_index("id", 7).alias("i7"), stable_index("user_id", 456).alias("i456"))


@query(f"select id, {S.chance('id', 0.1)} as p10, {S.chance('id', 0.4)} as p40 from fx_clips")
def stable_chance_(spark, d):
    return view(spark, d, "fx_clips").select("id", stable_chance("id", 0.1).alias("p10"), stable_chance("id", 0.4).alias("p40"))


for _n in ("stable_index", "stable_chance"):
    QUERIES[_n], SQL[_n] = QUERIES.pop(f"{_n}_"), SQL.pop(f"{_n}_")


@query(f"select id, 42 + {S.index('user_id', 100000)} as user_seed, 42 + {S.index('id', 100000)} as agent_seed, 42 + {S.index('id', 10000)} as speech_seed, 59 + {S.index('id', 10000)} as second_take_seed from fx_clips")
def derived_seeds(spark, d):
    return view(spark, d, "fx_clips").select(
        "id", P.derived_seed(42, "user_id").alias("user_seed"), P.derived_seed(42, "id").alias("agent_seed"),
        P.derived_seed(42, "id", 10_000).alias("speech_seed"), (P.derived_seed(42, "id", 10_000) + 17).alias("second_take_seed"))


@query(f"select id, {S.pair_case('curr_emotion', 'res_emotion', R.HINTS, R.DEFAULT_HINT)} as hint, {S.pair_case('curr_emotion', S.q('bored'), R.HINTS, R.DEFAULT_HINT)} as unknown from fx_clips")
def mapping_hints(spark, d):
    return view(spark, d, "fx_clips").select("id", O.hint(F.col("curr_emotion"), F.col("res_emotion")).alias("hint"), O.hint(F.col("curr_emotion"), F.lit("bored")).alias("unknown"))


_PROMPT = f"""concat('User said: ', user_text, chr(10), 'User emotion (for context only): ', curr, chr(10), 'Your reply emotion: ', res, chr(10), 'How to reply: ',
  {S.pair_case('curr', 'res', R.HINTS, R.DEFAULT_HINT)}, chr(10), 'Remember: do not misread the valence of their message.')"""


_SYSTEM = "Answer as the partner in a casual conversation."


@query(f"""select pair_id, case k when 0 then 'user' when 1 then 'agent' else 'retry' end as kind, i, case i when 0 then 'system' else 'user' end as role,
  case when i = 0 then {S.q(_SYSTEM)} when k = 0 then concat('Write one spoken user line.', chr(10), 'emotion=', curr, chr(10), 'topic=', pair_id, chr(10), 'variety_seed=', 42 + {S.index('pair_id', 100000)})
    when k = 1 then {_PROMPT} else concat({_PROMPT}, {S.q(R.RETRY_NOTE)}) end as content
  from fx_pairs, (select unnest([0, 1, 2]) as k), (select unnest([0, 1]) as i)""")
def render_prompts(spark, d):
    t, a, b = F.col("user_text"), F.col("curr"), F.col("res")
    kinds = {"user": O.user_message(a, F.col("pair_id"), P.derived_seed(42, "pair_id")), "agent": O.agent_message(t, a, b), "retry": O.agent_message(t, a, b, True)}
    chats = F.array(*[F.struct(F.lit(k).alias("kind"), O.chat(_SYSTEM, m).alias("messages")) for k, m in kinds.items()])
    rows = view(spark, d, "fx_pairs").select("pair_id", F.inline(chats))
    return rows.select("pair_id", "kind", F.posexplode("messages").alias("i", "m")).select("pair_id", "kind", "i", "m.role", "m.content")


@query(f"select id, replace({S.case('curr_emotion', R.USER_FALLBACK, S.q(R.USER_FALLBACK['neutral']))}, '{{topic}}', user_id) as user_line, {S.pair_case('curr_emotion', 'res_emotion', R.AGENT_FALLBACK, R.DEFAULT_AGENT_FALLBACK)} as reply from fx_clips")
def fallback_texts(spark, d):
    c = view(spark, d, "fx_clips")
    return c.select("id", O.user_fallback(F.col("curr_emotion"), F.col("user_id")).alias("user_line"), O.agent_fallback(F.col("curr_emotion"), F.col("res_emotion")).alias("reply"))


_AT = lambda names, key: f"({names})[{S.hash_of(f'concat(user_id, {S.q(key)})')} % greatest(len({names}), 1) + 1]"


@query(f"""select user_id, user_voice, case when first = user_voice and len(others) > 0 then {_AT('others', ':agent_voice_alt')} else first end as agent_voice from (
  select *, list_filter(every, lambda v: v <> user_voice) as others from (
    select *, {_AT('up', ':user_voice')} as user_voice, {_AT('ap', ':agent_voice')} as first from (
      select user_id, every, case when len(w) > 0 and len(m) > 0 then case when {S.index("concat(user_id, ':user_gender')", 2)} = 1 then w else m end else every end as up,
        case when len(w) > 0 and len(m) > 0 then case when {S.index("concat(user_id, ':user_gender')", 2)} = 1 then m else w end else every end as ap
      from (select distinct user_id from fx_clips) cross join (select list(name order by pos) as every, coalesce(list(name order by pos) filter (gender = 'F'), []) as w, coalesce(list(name order by pos) filter (gender = 'M'), []) as m from fx_voices))))""")
def pick_voices(spark, d):
    return P.pick_voices(view(spark, d, "fx_clips").select("user_id").distinct(), view(spark, d, "fx_voices"))
