"""Word timings, alignments, sidecar records and the timeline of a clip."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions import text as T
from colloquy.operators.waves import cuts, with_waves

ITEM = "struct<word:string,start:double,end:double>"


def word_timings(words: Column, start: Column, end: Column) -> Column:
    """Words share [start, end] by their length; the last one ends exactly at end.  No words: an empty array."""
    weight = lambda w: F.greatest(F.length(w), F.lit(1))
    total = F.aggregate(words, F.lit(0), lambda a, w: a + weight(w)).cast("double")
    span = F.greatest(end - start, F.lit(1e-3))
    # span and total ride in the state: a lambda's outer expressions are computed anew at every step
    timed = F.aggregate(
        words,
        F.struct(start.cast("double").alias("t"), span.alias("span"), total.alias("total"), F.array().cast(f"array<{ITEM}>").alias("out")),
        lambda a, w: F.struct(
            (a["t"] + a["span"] * (weight(w) / a["total"])).alias("t"), a["span"].alias("span"), a["total"].alias("total"),
            F.concat(a["out"], F.array(F.struct(w.alias("word"), a["t"].alias("start"), (a["t"] + a["span"] * (weight(w) / a["total"])).alias("end")))).alias("out"),
        ),
        lambda a: a["out"],
    )
    last = F.try_element_at(timed, F.lit(-1))
    whole = F.struct(last["word"].alias("word"), last["start"].alias("start"), end.cast("double").alias("end"))
    return F.when(F.size(words) > 0, F.concat(F.slice(timed, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.array(whole))).otherwise(timed)


def build_alignments(user: tuple, agent: tuple) -> Column:
    """The user's words over the user's turn, then the agent's, each (words, start, end)."""
    named = lambda turn, who: F.transform(word_timings(*turn), lambda x: F.struct(x["word"].alias("word"), x["start"].alias("start"), x["end"].alias("end"), F.lit(who).alias("speaker")))
    return F.concat(named(user, R.SPEAKER_USER), named(agent, R.SPEAKER_AGENT))


def timed(words: pa.Array, start: pa.Array, end: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """word_timings() of many turns at once over flat buffers: (words of each turn, word, start, end)."""
    counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    flat, of = words.flatten(), np.repeat(np.arange(len(counts)), counts)
    number = lambda c: c.cast(pa.float64()).to_numpy(zero_copy_only=False)
    s, e = number(start), number(end)
    weight = np.maximum(pc.fill_null(pc.utf8_length(flat), 1).to_numpy(zero_copy_only=False), 1).astype(np.int64)
    upto, lasts = np.cumsum(weight), np.cumsum(counts)[counts > 0] - 1
    base = np.append(0, upto[lasts])[:-1]
    share = np.repeat(upto[lasts] - base, counts[counts > 0])
    done = upto - np.repeat(base, counts[counts > 0])
    span = np.maximum(e - s, 1e-3)[of]
    begins, ends = s[of] + span * (done - weight) / share, s[of] + span * done / share
    ends[lasts] = e[counts > 0]
    return counts, flat, pa.array(begins, pa.float64(), from_pandas=True), pa.array(ends, pa.float64(), from_pandas=True)


def with_word_timings(rows: DataFrame, words: str, start: str, end: str, name: str = "timings") -> DataFrame:
    """rows with word_timings() of the columns named."""
    def run(a):
        counts, word, s, e = timed(a[words], a[start], a[end])
        return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.StructArray.from_arrays([word, s, e], ["word", "start", "end"]), mask=a[words].is_null())]

    return with_waves(rows, f"{name} array<{ITEM}>", [words, start, end], run)


def with_alignments(rows: DataFrame, user: tuple[str, str, str], agent: tuple[str, str, str], name: str = "alignments") -> DataFrame:
    """rows with build_alignments() of the columns named, (words, start, end) of each turn."""
    def run(a):
        offsets, both, unknown = _both(a, user, agent)
        return [pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(both, ["word", "start", "end", "speaker"]), mask=unknown)]

    return with_waves(rows, f"{name} array<{ITEM[:-1]},speaker:string>>", [*user, *agent], run)


def _both(a: dict[str, pa.Array], user: tuple, agent: tuple) -> tuple[pa.Array, list[pa.Array], pa.Array]:
    """build_alignments() of many rows: (where each begins, [word, start, end, speaker], which have none)."""
    turns = [timed(*(a[c] for c in turn)) for turn in (user, agent)]
    of = np.concatenate([np.repeat(np.arange(len(t[0])), t[0]) for t in turns])
    order = np.argsort(of, kind="stable")  # a row's words of the user, then those of the agent
    both = [pa.concat_arrays([t[k] for t in turns]).take(pa.array(order)) for k in (1, 2, 3)]
    who = pa.array([R.SPEAKER_USER, R.SPEAKER_AGENT]).take(pa.array((order >= len(turns[0][1])).astype(np.int8)))
    offsets = pa.array(np.append(0, np.cumsum(sum(t[0] for t in turns))), pa.int32())
    return offsets, [*both, who], pc.or_(a[user[0]].is_null(), a[agent[0]].is_null())


def words_of(texts: pa.Array) -> pa.Array:
    """tokenize_words() of many texts at once."""
    runs = pc.split_pattern(pc.replace_substring_regex(pc.replace_substring_regex(texts, T.TAG, ""), "[^A-Za-z0-9']+", " "), " ")
    flat, of = runs.flatten(), np.repeat(np.arange(len(runs)), pc.fill_null(pc.list_value_length(runs), 0).to_numpy())
    word = pc.match_substring_regex(flat, "[A-Za-z0-9]")
    counts = np.bincount(of[word.to_numpy(zero_copy_only=False)], minlength=len(runs))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), flat.filter(word), mask=texts.is_null())


AT_ONCE = 1 << 20  # bytes of text whose words are timed at once


def with_alignments_text(rows: DataFrame, user: tuple[str, str, str], agent: tuple[str, str, str], name: str = "alignments") -> DataFrame:
    """rows with alignments_text() of the columns named, (text, start, end) of each turn: texts go in and out, no lists of words."""
    join = lambda *parts: pc.binary_join_element_wise(*parts, "", null_handling="replace", null_replacement="null")

    def run(a):
        a = a | {t[0]: words_of(a[t[0]]) for t in (user, agent)}
        offsets, (word, start, end, who), unknown = _both(a, user, agent)
        items = join("[", quoted(word), ",[", numbers(start), ",", numbers(end), "],", quoted(who), "]")
        text = join("[", pc.binary_join(pa.ListArray.from_arrays(offsets, items), ","), "]")
        return [pc.if_else(unknown, pa.scalar(None, pa.string()), text)]

    def parts(a):
        return cuts(sum(pc.fill_null(pc.binary_length(a[t[0]]), 0).to_numpy().astype(np.int64) for t in (user, agent)), AT_ONCE)

    return with_waves(rows, f"{name} string", [*user, *agent], run, parts)


def quoted(texts: pa.Array) -> pa.Array:
    """Texts as JSON strings."""
    odd = pc.match_substring_regex(texts, r'["\\\x00-\x1f]')
    if pc.any(odd).as_py():
        texts = pc.replace_with_mask(texts, odd, pa.array([json.dumps(x, ensure_ascii=False)[1:-1] for x in texts.filter(odd).to_pylist()], pa.string()))
    return pc.binary_join_element_wise('"', texts, '"', "")


def numbers(x: pa.Array) -> pa.Array:
    """Doubles as JSON numbers; one that is not finite has none."""
    return pc.if_else(pc.is_finite(x), x, pa.scalar(None, pa.float64())).cast(pa.string())


VOICE = "struct<name:string,gender:string,path:string,text:string>"


def alignments_text(alignments: Column) -> Column:
    """Alignments as a JSON text: a list of mixed kinds, [word, [start, end], speaker], for each word."""
    string = lambda x: F.rtrim(F.substr(F.to_json(F.array(x)), F.lit(2)), F.lit("]"))  # ["..."] without brackets; a quote ends it
    item = lambda a: F.concat(F.lit("["), string(a["word"]), F.lit(",["), a["start"].cast("string"), F.lit(","), a["end"].cast("string"), F.lit("],"), string(a["speaker"]), F.lit("]"))
    return F.concat(F.lit("["), F.array_join(F.transform(alignments, item), ","), F.lit("]"))


def sidecar(rate: int = 24_000, text_prompt: Column | None = None, aligned: Column | None = None) -> Column:
    """The JSON record of a clip, from its columns.

    Columns: id, user_id, curr_emotion, res_emotion, topic, user_text, agent_text, alignments,
    user_start, user_end, agent_start, agent_end, gap_sec, pad_pre_sec, pad_post_sec,
    roomtone, roomtone_dbfs, user_path, agent_path, wav, agent_voice and user_voice (VOICE).
    aligned: alignments_text(), if it is there already; then no column alignments is needed.
    Fields without a value are null.
    """
    c, empty = F.col, lambda x: F.nullif(x, F.lit(""))
    turn = lambda i, who, role: F.struct(
        F.lit(i).alias("index"), F.lit(who).alias("speaker"), c(f"{role}_start").alias("start"), c(f"{role}_end").alias("end"),
        c(f"{role}_text").alias("text"), F.lit(role).alias("role"), c(f"{role}_path").alias("path"))
    voice = lambda v: F.struct(empty(c(v)["name"]).alias("name"), empty(c(v)["gender"]).alias("gender"), empty(c(v)["path"]).alias("path"), c(v)["text"].alias("text"))
    record = F.struct(
        "id", "user_id", F.array(turn(0, R.SPEAKER_USER, "user"), turn(1, R.SPEAKER_AGENT, "agent")).alias("turns"),
        (T.text_prompt(c("res_emotion")) if text_prompt is None else text_prompt).alias("text_prompt"),
        F.struct("curr_emotion", "res_emotion", "topic", "user_id").alias("styletalk"), F.lit(rate).alias("sample_rate"), "gap_sec", "pad_pre_sec", "pad_post_sec",
        c("roomtone").alias("user_roomtone"), c("roomtone_dbfs").alias("user_roomtone_dbfs"), F.lit("proportional").alias("aligner"),
        F.struct(F.lit(R.SPEAKER_AGENT).alias("left"), F.lit(R.SPEAKER_USER).alias("right")).alias("channel_layout"),
        empty(c("agent_voice")["path"]).alias("voice_prompt"), F.struct(voice("agent_voice").alias("agent"), voice("user_voice").alias("user")).alias("voices"),
        F.struct(
            T.tag_speech_pool(c("curr_emotion"), c("user_text"), F.concat("user_id", F.lit(":user"))).alias("user"),
            T.tag_speech_pool(c("res_emotion"), c("agent_text"), F.concat("id", F.lit(":agent"))).alias("agent")).alias("tagged_text"),
        "wav", (c("agent_end") + c("pad_post_sec")).alias("duration"),
    )
    text = alignments_text(c("alignments")) if aligned is None else aligned
    return F.concat(F.lit('{"alignments":'), text, F.lit(","), F.substring(F.to_json(record, {"ignoreNullFields": "false"}), F.lit(2), F.lit(1 << 30)))


def clip_timeline(user_n: Column, agent_n: Column, gap: Column, pre_n: Column, post_n: Column, rate: int) -> list[Column]:
    """Times in seconds from sample counts: [pre][user][gap][agent][post]."""
    sec = lambda n: n / F.lit(float(rate))
    gap_n = F.rint(gap * rate).cast("long")
    agent_at = pre_n + user_n + gap_n
    return [
        sec(pre_n).alias("user_start"), sec(pre_n + user_n).alias("user_end"), sec(agent_at).alias("agent_start"),
        sec(agent_at + agent_n).alias("agent_end"), sec(agent_at + agent_n + post_n).alias("duration"),
    ]
