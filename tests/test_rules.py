"""Hand-made rows, one for each rule, and properties."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions import text as T
from colloquy.operators import audio as A
from colloquy.operators import clips as C
from colloquy.operators import losses as L
from colloquy.operators import planning as P
from colloquy.operators import samples as M
from colloquy.operators import texts as O
from colloquy.operators import timeline


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("raw, want", [
    ("```json\nHello there friend\n```", "Hello there friend"), ('Assistant: "Sure, I can help."', "Sure, I can help."),
    ("<|emotion:anger|>\nreal line here", "real line here"), ("\n\r\n  B :  “Fine   then”  ", "Fine then"), ("", ""), (None, ""), ("``` ```", ""),
    ("one\x0btwo", "one"), ("a: b: c", "b: c"), ("\u3000wide\u2003\u2003space\u202f", "wide space"), ("x\x1fy", "x y"),
])
def test_clean(spark, raw, want):
    assert one(spark, raw, T.clean_utterance) == want


@pytest.mark.parametrize("text, emotion, want", [
    ("a" * 7, "sad", "short"), ("a" * 8, "sad", None), ("a" * 280, "sad", None), ("a" * 281, "sad", "long"),
    ("Happy to hear that", "happy", "names_emotion"), ("I feel happy today", "happy", None), ("unhappy days", "happy", None),
    ("well I'm sad today", "sad", "names_emotion"), ("As an AI I cannot", "sad", "banned"),
])
def test_reasons(spark, text, emotion, want):
    assert one(spark, text, lambda c: T.reject_reason(c, F.lit(emotion))) == want


@pytest.mark.parametrize("user, agent, want", [
    ("great news", "sorry to hear", True), ("I lost my birthday gift", "sorry to hear", False), ("whatever you say", "Congrats", True),
    ("I wonder", "my condolences", True), ("plain", "congrats", False), (None, "congrats", False),
])
def test_valence(spark, user, agent, want):
    df = spark.createDataFrame([(user, agent)], "u string, a string")
    assert df.select(T.valence_mismatch(F.col("u"), F.col("a")).alias("y")).first().y is want


def test_sentences_words_wrap(spark):
    assert one(spark, "Wait... what?! Yes", T.split_sentences) == ["Wait...", "what?!", "Yes"]
    assert one(spark, "don't — 'stop' it's 5!", T.tokenize_words) == ["don't", "'stop'", "it's", "5"]
    assert one(spark, "<system> x <system>", T.system_wrap) == "<system> x <system>" and one(spark, " x ", T.system_wrap) == "<system> x <system>"
    assert one(spark, "sad", lambda c: T.text_prompt(c, "no place")) == "no place" and one(spark, "sad", lambda c: T.text_prompt(c, "{other} {emotion}")) == "{other} {emotion}"
    assert one(spark, "a\nb", lambda c: T.subword_tokens(c, bos=1))[0] == 1


def test_mid_turn_effect_needs_two_sentences(spark):
    ids = [(f"k{i}",) for i in range(300)]
    df = spark.createDataFrame(ids, "k string")
    tag = lambda e, t: [r.y for r in df.select(T.tag_speech_pool(F.lit(e), F.lit(t), F.col("k")).alias("y")).collect()]
    assert not any("sfx" in y for y in tag("happy", "One only"))
    two = tag("happy", "One. two")
    assert 80 < sum("One.<|sfx:laughter|>Hahahaha two" in y for y in two) < 160
    assert set(tag("neutral", "<|x|>Plain")) == {"Plain"}
    assert any(y.endswith("Ahh, Go") for y in tag("angry", "Go")) and all(y.startswith("<|emotion:anger|>") for y in tag("angry", "Go"))


def test_timings(spark):
    got = one(spark, ["a", "bbb"], lambda c: timeline.word_timings(c, F.lit(0.0), F.lit(4.0)), "array<string>")
    assert [(w.word, w.start, w.end) for w in got] == [("a", 0, 1), ("bbb", 1, 4)]
    assert one(spark, [], lambda c: timeline.word_timings(c, F.lit(0.0), F.lit(4.0)), "array<string>") == []


def test_plan(spark):
    assert P.parse_emotions("happy, SAD") == ["happy", "sad"]
    for bad in ("", "joy"):
        with pytest.raises(ValueError):
            P.parse_emotions(bad)
    users = P.user_plan(spark.createDataFrame([(0,), (1000,)], "index long"))
    assert users.count() == 8 and {r.user_id for r in users.collect()} >= {"user_sad_000", "user_sad_1000"}
    with pytest.raises(ValueError):
        P.stable_index("x", 0)


@pytest.mark.parametrize("pool, ok", [
    ([(0, "a", "F"), (1, "b", "M")], lambda u, g, _: (u, g) == ("b", "a")),
    ([(0, "a", "F"), (1, "b", "F"), (2, "c", "")], lambda u, g, _: u != g),
    ([(0, "a", "F"), (1, "b", "M"), (2, "c", "F")], lambda u, g, sex: sex[u] != sex[g]),
    ([(0, "a", ""), (1, "a", ""), (2, "b", "")], lambda u, g, _: u != g),
])
def test_voices(spark, pool, ok):
    users = spark.createDataFrame([(f"u{i}",) for i in range(40)], "user_id string")
    rows = P.pick_voices(users, spark.createDataFrame(pool, "pos long, name string, gender string")).collect()
    assert len(rows) == 40 and all(ok(r.user_voice, r.agent_voice, {n: g for _, n, g in pool}) for r in rows)


def clips(spark, per, only=None):
    return spark.createDataFrame([(f"{a}_{b}_{i:03d}", f"user_{a}_{i:03d}", a, b, f"/{a}{b}{i}", 1.5) for a in R.EMOTIONS for b in R.EMOTIONS for i in range(per) if only is None or (a, b) != only or i < 3],
                                 "id string, user_id string, curr_emotion string, res_emotion string, path string, duration double")


@pytest.mark.parametrize("per, share, want", [(90, 0.05, 5), (1, 0.5, 0), (10, 0.0, 0), (4, 0.99, 3)])
@pytest.mark.parametrize("mode", ["hash", "shuffle"])
def test_split(spark, per, share, want, mode):
    split = C.balanced_split(clips(spark, per), share, 3, mode)
    assert all(r.val == want for r in C.split_report(split, share, 3).collect() if r.mapping != "all")
    assert C.split_leakage(split).first().n_leaking == 0


def test_split_of_uneven_mappings(spark):
    split = C.balanced_split(clips(spark, 20, ("sad", "happy")), 0.5, 3)
    assert {r["index"] for r in split.where("split = 'val'").collect()} < {0, 1, 2} and C.split_report(split, 0.5, 3).where("mapping = 'all'").first().val == 32


def test_chunks(spark):
    step = M.step_sec()
    assert step == 30.4
    df = spark.createDataFrame([(i, d) for i, d in enumerate([30.4, 30.5, 0.0, 91.1])], "id int, duration double")
    assert {r.id: r["count"] for r in M.chunk_clips(df, step).groupBy("id").count().collect()} == {0: 1, 1: 2, 3: 3}
    k = spark.range(2000).select("id", M.chunk_of(F.col("id") * F.lit(step), step).alias("k"))
    assert k.where("id <> k").count() == 0


def test_weights_and_batches(spark):
    assert M.source_weights("a:3,b") == [("a", 0.75), ("b", 0.25)]
    for bad in ("a,a", "a:0", "a:1:2", ""):
        with pytest.raises(ValueError):
            M.source_weights(bad)
    rows = M.shard_assign(M.global_index(spark.range(10).select("id"), "id"), 1)
    assert M.collate_batches(rows, 4).count() == 8
    assert [r.i for r in M.global_index(spark.range(500).repartition(7), "id").orderBy("id").collect()] == list(range(500))


def brute_stream(words, frames, rate=12.5, queue=False):
    """Frame by frame: words arrive at their frame; marks before tokens are set at the end."""
    waiting, end, ids, spoken = [], -1, [], []
    for frame in range(frames):
        for s, e, tokens in words:
            if math.floor(s * rate) == frame:
                waiting, end = (waiting if queue else []) + tokens, int(e * rate)
        spoken.append(bool(waiting))
        ids.append(waiting[0] if waiting else -2 if frame <= end else 3)
        waiting = waiting[1:]
    return [0 if k + 1 < frames and spoken[k + 1] and not spoken[k] else x for k, x in enumerate(ids)]


def test_text_stream_frame_by_frame(spark):
    rnd = random.Random(8)
    rows, want, queued = [], {}, {}
    for c in range(120):
        words = sorted((rnd.choice([0.0, rnd.uniform(0, 5)]), rnd.random()) for _ in range(rnd.randint(1, 12)))
        words = [(s, s + rnd.uniform(0.01, 1.5), [rnd.randint(10, 99) for _ in range(rnd.randint(0, 5))]) for s, _ in words]
        rows += [(c, 0, p, s, e, t) for p, (s, e, t) in enumerate(words)]
        want[c], queued[c] = brute_stream(words, 50), brute_stream(words, 50, queue=True)
    df = spark.createDataFrame(rows, "clip int, chunk int, pos int, start_sec double, end_sec double, tokens array<int>")
    assert {r.clip: r.stream for r in M.text_stream(df, 50).collect()} == want
    assert {r.clip: r.stream for r in M.text_stream_queue(df, 50).collect()} == queued


def test_injection_step_by_step(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for c in range(80):
        text, agent, user = list(range(30)), list(range(100, 130)), list(range(200, 230))
        blocks = [(rnd.randint(-3, 33), p, rnd.randint(1, 9)) for p in range(rnd.randint(1, 5))]
        rows += [(c, p, None if rnd.random() < 0.1 else o, n, [1000 + p] * n) for o, p, n in blocks]
        shift = 0
        for o, p, n in sorted((r[2], r[1], r[3]) for r in rows if r[0] == c and r[2] is not None and 0 <= r[2] < 30):
            at = o + shift
            heard = user[at : at + n]
            text[at:at], agent[at:at], user[at:at] = [1000 + p] * n, [M.SILENCE] * n, heard + [M.SILENCE] * (n - len(heard))
            shift += n
        want[c] = (text[:30], agent[:30], user[:30])
    df = spark.createDataFrame(rows, "clip_no int, pos int, frame_offset int, n_tokens int, tokens array<int>")
    seq = lambda b: F.sequence(F.lit(b), F.lit(b + 29))
    got = {r.clip_no: (r.text, r.agent, r.user) for r in M.inject_context(M.placements(df, 30), seq(0), seq(100), seq(200), 30).collect()}
    assert got == {c: w for c, w in want.items() if c in got} and len(got) > 60
    total = M.injection_stats(df, 30).first()
    assert total.total == len(rows) and total.placed + total.drop_no_offset + total.drop_out_of_window == total.total


def test_losses(spark):
    rows = [(0, 0, 0, 3, True, 2.0, 0, False), (0, 0, 1, 7, True, 4.0, 0, False), (0, 0, 2, 7, True, float("nan"), 0, True), (0, 1, 0, 5, True, 1.0, 0, True), (0, 2, 0, 5, False, float("nan"), 0, False)]
    df = spark.createDataFrame(rows, "sample int, channel int, frame int, target int, valid boolean, ce double, prompt_length int, context boolean")
    got = {r["mode"]: r.loss for r in L.weighted_loss(df, L.loss_weights(0.5, 10.0)).collect()}
    assert got == {"text": round(5 / 1.5, 6), "audio": 1.0}
    none = {r["mode"]: r.loss for r in L.weighted_loss(df.withColumn("prompt_length", F.lit(9)), L.loss_weights(0.5, 10.0)).collect()}
    assert none == {"text": 0.0, "audio": 0.0}
    d = L.text_diagnostics(df).first()
    assert (d.real_loss, d.pad_loss, d.real_count, d.pad_count) == (4.0, 2.0, 1, 1)
    assert {r.channel: r.loss for r in L.per_codebook_loss(df).collect()} == {1: 1.0, 2: 0.0}


def test_audio_helpers():
    x = np.sin(np.arange(480) / 9).astype(np.float32)
    assert len(A.resample_linear(x, 16_000, 24_000)) == 720 and len(A.resample_linear(x[:1], 24_000, 8_000)) == 1
    wav = A.encode_wav([x * 0.5, x * 0.5], 16_000)
    assert np.abs(A.decode_wav(wav) - x * 0.5).max() < 1e-4 and len(A.decode_wav(wav, 24_000)) == 720
    f = A.fade_edges(x + 2, 10)
    assert f[0] == 0 and abs(f[-1]) < 1e-6 and (f[10:-10] == (x + 2)[10:-10]).all() and A.fade_edges(x[:1], 9)[0] == x[0]
    assert A.sample_rng(1, "a").random() == A.sample_rng(1, "a").random() != A.sample_rng(2, "a").random()
    tone = np.concatenate((np.full(400, 0.01), np.ones(10), np.full(400, 0.01))).astype(np.float32)
    crops = [A.roomtone_crop(tone, 50, A.sample_rng(3, str(i)), 200) for i in range(30)]
    assert max(c.max() for c in crops) < 0.5 and len(A.roomtone_crop(tone, 2000, A.sample_rng(1, ""), 200)) == 2000
    left, right, t = A.pack_pool(x, x * 0.5, tone, A.sample_rng(42, "id"), 0.2, 200)
    assert len(left) == len(right) == round(t["duration"] * 200) and t["agent_start"] > t["user_start"] + len(x) / 200
    at = round(t["agent_start"] * 200)
    assert (left[:at] == 0).all() and np.allclose(left[at : at + len(x)], x * 0.5)


def test_scores(spark):
    def score(x, chars=40):
        return A.scored(spark.createDataFrame([("a", 0, [float(v) for v in x], chars)], "id string, take int, pcm array<float>, n_chars int"), 200).first()

    rnd = np.random.default_rng(1)
    good = np.sin(np.arange(640)) * 0.3 * rnd.uniform(0.5, 1.5, 640)
    assert score(good).score > -100 and score(good[:20]).score == A.WORST and score(good * 0).score == A.WORST
    assert score(np.ones(640)).score == A.WORST and score(np.concatenate((good[:100], np.zeros(540)))).score == A.WORST
    assert math.isclose(score(good).peak, np.abs(good).max(), rel_tol=1e-5)


def test_accept_prefers_the_first_usable(spark):
    plan = spark.createDataFrame([("a", "sad"), ("b", "sad"), ("c", "sad")], "id string, emotion string")
    lines = spark.createDataFrame([("a", 0, "short", "sad"), ("a", 1, "a good enough line", "sad"), ("b", 0, "the very first line", "sad"), ("b", 1, "another line here", "sad"), ("c", 0, "json", "sad")],
                                  "id string, attempt int, raw_text string, emotion string")
    got = {r.id: (r.chosen, r.text) for r in O.accept(plan, O.validated(lines), O.user_fallback(F.col("emotion"), F.lit("rain"))).collect()}
    assert got == {"a": ("retry", "a good enough line"), "b": ("first", "the very first line"), "c": ("fallback", "I've been struggling with rain lately, and it really hurts.")}


def test_runs_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(L, "RANGE", 8)
    rnd = random.Random(6)
    steps = [("a" if i % 3 else None, i, rnd.randint(1, 9), rnd.random()) for i in range(100)]
    df = spark.createDataFrame(steps, "tag string, step long, words long, seconds double").where("tag is not null")
    got = {r.step: (r.run_words, r.run_seconds) for r in L.running_sums(df, ("words", "seconds"), ("tag",)).collect()}
    sums, secs = 0, 0.0
    for tag, i, w, s in steps:
        if tag:
            sums, secs = sums + w, secs + s
            assert got[i][0] == sums and abs(got[i][1] - secs) < 1e-9
    logs = [("a", i, float(i)) for i in (3, 40, 41, 90)]
    evals = [("a", i, -1.0) for i in (1, 3, 39, 40, 60, 95)]
    rows = L.eval_join(spark.createDataFrame(evals, "tag string, step long, loss double"), spark.createDataFrame(logs, "tag string, step long, loss double"), "tag").collect()
    assert {r.step: r.train_loss for r in rows} == {1: None, 3: 3.0, 39: 3.0, 40: 40.0, 60: 41.0, 95: 90.0}


def test_chat_and_codes(spark):
    df = spark.createDataFrame([("{curr} hi", "sad", "happy")], "t string, a string, b string")
    got = df.select(O.chat("Be brief.", O.agent_message(F.col("t"), F.col("a"), F.col("b"))).alias("m")).first().m
    assert [x.role for x in got] == ["system", "user"] and got[0].content == "Be brief." and got[1].content.startswith("User said: {curr} hi\nUser emotion (for context only): sad\n")
    codes = spark.createDataFrame([([[1], [2]], [[3, 4], [5, 6]]), (None, [[3], [5]])], "p array<array<int>>, c array<array<int>>").select(M.assemble_codes(F.col("p"), F.col("c")).alias("x"))
    assert [r.x for r in codes.collect()] == [[[1, 3, 4], [2, 5, 6]], [[3], [5]]]


@pytest.mark.parametrize("width, top", [(1, 127), (2, 32767), (3, 8388607), (4, 2147483647)])
def test_wav_widths(width, top):
    import io
    import wave

    x = np.sin(np.arange(300) / 7)
    raw = np.round(x * top).astype(np.int64) + (128 if width == 1 else 0)
    data = b"".join(int(v).to_bytes(width, "little", signed=width > 1) for v in raw)
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(width)
        f.setframerate(8000)
        f.writeframes(data)
    assert np.abs(A.decode_wav(buffer.getvalue()) - x).max() < 2 / top + 1e-6
